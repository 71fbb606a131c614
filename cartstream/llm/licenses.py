"""License texts in documents, by MinHash bands over overlapping windows of words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartstream.llm.tables import text_of
from cartstream.llm.text import (
    Words,
    alphanumeric_table,
    mixed,
    shingles,
    slices,
    split_words,
)

# Words of a shingle, and the share of a template's shingles that a window must
# hold to be a match.
SHINGLE = 2
CONTAINED = 0.8

# Shingles of a block, for templates of up to twice as many words and one.
BLOCKS = (1, 2, 4, 6, 9, 13, 19, 27)

# Chance that a matching window shares no band with its template.
MISSED = 1e-4


class Template(NamedTuple):
    """`needs` are the runs of words, two at least, that tell it from its
    namesakes: the license's name with its version."""

    name: str
    text: str
    needs: tuple[str, ...] = ()


# The licenses' own notices, and the short forms that name them.
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0.", ("Apache License, Version 2.0",)),
    Template(
        "gpl-3.0",
        "This work is licensed under the GNU General Public License, version 3.",
        ("GNU General Public License, version 3",),
    ),
    Template(
        "gpl-2.0",
        "This work is licensed under the GNU General Public License, version 2.",
        ("GNU General Public License, version 2",),
    ),
    Template(
        "lgpl-2.1",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        ("GNU Lesser General Public License, version 2.1",),
    ),
    Template(
        "lgpl-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        ("GNU Lesser General Public License, version 3",),
    ),
    Template(
        "agpl-3.0",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        ("GNU Affero General Public License, version 3",),
    ),
    Template("mit", "Released under the MIT License.", ("MIT License",)),
    Template("mit", "Licensed under the MIT License.", ("MIT License",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
        ("copy of this software",),
    ),
    Template(
        "mit",
        'to deal in the Software without restriction, including without limitation the rights to '
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("to deal in the Software",),
    ),
    Template(
        "bsd-2-clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    Template(
        "bsd-3-clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission",
        ("endorse or promote products derived",),
    ),
    Template(
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied.",
    ),
    Template(
        "apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        ("Apache License Version 2.0",),
    ),
    Template(
        "gpl-3.0",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        ("GNU General Public License",),
    ),
    Template(
        "gpl-2.0",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        ("GNU General Public License Version 2",),
    ),
    Template(
        "gpl-3.0",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        ("GNU General Public License Version 3",),
    ),
    Template(
        "lgpl-2.1",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        ("GNU Lesser General Public License Version 2.1",),
    ),
    Template(
        "lgpl-3.0",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        ("GNU Lesser General Public License Version 3",),
    ),
    Template(
        "agpl-3.0",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        ("GNU Affero General Public License Version 3",),
    ),
    Template(
        "agpl-3.0",
        "The GNU Affero General Public License is a free, copyleft license for software and other "
        "kinds of works, specifically designed to ensure cooperation with the community in the case "
        "of network server software.",
        ("GNU Affero General Public License",),
    ),
    Template("all-rights-reserved", "All rights reserved.", ("All rights reserved",)),
    Template(
        "all-rights-reserved",
        "All rights reserved. No part may be reproduced without permission.",
        ("All rights reserved",),
    ),
    Template(
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
        ("GNU General Public License", "version 2 of the License"),
    ),
    Template(
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        ("GNU General Public License", "version 3 of the License"),
    ),
    Template(
        "lgpl-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
        ("GNU Lesser General Public License", "version 2.1 of the License"),
    ),
    Template(
        "lgpl-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        ("GNU Lesser General Public License", "version 3 of the License"),
    ),
    Template(
        "agpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        ("GNU Affero General Public License", "version 3 of the License"),
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        ("Mozilla Public License, v. 2.0",),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain.",
        ("free and unencumbered software",),
    ),
    Template(
        "zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions",
        ("Permission is granted to anyone",),
    ),
    Template(
        "bsl-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy "
        "of the software and accompanying documentation covered by this license",
        ("any person or organization obtaining",),
    ),
    Template(
        "cc0-1.0",
        "The person who associated a work with this deed has dedicated the work to the public domain "
        "by waiving all of his or her rights to the work worldwide under copyright law",
    ),
    Template(
        "bsl-1.0",
        "Distributed under the Boost Software License, Version 1.0.",
        ("Boost Software License, Version 1.0",),
    ),
)


# Names by which texts refer to a license, with its version.
NAMES = {
    "apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0", "Apache-2.0 license", "Apache Software License 2.0"),
    "gpl-2.0": (
        "GNU General Public License v2.0", "GNU General Public License version 2", "GNU GPL version 2",
        "GNU GPL v2", "GPL-2.0 license",
    ),
    "gpl-3.0": (
        "GNU General Public License v3.0", "GNU General Public License version 3", "GNU GPL version 3",
        "GNU GPL v3", "GPL-3.0 license",
    ),
    "lgpl-2.1": (
        "GNU Lesser General Public License v2.1", "GNU Lesser General Public License version 2.1",
        "GNU LGPL version 2.1", "LGPL-2.1 license",
    ),
    "lgpl-3.0": (
        "GNU Lesser General Public License v3.0", "GNU Lesser General Public License version 3",
        "GNU LGPL version 3", "LGPL-3.0 license",
    ),
    "agpl-3.0": (
        "GNU Affero General Public License v3.0", "GNU Affero General Public License version 3",
        "GNU AGPL version 3", "AGPL-3.0 license",
    ),
    "mpl-2.0": ("Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "MPL-2.0 license"),
    "epl-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License - v 1.0"),
    "epl-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License - v 2.0"),
    "eupl-1.2": (
        "European Union Public Licence 1.2", "European Union Public Licence v. 1.2",
        "European Union Public License 1.2", "EUPL version 1.2",
    ),
    "bsd-2-clause": ("BSD-2-Clause", "2-Clause BSD License", "BSD 2-Clause License"),
    "bsd-3-clause": ("BSD-3-Clause", "3-Clause BSD License", "BSD 3-Clause License"),
    "cc0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    "bsl-1.0": ("Boost Software License 1.0", "Boost Software License, Version 1.0"),
    "isc": ("ISC License",),
    "zlib": ("zlib License",),
}

# Identifiers in headers of files, where they are not the names above.
IDENTIFIERS = {
    "mit": "MIT", "isc": "ISC", "zlib": "Zlib", "unlicense": "Unlicense", "0bsd": "0BSD",
    "bsl-1.0": "BSL-1.0", "wtfpl": "WTFPL", "artistic-2.0": "Artistic-2.0",
}

# The Creative Commons family.
CC_PARTS = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
CC_KINDS = ("by", "by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Of two licenses the second's text holds the first's: it alone is meant.
WITHIN = {"bsd-2-clause": "bsd-3-clause"}


def _named(name: str, text: str) -> Template:
    """Every word of `text` is needed."""
    return Template(name, text, (text,))


def _library() -> tuple[Template, ...]:
    out = [*NOTICES]
    out += [_named(name, text) for name, texts in NAMES.items() for text in texts]
    identifiers = {name: name for name in NAMES} | IDENTIFIERS
    for kind in CC_KINDS:
        for version in CC_VERSIONS:
            name = f"cc-{kind}-{version}"
            title = "-".join(CC_PARTS[part] for part in kind.split("-"))
            identifiers[name] = name
            out.append(_named(name, f"CC {kind} {version}"))
            out.append(_named(name, f"Creative Commons {title} {version}"))
    out += [_named(name, f"SPDX-License-Identifier: {text}") for name, text in identifiers.items()]
    return tuple(out)


TEMPLATES = _library()


def block_of(n_words: int) -> int:
    """The block of a template: half its words or a little more, so that templates
    of about one length share a group."""
    return next((b for b in BLOCKS if 2 * b >= n_words - 1), n_words // 2) if n_words else 0


def bands_for(similarity: float, missed: float) -> int:
    """Bands of one row that sets of `similarity` all miss with probability `missed`."""
    return ceil(log(missed) / log(1 - similarity))


class _Group:
    """Templates of one block (`block_of`), with windows for them.

    A text's shingles are cut into blocks, and each three neighbouring blocks are
    a window, so a stretch of a template's length lies whole in one. A window that
    holds the share CONTAINED of a template's n shingles, among its own 3 x block
    at most, has a similarity of at least
    CONTAINED x n / (n + 3 x block - CONTAINED x n), for which the bands are made.
    """

    def __init__(
        self, block: int, names: np.ndarray, sets: list[np.ndarray], needs: list[list[np.ndarray]]
    ) -> None:
        self.names, self.sets, self.needs, self.block = names, sets, needs, block
        fewest = min(map(len, sets))
        self.similarity = CONTAINED * fewest / (fewest + 3 * self.block - CONTAINED * fewest)
        self.bands = bands_for(self.similarity, MISSED)
        lowest = [np.array([band_hashes(s, band).min() for s in sets]) for band in range(self.bands)]
        self.order = [np.argsort(low, kind="stable") for low in lowest]
        self.keys = [low[order] for low, order in zip(lowest, self.order, strict=True)]


class _Windows:
    """The windows of a group over texts' shingles (`starts`: where each text's
    begin), and the templates that share a band with them."""

    def __init__(self, group: _Group, starts: np.ndarray) -> None:
        self.group = group
        counts = -(-np.diff(starts) // group.block)
        text = np.repeat(np.arange(len(counts)), counts)
        number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.first = starts[:-1][text] + number * group.block
        self.stop = np.minimum(self.first + 3 * group.block, starts[1:][text])
        self.joined = [text[k:] == text[:-k] for k in (1, 2)]
        self.pairs: list[np.ndarray] = []

    def look_up(self, band: int, hashes: np.ndarray) -> None:
        group = self.group
        if band >= group.bands or not len(self.first):
            return
        blocks = np.minimum.reduceat(hashes, self.first)
        lowest = blocks.copy()
        for k, joined in zip((1, 2), self.joined, strict=True):
            # A text's last windows have fewer blocks.
            np.minimum(lowest[:-k], blocks[k:], out=lowest[:-k], where=joined)
        keys = group.keys[band]
        low = np.minimum(np.searchsorted(keys, lowest, "left"), len(keys) - 1)
        window = np.flatnonzero(keys[low] == lowest)
        low = low[window]
        times = np.searchsorted(keys, lowest[window], "right") - low
        which = np.repeat(np.arange(len(window)), times)
        place = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + low[which]
        self.pairs.append(window[which] * len(group.sets) + group.order[band][place])

    def matches(self, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """(first shingle, last shingle excluded, template), by exact containment."""
        out = []
        for pair in np.unique(np.concatenate(self.pairs)).tolist() if self.pairs else ():
            window, template = divmod(pair, len(self.group.sets))
            first, stop, wanted = self.first[window], self.stop[window], self.group.sets[template]
            inside = hashes[first:stop]
            held = np.isin(wanted, inside).sum()
            if held >= CONTAINED * len(wanted) and all(
                _holds(inside, run) for run in self.group.needs[template]
            ):
                out.append((int(first), int(stop), int(self.group.names[template])))
        return out


def band_hashes(hashes: np.ndarray, band: int) -> np.ndarray:
    step = (band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return mixed(hashes + np.uint64(step))


def _holds(hashes: np.ndarray, run: np.ndarray) -> bool:
    """Whether the shingles `run` stand one after the other in `hashes`."""
    begins = np.flatnonzero(hashes[: max(len(hashes) - len(run) + 1, 0)] == run[0])
    return any(np.array_equal(hashes[at : at + len(run)], run) for at in begins)


def _shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    return shingles(words, SHINGLE)


def _words(texts: Sequence[str]) -> Words:
    return split_words(pa.array(texts, pa.string()), alphanumeric_table())


def _runs(phrases: Sequence[str]) -> list[np.ndarray]:
    hashes, starts = _shingles(_words(phrases))
    return [hashes[a:b] for a, b in zip(starts, starts[1:], strict=False)]


class Scanner:
    """All templates, by block. Templates without words are left out."""

    def __init__(self, templates: Sequence[Template]) -> None:
        words = _words([t.text for t in templates])
        hashes, starts = _shingles(words)
        needs = [_runs(t.needs) for t in templates]
        blocks = np.array([block_of(n) for n in np.diff(words.starts).tolist()], np.int64)
        self.names = [t.name for t in templates]
        self.groups = [
            _Group(
                int(block),
                np.flatnonzero(blocks == block),
                [np.unique(hashes[starts[i] : starts[i + 1]]) for i in np.flatnonzero(blocks == block)],
                [needs[i] for i in np.flatnonzero(blocks == block)],
            )
            for block in np.unique(blocks[blocks > 0])
        ]
        self.bands = max((group.bands for group in self.groups), default=0)


MATCHES = "n_words long, matches array<struct<start: int, end: int, license: string>>"


def _scan(shared: Broadcast):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, table = shared.value, alphanumeric_table()
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"), table)
                hashes, starts = _shingles(words)
                matches: list[list[dict]] = [[] for _ in range(part.num_rows)]
                windows = [_Windows(group, starts) for group in scanner.groups]
                for band in range(scanner.bands):
                    banded = band_hashes(hashes, band)
                    for group in windows:
                        group.look_up(band, banded)
                for group in windows:
                    for first, stop, name in group.matches(hashes):
                        row = int(np.searchsorted(starts, first, "right")) - 1
                        end = min(stop - starts[row] + SHINGLE - 1, words.starts[row + 1] - words.starts[row])
                        span = {"start": int(first - starts[row]), "end": int(end)}
                        matches[row].append(span | {"license": scanner.names[name]})
                yield pa.record_batch(
                    [
                        part.column("carried"),
                        pa.array(np.diff(words.starts), pa.int64()),
                        pa.array(
                            matches,
                            pa.list_(
                                pa.struct(
                                    [("start", pa.int32()), ("end", pa.int32()), ("license", pa.string())]
                                )
                            ),
                        ),
                    ],
                    ["carried", "n_words", "matches"],
                )

    return scan


def license_matches(
    docs: DataFrame, carried: Column, templates: Sequence[Template] = TEMPLATES
) -> DataFrame:
    """Per row of `docs`: `carried`, n_words and `matches`: windows of words
    (start, end excluded) with the license whose template they hold.

    Words are as for decontamination. A window matches if it holds at least the
    share CONTAINED of the template's distinct runs of two words (its one word,
    if it has no more) and, word for word, what the template needs: that share
    alone could leave out the one word that tells two licenses apart. MinHash
    bands only choose which windows are compared; a matching window is overlooked
    with probability MISSED. Null and empty texts have no matches; a very long text
    is scanned whole in one task; repeated rows are scanned alike; an empty table
    gives no rows; other columns are not read. `templates` is a list that each task
    holds; texts are not shuffled.
    """
    rows = docs.select(carried.alias("carried"), text_of(docs).alias("text"))
    schema = StructType([rows.schema["carried"], *StructType.fromDDL(MATCHES).fields])
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(templates))
    return rows.mapInArrow(_scan(shared), schema)


def license_scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_licenses, licenses (names, sorted, with
    commas). A license whose text is a part of another's (WITHIN) is not named with it."""
    names = F.array_sort(F.array_distinct("matches.license"))
    for part, whole in WITHIN.items():
        names = F.when(F.array_contains(names, whole), F.array_remove(names, part)).otherwise(names)
    return (
        license_matches(docs, docs["doc_id"], templates)
        .withColumn("names", names)
        .select(
            F.col("carried").alias("doc_id"),
            "n_words",
            F.size("names").cast("long").alias("n_licenses"),
            F.concat_ws(",", "names").alias("licenses"),
        )
    )
