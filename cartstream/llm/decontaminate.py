"""Benchmark passages in documents, by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartstream.llm.tables import text_of
from cartstream.llm.text import LIGHT_BYTES, Words, alphanumeric_table, slices, split_words

# Bytes of benchmark text that are searched for in one pass over the documents.
# A larger benchmark takes more passes, each with a broadcast of its own.
PASS_BYTES = 8 << 20

# End places that one cursor of the search goes through.
CURSOR_RUN = 256

SPANS = "spans array<struct<start: int, end: int>>, items array<string>, n_words long"


class _Group:
    """Patterns of one length, as numbers of words, with their tables.

    A block is the last two words of a stretch (or the only one). `shift` says
    how far the search may move on when it sees a block; 0 means that the block
    ends some pattern. Patterns with one last block and one first block lie next
    to each other.
    """

    def __init__(self, patterns: np.ndarray, names: np.ndarray, base: int) -> None:
        self.length = patterns.shape[1]
        self.block = min(2, self.length)
        self.base = base
        blocks = np.stack(
            [self._key(patterns, j) for j in range(self.block - 1, self.length)], axis=1
        )
        shifts = np.arange(self.length - self.block, -1, -1)
        order = np.argsort(blocks, axis=None, kind="stable")
        keys, first = np.unique(blocks.ravel()[order], return_index=True)
        self.keys = keys
        self.shift = np.minimum.reduceat(np.broadcast_to(shifts, blocks.shape).ravel()[order], first)
        self.suffixes = np.unique(blocks[:, -1])
        self.prefixes = np.unique(blocks[:, 0])
        bucket = self._bucket(blocks[:, -1], blocks[:, 0])
        order = np.argsort(bucket, kind="stable")
        self.bucket, self.patterns, self.names = bucket[order], patterns[order], names[order]

    def _key(self, ids: np.ndarray, end) -> np.ndarray:
        """The block that ends at column (or flat place) `end`."""
        last = ids[:, end] if ids.ndim == 2 else ids[end]
        if self.block == 1:
            return last.astype(np.int64)
        before = ids[:, end - 1] if ids.ndim == 2 else ids[end - 1]
        return before.astype(np.int64) * self.base + last

    def _bucket(self, suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.suffixes, suffix)
        p = np.minimum(np.searchsorted(self.prefixes, prefix), len(self.prefixes) - 1)
        return np.where(self.prefixes[p] == prefix, s * len(self.prefixes) + p, -1)

    def search(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where occurrences end, and the name of the pattern there."""
        first, stop = starts[:-1] + self.length - 1, starts[1:]
        runs = np.maximum(-(-(stop - first) // CURSOR_RUN), 0)
        text = np.repeat(np.arange(len(runs)), runs)
        number = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
        at = first[text] + number * CURSOR_RUN
        stop = np.minimum(at + CURSOR_RUN, stop[text])
        far = self.length - self.block + 1
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(at):
            key = self._key(ids, at)
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            shift = np.where(self.keys[place] == key, self.shift[place], far)
            zero = shift == 0
            if zero.any():
                found.append(self._confirmed(ids, at[zero], key[zero]))
            at = at + np.maximum(shift, 1)
            alive = at < stop
            at, stop = at[alive], stop[alive]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _confirmed(self, ids, at, suffix) -> tuple[np.ndarray, np.ndarray]:
        bucket = self._bucket(suffix, self._key(ids, at - self.length + self.block))
        low = np.searchsorted(self.bucket, bucket, "left")
        n = np.where(bucket < 0, 0, np.searchsorted(self.bucket, bucket, "right") - low)
        which = np.repeat(np.arange(len(at)), n)
        pattern = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]
        same = np.ones(len(which), bool)
        for j in range(self.length):
            same &= ids[at[which] - self.length + 1 + j] == self.patterns[pattern, j]
        return at[which[same]], self.names[pattern[same]]


class Searcher:
    """Finds all windows of the given items: `window` consecutive words of an
    item, or all its words where it has fewer."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        words = split_words(pa.array([text for _, text in items], pa.string()), alphanumeric_table())
        self.numbers = {word: i + 1 for i, word in enumerate(words.distinct)}
        windows: dict[tuple[int, ...], set[str]] = {}
        codes = (words.codes + 1).tolist()
        for (item, _), a, b in zip(
            items, words.starts[:-1].tolist(), words.starts[1:].tolist(), strict=True
        ):
            size = min(window, b - a)
            for i in range(a, b - size + 1) if size else ():
                windows.setdefault(tuple(codes[i : i + size]), set()).update(
                    [] if item is None else [item]
                )
        self.items = list(windows.values())
        by_length: dict[int, list[tuple[tuple[int, ...], int]]] = {}
        for name, pattern in enumerate(windows):
            by_length.setdefault(len(pattern), []).append((pattern, name))
        self.groups = [
            _Group(
                np.array([p for p, _ in group], np.int32),
                np.array([name for _, name in group]),
                len(self.numbers) + 1,
            )
            for _, group in sorted(by_length.items())
        ]

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of occurrences, and which windows (for `items`)."""
        number = np.fromiter(
            (self.numbers.get(w, 0) for w in words.distinct), np.int32, len(words.distinct)
        )
        ids = number[words.codes] if len(words.codes) else np.empty(0, np.int32)
        found = [(g.length, *g.search(ids, words.starts)) for g in self.groups]
        ends = [end for _, end, _ in found]
        starts = [end - length + 1 for length, end, _ in found]
        names = [name for _, _, name in found]
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        return join(starts), join(ends) + 1, join(names)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _finder(shared: Broadcast):
    """Adds what one pass finds to each row's spans and items."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher, table = shared.value, alphanumeric_table()
        for batch in batches:
            for part in slices(batch, "text", limit=LIGHT_BYTES):
                words = split_words(part.column("text"), table)
                starts, ends, names = searcher.search(words)
                owner = np.searchsorted(words.starts, starts, side="right") - 1
                spans = part.column("spans").to_pylist()
                items = part.column("items").to_pylist()
                order = np.argsort(owner, kind="stable")
                rows, first = np.unique(owner[order], return_index=True)
                for row, begin, end in zip(rows, first, [*first[1:], len(order)], strict=False):
                    mine = order[begin:end]
                    here = list(zip(starts[mine] - words.starts[row], ends[mine] - words.starts[row]))
                    before = [(s["start"], s["end"]) for s in spans[row]]
                    spans[row] = [
                        {"start": int(a), "end": int(b)} for a, b in _merged(before + here)
                    ]
                    names_here = set().union(*(searcher.items[n] for n in np.unique(names[mine])))
                    items[row] = sorted(names_here.union(items[row]))
                columns = {name: part.column(name) for name in part.schema.names}
                columns["spans"] = pa.array(spans, part.schema.field("spans").type)
                columns["items"] = pa.array(items, part.schema.field("items").type)
                columns["n_words"] = pa.array(np.diff(words.starts), pa.int64())
                yield pa.record_batch(list(columns.values()), list(columns))

    return find


def find_passages(docs: DataFrame, carried: Column, items: DataFrame, window: int = 10) -> DataFrame:
    """Per row of `docs`: `carried`, n_words, the stretches of words (`spans`,
    from 0, ends excluded, merged) that lie in an occurrence of a window of
    `items`, and the ids of the items found, sorted.

    Words are runs of ASCII letters, digits and other characters beyond ASCII,
    A-Z lower-cased. Items without words (or text) have no window; an item
    without id counts for spans only. Null texts have no words. Repeated items
    and rows change nothing; an empty `items` finds nothing. The documents are
    not shuffled: each pass carries one part of the items, of about PASS_BYTES.
    """
    spark = docs.sparkSession
    items = items.select(
        items["item_id"].cast("string").alias("item"), items["text"].cast("string").alias("text")
    ).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = ceil(total / PASS_BYTES)
    found = docs.select(
        carried.alias("carried"),
        text_of(docs).alias("text"),
        F.expr("cast(array() as array<struct<start: int, end: int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
        F.lit(0).cast("long").alias("n_words"),
    )
    schema = StructType([*found.schema.fields[:2], *StructType.fromDDL(SPANS).fields])
    part_of = F.pmod(F.xxhash64("item", "text"), F.lit(max(passes, 1)))
    for number in range(max(passes, 1)):
        # About PASS_BYTES, by the count above.
        part = items.where(part_of == number).distinct().collect() if passes else []
        searcher = Searcher([(row["item"], row["text"]) for row in part], window)
        found = found.mapInArrow(_finder(spark.sparkContext.broadcast(searcher)), schema)
    return found.drop("text")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_passages(docs, docs["doc_id"], items, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("carried").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of `docs` without any window of `items`, with all their columns."""
    found = find_passages(docs, F.struct("*"), items, window)
    return found.where(F.size("spans") == 0).select("carried.*")
