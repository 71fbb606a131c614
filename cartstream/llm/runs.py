"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a longest stretch of words that repeats with a period, at least
MIN_REPEATS times. Words `period` apart are equal along a run, so it is found at
any place of it by extending the match of the text with itself, shifted by the
period, to both sides. For each period only every third multiple of it needs a
look (the harmonic grid): a run is too long to lie between two of them.

How far two places match is told without walking there. Some of the places are
samples: those whose number modulo COVER is in a difference cover, so that two
places always meet samples after the same few words, below COVER. Only the samples' suffixes
are sorted; between two of them the least common prefix of neighbours in that
order, from a sparse table, is how many blocks of words they share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartstream.llm.tables import text_of
from cartstream.llm.text import cased_white_space_table, slices, split_words

MIN_LENGTH = 6
MIN_REPEATS = 4

# Every difference modulo COVER is one between two members of RESIDUES.
COVER = 31
RESIDUES = (1, 5, 11, 24, 25, 27)

# Bytes of text whose runs are looked for together, and grid places at a time.
TEXT_BYTES = 2 << 20
PLACES = 1 << 20

SCANNED = (
    "carried {}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)


def _meeting_steps() -> np.ndarray:
    """[a, b]: the fewest words after which two places of these residues are samples."""
    member = np.zeros(COVER, bool)
    member[list(RESIDUES)] = True
    both = [
        np.logical_and.outer(np.roll(member, -step), np.roll(member, -step)) for step in range(COVER)
    ]
    return np.argmax(both, axis=0)


def _ids(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs, in the pairs' order."""
    return np.unique(first.astype(np.int64) << 32 | second, return_inverse=True)[1]


def _equal_words(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from `a` and `b` on are equal, counted up to `most`."""
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        live = live[text[a[live] + out[live]] == text[b[live] + out[live]]]
        out[live] += 1
        live = live[out[live] < most[live]]
    return out


class Extensions:
    """Longest common extensions to the right in `text`: numbers of words, where
    each document ends with a number that occurs nowhere else."""

    steps = _meeting_steps()

    def __init__(self, text: np.ndarray) -> None:
        # Beyond the end words are unlike any other: no match gets there.
        self.text = text

    def near(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words up to where both places are samples, and whether all are."""
        most = self.steps[a % COVER, b % COVER]
        equal = _equal_words(self.text, a, b, most)
        return equal, equal == most

    @cached_property
    def _places(self) -> np.ndarray:
        member = np.zeros(COVER, bool)
        member[list(RESIDUES)] = True
        return np.flatnonzero(np.resize(member, len(self.text)))

    @cached_property
    def _number(self) -> np.ndarray:
        """The sample at each place; past the end, one after all samples."""
        out = np.full(len(self.text) + 1, len(self._places), np.int64)
        out[self._places] = np.arange(len(self._places))
        return out

    def _after(self, sample: np.ndarray, blocks: int) -> np.ndarray:
        place = np.append(self._places, len(self.text))[sample] + blocks * COVER
        return self._number[np.minimum(place, len(self.text))]

    @cached_property
    def _ranks(self) -> list[np.ndarray]:
        """For 1, 2, 4, … blocks: equal numbers for samples that share so many."""
        # Words in runs of 16, so that two of them cover a block.
        run, length = self.text, 1
        while length < 16:
            shifted = np.concatenate([run[length:], run[-1:].repeat(min(length, len(run)))])[: len(run)]
            run, length = _ids(run, shifted), 2 * length
        far = np.minimum(self._places + COVER - length, len(run) - 1)
        ranks = [np.append(_ids(run[self._places], run[far]) + 1, 0)]
        every = np.arange(len(self._places))
        while len(every) and ranks[-1].max() < len(every):
            after = self._after(every, 1 << (len(ranks) - 1))
            ranks.append(np.append(_ids(ranks[-1][:-1], ranks[-1][after]) + 1, 0))
        return ranks

    @cached_property
    def _table(self) -> list[np.ndarray]:
        """Least blocks shared by neighbours in the sorted order, over 1, 2, 4, … of them."""
        order = np.argsort(self._ranks[-1][:-1])
        a, b = order[:-1].copy(), order[1:].copy()
        shared = np.zeros(len(a), np.int32)
        for k in range(len(self._ranks) - 1, -1, -1):
            same = np.flatnonzero(self._ranks[k][a] == self._ranks[k][b])
            shared[same] += 1 << k
            a[same], b[same] = self._after(a[same], 1 << k), self._after(b[same], 1 << k)
        table = [shared]
        while 2 << (len(table) - 1) <= len(shared):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def far(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from two different samples on."""
        rank = self._ranks[-1] - 1
        x, y = rank[self._number[a]], rank[self._number[b]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.log2(np.maximum(high - low, 1)).astype(np.int64)
        blocks = np.zeros(len(a), np.int64)
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            row = self._table[k]
            blocks[of] = np.minimum(row[low[of]], row[high[of] - (1 << k)])
        equal = blocks * COVER
        return equal + _equal_words(self.text, a + equal, b + equal, np.full(len(a), COVER))


@dataclass
class Found:
    """Runs of many texts, by text and start: the places are within the text."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, period and place of all places to look at, in portions."""
    most = np.where(sizes >= MIN_LENGTH, sizes // MIN_REPEATS, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(MIN_LENGTH, MIN_REPEATS * period) - period
    count = -(-(sizes[text] - period) // step)
    ends = np.cumsum(count)
    first = 0
    while first < len(text):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + PLACES, side="right")), first + 1)
        n = count[first:last]
        number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        pair = np.repeat(np.arange(first, last), n)
        yield text[pair], period[pair], number * step[pair]
        first = last


def find(codes: np.ndarray, starts: np.ndarray) -> Found:
    """All runs of texts given as numbers of words, end to end."""
    sizes = np.diff(starts)
    n_texts, n_words = len(sizes), int(codes.max()) + 1 if len(codes) else 0
    # A number of its own ends each text, and one more begins the first.
    line = np.insert(codes.astype(np.int64), starts[1:], n_words + np.arange(n_texts))
    base = starts[:-1] + np.arange(n_texts)
    kept = [np.empty((4, 0), np.int64)]
    for text, period, place in _grid(sizes):
        at = base[text] + place
        same = np.flatnonzero(line[at] == line[at + period])
        if len(same):
            kept.append(np.stack([text[same], period[same], place[same], at[same]]))
    text, period, place, at = np.concatenate(kept, axis=1)

    # Backwards the line is read from its end; the word before a place is next.
    ahead, back = Extensions(line), Extensions(np.append(line[::-1], n_words + n_texts))
    mirror = len(line) - at  # of the word before `at`
    right, open_right = ahead.near(at, at + period)
    left, open_left = back.near(mirror, mirror - period)
    deep = np.unique(text[open_right | open_left])
    if len(deep):
        # Only texts that are not settled yet have their samples sorted.
        member = np.zeros(n_texts, bool)
        member[deep] = True
        whole = np.repeat(member, sizes + 1)
        some, place_in = line[whole], np.cumsum(whole) - whole
        ahead, back = Extensions(some), Extensions(np.append(some[::-1], n_words + n_texts))
        of = np.flatnonzero(member[text])
        a = place_in[at[of]]
        right[of] = _whole(ahead, a, a + period[of])
        left[of] = _whole(back, len(some) - a, len(some) - a - period[of])
    length = left + right + period
    long = length >= np.maximum(MIN_LENGTH, MIN_REPEATS * period)
    text, start, length, period = text[long], (place - left)[long], length[long], period[long]
    # A multiple of a run's period gives the same stretch again: the least stays.
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start, text))
    return Found(text[order], start[order], length[order], period[order])


def _whole(extensions: Extensions, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    equal, open_ = extensions.near(a, b)
    of = np.flatnonzero(open_)
    if len(of):
        equal[of] += extensions.far(a[of] + equal[of], b[of] + equal[of])
    return equal


def _dropped(found: Found, starts: np.ndarray) -> np.ndarray:
    """Whether each word is in some run, after the run's first period."""
    step = np.zeros(starts[-1] + 1, np.int64)
    begin = starts[found.text] + found.start
    np.add.at(step, begin + found.period, 1)
    np.add.at(step, begin + found.length, -1)
    return np.cumsum(step)[:-1] > 0


def _scanner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["start", "length", "period"]
    for batch in batches:
        for part in slices(batch, "text", limit=TEXT_BYTES):
            words = split_words(part.column("text"), cased_white_space_table())
            found = find(words.codes, words.starts)
            bounds = np.searchsorted(found.text, np.arange(part.num_rows + 1)).astype(np.int32)
            runs = pa.StructArray.from_arrays(
                [pa.array(getattr(found, name).astype(np.int64)) for name in names], names
            )
            stays = ~_dropped(found, words.starts)
            kept = pa.array(words.distinct, pa.binary()).take(pa.array(words.codes[stays]))
            ends = np.concatenate(([0], np.cumsum(stays)))[words.starts].astype(np.int32)
            lines = pa.ListArray.from_arrays(pa.array(ends), kept.cast(pa.string()))
            yield pa.record_batch(
                [
                    part.column("carried"),
                    pa.array(np.diff(words.starts).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bounds), runs),
                    pc.binary_join(lines, " "),
                ],
                ["carried", "n_words", "runs", "collapsed"],
            )


def word_runs(docs: DataFrame, carried: Column) -> DataFrame:
    """Per row of `docs`: `carried`, n_words, its `runs` (start, length, period;
    by start, then period) and the `collapsed` text.

    Words are what `[\\x20\\x09-\\x0D]` leaves, as they are, numbered from 0. A run
    has at least MIN_LENGTH words and MIN_REPEATS times its period, which is the
    smallest; it cannot be extended to either side. The collapsed text has each
    run's first period only; its words are joined by one space. Null and empty
    texts have no words, no runs and an empty text; repeated rows are scanned like
    others; an empty table gives no rows; no other column is read. A text is
    scanned whole in one task, in memory in proportion to the longest text.
    """
    rows = docs.select(carried.alias("carried"), text_of(docs).alias("text"))
    return rows.mapInArrow(_scanner, SCANNED.format(rows.schema["carried"].dataType.simpleString()))


def echoed(text: Column, number: Column) -> Column:
    """`text` with its end replaced by repeats of a stretch of words, where `number`
    is a multiple of ten; `number` says where and of what length. Else, or where
    there is no word, the text as it is."""
    word = r"[^\x20\x09-\x0D]+"
    words = F.regexp_extract_all(text, F.lit(word), F.lit(0))
    n = F.greatest(F.size(words), F.lit(1))
    g = F.floor(number / 10)
    at = (g % n).cast("int")
    period = F.lit(1) + F.floor((n - at) / (3 + g % 8)).cast("int")
    stretch = F.slice(words, at + 1, period)
    times = F.ceil((n - at) / period).cast("int")
    whole = F.slice(F.concat(F.slice(words, F.lit(1), at), F.flatten(F.array_repeat(stretch, times))), F.lit(1), n)
    return F.when((number % 10 == 0) & text.rlike(word), F.array_join(whole, " ")).otherwise(text)
