"""Filters over 64-bit keys: one bit for each hash, built by hash range in tasks.

A filter lets all its keys through, and some others by mistake; what passes is
still to be counted or joined. Its size goes with what it holds, up to MAX_BITS.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame

from cartstream.llm.text import binary_array, mixed, text_bytes

# log2 of the most bits of a filter (2^30 bits are 128 MB) and of those of a segment.
MAX_BITS = 30
SEGMENT_BITS = 16

# Bits for each key.
SPARE = 16

# Segments that a task sums up, about, where there are more of them than cores.
TASK_SEGMENTS = 32

# Distinct buckets that a task holds before it hands their counts on.
HELD = 1 << 20

PARTS = "segment long, places binary, counts binary"


class Filter:
    """`bits` has 2^`width` of them, packed."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.bits = np.zeros(1 << max(width - 3, 0), np.uint8)

    @classmethod
    def of(cls, filters: list[Filter], width: int) -> Filter:
        """What any of the `filters` lets through, all of the same width."""
        out = cls(width)
        for other in filters:
            out.bits |= other.bits
        return out

    @classmethod
    def holding(cls, keys: np.ndarray) -> Filter:
        """A filter for keys that are here."""
        out = cls(width_for(SPARE * len(keys)))
        at = buckets(keys, out.width)
        np.bitwise_or.at(out.bits, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
        return out

    @classmethod
    def from_bits(cls, width: int, bits: np.ndarray) -> Filter:
        out = cls(0)
        out.width, out.bits = width, bits
        return out

    def size(self) -> int:
        """Bits set: about the number of keys."""
        return int(np.bitwise_count(self.bits).sum())

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = buckets(keys, self.width)
        return (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


class SharedFilter:
    """A filter for tasks.

    Spark puts what is broadcast in a file on each machine, and each Python worker
    would load its own copy of it. Workers map the bits from that file: they are
    cached pages, there once for all workers, however large the filter is.
    """

    def __init__(self, context: SparkContext, filter: Filter) -> None:
        self.width, self.bytes = filter.width, len(filter.bits)
        self.bits = context.broadcast(filter.bits)

    @cached_property
    def value(self) -> Filter:
        bits = _mapped(getattr(self.bits, "_path", None), self.bytes)
        return Filter.from_bits(self.width, self.bits.value if bits is None else bits)

    def destroy(self) -> None:
        self.bits.destroy()


def _mapped(path: str | None, size: int) -> np.ndarray | None:
    """The `size` bytes of the pickled array in a file; None if they are not there as
    they are in memory (encrypted, or sent another way)."""
    if not path:
        return None
    try:
        with open(path, "rb") as file:
            head = file.read(1 << 10)
    except OSError:
        return None
    start = b"\x96" + size.to_bytes(8, "little")  # pickle's BYTEARRAY8
    if start not in head:
        return None
    return np.asarray(np.memmap(path, np.uint8, "r", head.index(start) + len(start), size))


def width_for(n: float) -> int:
    """log2 of the bits for `n` keys."""
    return min(max(int(np.ceil(np.log2(max(n, 1)))), SEGMENT_BITS), MAX_BITS)


def buckets(keys: np.ndarray, width: int) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) >> np.uint64(64 - width)).astype(np.int64)


def _counts(bucket: np.ndarray) -> np.ndarray:
    """Distinct buckets in order, each with its count, up to 255, in the last byte."""
    distinct, n = np.unique(bucket.astype(np.uint32), return_counts=True)
    return distinct.astype(np.uint64) << np.uint64(8) | np.minimum(n, 255).astype(np.uint64)


def _total(counted: list[np.ndarray]) -> np.ndarray:
    """`_counts` of all that some `_counts` are of; these are let go."""
    packed = np.concatenate(counted)
    counted.clear()
    packed.sort()
    first = np.ones(len(packed), bool)
    np.greater(packed[1:] ^ packed[:-1], 255, out=first[1:])
    cuts = np.flatnonzero(first)
    out = packed[cuts]
    out &= ~np.uint64(255)
    packed &= np.uint64(255)
    n = np.add.reduceat(packed, cuts)
    out |= np.minimum(n, np.uint64(255), out=n)
    return out


def _parts(counted: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    """Of `_counts`, a row for each segment; counts of at most `least`."""
    if not len(counted):
        return
    shift = np.uint64(SEGMENT_BITS + 8)
    segment = np.arange(counted[0] >> shift, (counted[-1] >> shift) + np.uint64(1), dtype=np.uint64)
    bounds = np.append(np.searchsorted(counted, segment << shift), len(counted))
    some = bounds[1:] > bounds[:-1]
    ends = np.append(0, bounds[1:][some])
    places = (counted >> np.uint64(8)).astype(np.uint16)
    counts = np.minimum(counted.astype(np.uint8), np.uint8(least))
    yield pa.record_batch(
        [
            pa.array(segment[some].astype(np.int64)),
            binary_array(places.view(np.uint8), 2 * ends),
            binary_array(counts, ends),
        ],
        ["segment", "places", "counts"],
    )


def _summed(least: int):
    """Bits of the buckets that are counted `least` times or more."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            batch = batch.sort_by("segment")
            segments = batch.column("segment").to_numpy()
            starts = np.flatnonzero(np.append(True, segments[1:] != segments[:-1])[: len(segments)])
            counts, ends = text_bytes(batch.column("counts"))
            places = text_bytes(batch.column("places"))[0].view(np.uint16)
            for start, stop in zip(starts, np.append(starts[1:], len(segments)), strict=True):
                sums = held.setdefault(int(segments[start]), np.zeros(1 << SEGMENT_BITS, np.uint8))
                some = slice(ends[start], ends[stop])
                # Counts of at most `least` each, of places that several rows may have.
                more = np.bincount(places[some], counts[some], len(sums))
                np.minimum(more + sums, least, out=more)
                sums[:] = more
        for segment, sums in held.items():
            bits = np.packbits(sums >= least).tobytes()
            yield pa.record_batch([pa.array([segment]), pa.array([bits])], ["segment", "bits"])

    return total


def heavy_filter(
    rows: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], least: int, width: int
) -> Filter:
    """A filter for all keys that occur `least` times (up to 200) or more.

    `keys` gives the keys of a batch's rows, in portions. Only sums by hash bucket
    leave a task, three bytes or so for each; of them, only bits reach the driver,
    2^`width` in all.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for batch in batches:
            for part in keys(batch):
                if not len(part):
                    continue
                held.append(_counts(buckets(part, width)))
                n_held += len(held[-1])
                if n_held >= HELD:
                    held = [_total(held)]
                    n_held = len(held[0])
                    if n_held >= HELD // 2:
                        yield from _parts(held[0], least)
                        held, n_held = [], 0
        if held:
            yield from _parts(_total(held), least)

    out = Filter(width)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, (1 << (width - SEGMENT_BITS)) // TASK_SEGMENTS)
    found = rows.mapInArrow(count, PARTS).repartition("segment").coalesce(tasks)
    size = 1 << (SEGMENT_BITS - 3)
    for batch in found.mapInArrow(_summed(least), "segment long, bits binary").toArrow().to_batches():
        for segment, bits in zip(batch.column("segment").to_pylist(), batch.column("bits"), strict=True):
            out.bits[segment * size : (segment + 1) * size] = np.frombuffer(bits.as_buffer(), np.uint8)
    return out


def key_column(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield batch.column("key").to_numpy()


def key_filter(keys: DataFrame, n: int) -> Filter:
    """A filter for the column `key`, of about `n` rows."""
    return heavy_filter(keys.select("key"), key_column, 1, width_for(SPARE * n))
