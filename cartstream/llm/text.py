"""Words of many texts at once, as numpy arrays.

Used inside tasks: a batch of texts is one byte buffer, so lower-casing and
splitting are a table lookup and two comparisons over it, not a loop over texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACE = 32

# Bytes of text that are worked on together, so that a task's memory does not
# depend on how many rows Spark sends at once. One longer text is its own slice.
SLICE_BYTES = 4 << 20

# The same where the arrays are many times their text, and workers that stay between
# the stages of a pipeline would keep that memory.
LIGHT_BYTES = 1 << 20


# Characters at which texts are cut into pieces.
PIECE_ENDS = [0x0A, 0x0B, 0x0C, 0x0D, *b".,;:!?"]


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def white_space_table() -> np.ndarray:
    """Words are what `[\\x20\\x09-\\x0D]` leaves; A-Z are lower-cased."""
    table = _lowered()
    table[0x09:0x0E] = SPACE
    return table


def cased_white_space_table() -> np.ndarray:
    """Words are what `[\\x20\\x09-\\x0D]` leaves, as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[0x09:0x0E] = SPACE
    return table


def alphanumeric_table() -> np.ndarray:
    """Words are runs of ASCII letters, digits and non-ASCII; A-Z are lower-cased."""
    table = _lowered()
    for first, last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        table[first : last + 1] = SPACE
    return table


def piece_table() -> np.ndarray:
    """Words are what `[\\x20\\x09]` and the ends of pieces leave; A-Z are lower-cased."""
    table = _lowered()
    table[0x09] = SPACE
    table[PIECE_ENDS] = SPACE
    return table


def slices(batch: pa.RecordBatch, *columns: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `limit` bytes of `columns`, one row at least."""
    ends = np.zeros(batch.num_rows, np.int64)
    for column in columns:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends += np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + limit, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' (or binary values') bytes end to end, and where each starts
    (and the last ends). Null: empty."""
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if large else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def binary_array(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte strings that lie end to end in `data`; `ends` begins with 0."""
    kind, width = (pa.binary(), np.int32) if len(data) < 2**31 else (pa.large_binary(), np.int64)
    buffers = [None, pa.py_buffer(ends.astype(width)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind, len(ends) - 1, buffers)


def word_hash(word: bytes) -> int:
    """64 bits, as a signed number."""
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


@dataclass
class Words:
    """`codes[starts[i]:starts[i+1]]` are the words of text i, as places in `distinct`.
    `places`: where in the texts' bytes each word begins."""

    codes: np.ndarray
    starts: np.ndarray
    distinct: list[bytes]
    places: np.ndarray

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(word_hash, self.distinct), np.int64, len(self.distinct))

    def owners(self) -> np.ndarray:
        """Which text each word is in."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def split_words(texts: pa.Array, table: np.ndarray) -> Words:
    data, bounds = text_bytes(texts)
    n_texts = len(bounds) - 1
    data = table[data]
    inside = data != SPACE
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = bounds[:-1][bounds[:-1] < len(data)]
    first[begins] = inside[begins]  # a text's first byte starts a word whatever stands before
    places = np.flatnonzero(first)
    if not len(places):
        return Words(np.empty(0, np.int32), np.zeros(n_texts + 1, np.int64), [], places)
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    # Without the gaps the words lie end to end.
    ends = np.concatenate(([0], np.cumsum(np.flatnonzero(last) + 1 - places)))
    coded = binary_array(data[inside], ends).dictionary_encode()
    starts = np.searchsorted(places, bounds)
    return Words(
        coded.indices.to_numpy(zero_copy_only=False), starts, coded.dictionary.to_pylist(), places
    )


def pieces(texts: pa.Array, words: Words) -> np.ndarray:
    """Whether each word, split by `piece_table`, is the first of a piece."""
    data, _ = text_bytes(texts)
    ends = np.zeros(256, bool)
    ends[PIECE_ENDS] = True
    before = np.cumsum(ends[data])[words.places]
    first = np.zeros(len(words.codes), bool)
    begins = words.starts[:-1]
    first[begins[begins < len(first)]] = True
    first[1:] |= before[1:] != before[:-1]
    return first


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all 64 bits (the splitmix64 finaliser)."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct `shingles`, sorted, and which text each is of."""
    values, bounds = shingles(split_words(texts, white_space_table()), size)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], owner[new]


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, end to end by text, and where each text's start.

    A text of fewer words has one run, all of them; one without words has none.
    """
    starts = words.starts
    lengths = np.diff(starts)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    bounds = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(int(bounds[-1]), np.uint64)
    if not len(out):
        return out, bounds
    hashed = mixed(words.hashes().view(np.uint64))[words.codes]
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(out)) - bounds[owner] + starts[owner]
    length = np.minimum(lengths, size)[owner]
    value = length.astype(np.uint64)
    for k in range(size):
        there = length > k
        at = np.minimum(place + k, max(len(hashed) - 1, 0))
        step = mixed(value * np.uint64(0x9E3779B97F4A7C15) + hashed[at])
        value = np.where(there, step, value)
    return value, bounds
