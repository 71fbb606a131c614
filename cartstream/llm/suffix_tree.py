"""Language-model scores by a probabilistic suffix tree over words.

The tree's states are contexts of up to MAX_CONTEXT words. A context is a state
if what follows it differs enough from what follows its suffix; a text is scored
by the longest state that ends before each word.

All counts are taken over all training texts, in passes that count sequences one
word longer each time. A sequence of fewer than MIN_COUNT occurrences has no
probability of its own (the next shorter context's stands in for it), whatever
the corpus. So the tree grows with the corpus and stays in tables. Most sequences
occur once or twice: a pass over their hashes, which are shuffled as a few bytes
each, says which cannot reach MIN_COUNT, and only the others become rows.

A state's suffixes are states, so the log probability of a word is that of the
word by itself plus, for each state that ends before it, the state's weight and,
if the word is known there, a fixed correction. Each is a value of one sequence:
a text's score is the sum of the values of its sequences. It meets them by hash
range: the texts' sequences and the tree's are dealt into the same segments, the
texts' as packed arrays. The most frequent sequences are broadcast instead; that
saves shuffling and changes no score.

Texts are split once, into tables of word numbers that all passes read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice
from math import ceil, log10

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartstream.llm.filters import Filter, SharedFilter, heavy_filter, key_filter, width_for
from cartstream.llm.tables import text_of, written
from cartstream.llm.text import slices, split_words, white_space_table, word_hash
from cartstream.session import new_run_dir
from cartstream.sources.files import remove

MAX_CONTEXT = 3

# Occurrences that a sequence needs for a probability of its own.
MIN_COUNT = 3

# Words and sequences of this share of all tokens are broadcast to the scorers, at
# most 1 / MIN_SHARE of each length; all others meet the texts segment by segment.
MIN_SHARE = 5e-7

# Multiplies a context's key; the next word's hash is added.
STEP = np.uint64(0x9E3779B97F4A7C15)

# Taken off each count of a continuation; the mass goes to the shorter context.
DISCOUNT = 0.75

# Occurrences times Kullback-Leibler divergence (nats) that makes a context a state.
EVIDENCE = 12.0

# The token after each text's last word; no word holds a space.
END = word_hash(b" ")

# Distinct sequences that a task counts before it hands them on.
HELD = 1 << 20

# Bytes of text in one row of the table of word numbers.
ROW_BYTES = 2 << 20

# Tokens that a task goes through: the fewer tasks count a sequence, the fewer
# rows are shuffled.
TASK_TOKENS = 1 << 23

# Hash buckets for each token in which sequences are counted first.
BUCKETS_PER_TOKEN = 2

# Segments in which texts and tree meet: one for so many words and sequences of the
# tree, at least a few. A worker holds the tree's part of one, and of the texts' part
# what Spark sends at once.
SEGMENT_ROWS = 1 << 21
LEAST_SEGMENTS = 16

ENCODED = "row long, hashes binary, codes binary, starts binary, training binary, carried array<{}>"


@dataclass
class Tree:
    """`words`: key, n of all words. `states` has a table for each length of contexts
    that are states: key, suffix, n, weight. `values`: key, n, value."""

    words: DataFrame
    n_tokens: int
    n_words: int
    states: list[DataFrame] = field(default_factory=list)
    values: DataFrame | None = None

    @property
    def whole(self) -> int:
        return self.n_tokens + self.n_words + 1

    @property
    def heavy(self) -> int:
        """Occurrences of a sequence that is broadcast."""
        return max(MIN_COUNT, ceil(MIN_SHARE * self.n_tokens))


def sequence_keys(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1 the key of the sequence that ends at each place, and
    whether one does. `first` marks where texts start."""
    words = hashes.astype(np.int64).view(np.uint64)
    key, ok = words, np.ones(len(words), bool)
    for _ in range(MAX_CONTEXT + 1):
        yield key.view(np.int64), ok
        before, there = key, ok
        key, ok = words.copy(), ~first
        key[1:] += before[:-1] * STEP
        ok[1:] &= there[:-1]
        ok[:1] = False


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in sorted `keys`, -1 for what is not there."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _encoder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the texts' tokens: places in `hashes`, an END after each text;
    where texts start, and last the end; whether each is learnt from."""
    row = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, "text", limit=ROW_BYTES):
            words = split_words(part.column("text"), white_space_table())
            hashes = np.append(words.hashes(), END)
            codes = np.insert(words.codes.astype(np.int32), words.starts[1:], len(hashes) - 1)
            starts = words.starts + np.arange(len(words.starts))
            training = part.column("training").to_numpy(zero_copy_only=False).astype(np.uint8)
            carried = part.column("carried")
            yield pa.record_batch(
                [
                    pa.array([row], pa.int64()),
                    *(pa.array([x.tobytes()], pa.binary()) for x in (hashes, codes, starts, training)),
                    pa.ListArray.from_arrays(pa.array([0, len(carried)], pa.int32()), carried),
                ],
                ["row", "hashes", "codes", "starts", "training", "carried"],
            )
            row += 1


def encode_texts(docs: DataFrame, carried: Column, training: Column | None = None) -> DataFrame:
    """The table of word numbers of `docs`, for `grow_tree` and `score_texts`.

    `carried` goes with each text to its scores; `training` says which texts the
    tree grows from (null: not), all by default. Words are runs without white
    space, A-Z lower-cased, and an end is counted after each text, so null and
    empty texts have one token.
    """
    spark = docs.sparkSession
    learnt = F.lit(True) if training is None else F.coalesce(training, F.lit(False))
    rows = docs.select(text_of(docs).alias("text"), learnt.alias("training"), carried.alias("carried"))
    schema = ENCODED.format(rows.schema["carried"].dataType.simpleString())
    folder = new_run_dir(spark, "word-numbers")
    rows.mapInArrow(_encoder, schema).write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def _lines(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each row: hashes, codes, starts, and which texts are learnt from."""
    columns = [batch.column(c) for c in ("hashes", "codes", "starts", "training")]
    for values in zip(*columns, strict=True):
        kinds = (np.int64, np.int32, np.int64, np.uint8)
        hashes, codes, starts, training = (
            np.frombuffer(v.as_buffer(), k) for v, k in zip(values, kinds, strict=True)
        )
        yield hashes, codes, starts, training > 0


def _starts(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    first = np.zeros(len(codes), bool)
    first[starts[:-1]] = True
    return first


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts `keys`, where in it each distinct one begins, and these."""
    order = np.argsort(keys)
    ordered = keys[order]
    begins = np.ones(len(keys), bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    cuts = np.flatnonzero(begins)
    return order, cuts, ordered[cuts]


def _counted(parts: Iterator[tuple[np.ndarray, ...]], *names: str) -> Iterator[pa.RecordBatch]:
    """Sums of counts by key, with the columns `names` that go with a key, handed
    on whenever HELD keys have come together. `parts`: keys, counts, columns."""
    held: list[tuple[np.ndarray, ...]] = []
    n_held = 0

    def total() -> tuple[np.ndarray, ...]:
        parts = [*zip(*held, strict=True)][::-1]
        held.clear()
        order, cuts, distinct = _distinct(np.concatenate(parts.pop()))
        counts = np.concatenate(parts.pop())
        counts = np.add.reduceat(counts[order], cuts) if len(cuts) else counts
        at = order[cuts]
        del order, cuts
        out = [distinct, counts]
        while parts:  # one after the other, each let go when it has been read
            out.append(np.concatenate(parts.pop())[at])
        return tuple(out)

    def batch(*columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(columns[0]), 1 << 17):
            stop = start + (1 << 17)
            yield pa.record_batch([pa.array(c[start:stop]) for c in columns], ["key", "n", *names])

    for part in parts:
        held.append(part)
        n_held += len(part[0])
        if n_held >= HELD:
            held = [total()]
            n_held = len(held[0][0])
            if n_held >= HELD // 2:
                yield from batch(*held[0])
                held, n_held = [], 0
    if held:
        yield from batch(*total())


def _word_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts():
        for batch in batches:
            for hashes, codes, starts, training in _lines(batch):
                learnt = np.repeat(training, np.diff(starts))
                n = np.bincount(codes[learnt], minlength=len(hashes))
                yield hashes[n > 0], n[n > 0]

    return _counted(parts())


def _longer(batch: pa.RecordBatch, length: int, frequent: Filter) -> Iterator[tuple[np.ndarray, ...]]:
    """Keys of the training texts' sequences of `length` words whose both parts,
    without the last and without the first word, pass the filter, and the first part's."""
    for hashes, codes, starts, training in _lines(batch):
        words, first = hashes[codes], _starts(codes, starts)
        (shorter, _), (key, ok) = list(islice(sequence_keys(words, first), length))[-2:]
        passed = frequent.holds(hashes)[codes] if length == 2 else frequent.holds(shorter)
        ok = ok & np.repeat(training, np.diff(starts))
        at = np.flatnonzero(ok[1:] & passed[1:] & passed[:-1]) + 1
        yield key[at], shorter[at - 1]


def _hasher(length: int, shared: SharedFilter) -> Callable[[pa.RecordBatch], Iterator[np.ndarray]]:
    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for key, _ in _longer(batch, length, shared.value):
            yield key

    return keys


def _sequence_counter(length: int, shared: SharedFilter, plausible: SharedFilter):
    """Counts of sequences that may occur MIN_COUNT times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for key, context in _longer(batch, length, shared.value):
                    some = plausible.value.holds(key)
                    key, context = key[some], context[some]
                    order, cuts, keys = _distinct(key)
                    yield keys, np.diff(cuts, append=len(key)), context[order[cuts]]

        return _counted(parts(), "context")

    return count


def _suffixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key without its first word: the context's suffix, and the last word."""
    for batch in batches:
        key, context = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "context"))
        before = batch.column("of_suffix")
        rest = np.zeros(len(key), np.uint64)
        if before.null_count < len(before):  # else contexts of one word
            rest = before.to_numpy().view(np.uint64) * STEP
        suffix = pa.array((rest + key - context * STEP).view(np.int64))
        yield pa.record_batch([*batch.columns, suffix], [*batch.schema.names, "suffix"])


def _level(counts: DataFrame, below: DataFrame) -> DataFrame:
    """The counted sequences with their chances, and with each context's first one
    (`lead`) what the context is. `below`: key, n, suffix, chance of the sequences
    one word shorter."""
    of = below.select(
        F.col("key").alias("context"), F.col("n").alias("of"), F.col("suffix").alias("of_suffix")
    )
    parent = below.select(F.col("key").alias("suffix"), F.col("chance").alias("parent"))
    rows = counts.join(of, "context").select("key", "n", "context", "of", "of_suffix")
    schema = "key long, n long, context long, of long, of_suffix long, suffix long"
    rows = rows.mapInArrow(_suffixed, schema).join(parent, "suffix")
    of_context = Window.partitionBy("context")
    total = lambda column: F.sum(column).over(of_context)
    n, whole, parents = F.col("n"), F.col("of"), F.col("parent")
    rows = rows.select(
        "*",
        total(n).alias("seen"),
        total(parents).alias("parents"),
        (1 - total((n - DISCOUNT) / whole)).alias("weight"),
        total(n * F.ln(n / whole / parents)).alias("evidence"),
        (F.min("key").over(of_context) == F.col("key")).alias("lead"),
    )
    rest, before = whole - F.col("seen"), F.greatest(1 - F.col("parents"), F.lit(1e-12))
    last = F.when(rest > 0, rest * F.ln(rest / whole / before)).otherwise(0.0)
    chance = (n - DISCOUNT) / whole + F.col("weight") * parents
    return rows.select(
        "key",
        "context",
        "suffix",
        "n",
        chance.alias("chance"),
        F.log10(chance / F.col("weight") / parents).alias("over"),
        F.when(
            F.col("lead"),
            F.struct(
                F.col("of_suffix").alias("suffix"),
                F.col("of").alias("n"),
                "weight",
                (F.col("evidence") + last >= EVIDENCE).alias("state"),
            ),
        ).alias("lead"),
    )


def _close(contexts: list[DataFrame]) -> list[DataFrame]:
    """The states; the suffix of a state is a state."""
    out: list[DataFrame] = []
    for rows in reversed(contexts):
        if out:
            longer = out[0].select(F.col("suffix").alias("key")).distinct()
            rows = rows.join(longer.withColumn("closes", F.lit(True)), "key", "left").where(
                F.col("state") | F.col("closes").isNotNull()
            )
        else:
            rows = rows.where("state")
        out = [written(rows.select("key", "suffix", "n", "weight"), "states"), *out]
    return out


def _values(tree: Tree, levels: list[DataFrame]) -> DataFrame:
    """What each sequence adds to a score: as a state, its weight; as a state's
    continuation, what it has over the weight and the shorter context's chance."""
    spark = tree.words.sparkSession
    out = spark.createDataFrame([], "key long, n long, value double")
    for sequences, states in zip(levels, tree.states, strict=True):
        context = states.select(F.col("key").alias("context"))
        known = sequences.select("key", "context", "n", "over").join(context, "context", "left_semi")
        out = out.union(known.select("key", "n", "over"))
        out = out.union(states.select("key", "n", F.log10("weight")))
    return out.groupBy("key").agg(F.max("n").alias("n"), F.sum("value").alias("value"))


def _free_shuffles(spark) -> None:
    """Spark deletes a shuffle's files when the driver's memory manager has found
    that nothing refers to it any more."""
    spark._jvm.System.gc()


def _in_tasks(texts: DataFrame) -> tuple[DataFrame, int]:
    """The texts' word numbers in tasks of about TASK_TOKENS, and how many there are."""
    spark = texts.sparkSession
    n_tokens = int(texts.agg(F.sum(F.octet_length("codes"))).first()[0] or 0) // 4
    tasks = max(spark.sparkContext.defaultParallelism, ceil(n_tokens / TASK_TOKENS))
    return texts.coalesce(tasks), n_tokens


def grow_tree(texts: DataFrame) -> Tree:
    """A tree from the training texts of `encode_texts`."""
    spark = texts.sparkSession
    lines, _ = _in_tasks(texts.select("hashes", "codes", "starts", "training"))
    counted = lines.mapInArrow(_word_counter, "key long, n long")
    words = written(counted.groupBy("key").agg(F.sum("n").alias("n")), "word-counts")
    size = words.agg(
        F.sum("n").alias("tokens"),
        F.count("*").alias("words"),
        F.count_if(F.col("n") >= MIN_COUNT).alias("frequent"),
    ).first()
    tree = Tree(words, size["tokens"] or 0, size["words"])
    below = words.where(F.col("n") >= MIN_COUNT).select(
        "key",
        "n",
        F.lit(None).cast("long").alias("suffix"),
        ((F.col("n") + 1) / F.lit(tree.whole)).alias("chance"),
    )
    n_below, levels, contexts, folders = size["frequent"], [], [], []
    for length in range(2, MAX_CONTEXT + 2):
        shared = SharedFilter(spark.sparkContext, key_filter(below, n_below))
        width = width_for(BUCKETS_PER_TOKEN * tree.n_tokens)
        plausible = SharedFilter(
            spark.sparkContext, heavy_filter(lines, _hasher(length, shared), MIN_COUNT, width)
        )
        _free_shuffles(spark)
        counts = (
            lines.mapInArrow(_sequence_counter(length, shared, plausible), "key long, n long, context long")
            .groupBy("key")
            .agg(F.sum("n").alias("n"), F.first("context").alias("context"))
            .where(F.col("n") >= MIN_COUNT)
        )
        folders.append(new_run_dir(spark, "sequences"))
        rows = _level(counts, below)
        rows.write.parquet(folders[-1])
        rows = spark.read.schema(rows.schema).parquet(folders[-1])
        shared.destroy()
        plausible.destroy()
        _free_shuffles(spark)
        n_below = rows.count()
        if not n_below:
            break
        levels.append(rows)
        contexts.append(rows.where("lead IS NOT NULL").select(F.col("context").alias("key"), "lead.*"))
        below = rows.select("key", "n", "suffix", "chance")
    tree.states = _close(contexts)
    tree.values = written(_values(tree, levels), "sequence-values")
    for folder in folders:
        remove(spark, folder)
    _free_shuffles(spark)
    return tree


SCORED = "row long, carried {}, n_tokens long, n_known long, base double, score double"
ANSWERS = "row long, n_known long, base double, score double"

# Packed arrays of keys of a segment, and what goes with each: of the texts' row of
# this number which text a key is of; of the tree (in place of the number one of these)
# a word's count or a sequence's value. So in the order of `row` the tree's come first.
PACKED = "segment int, row long, more binary, keys binary"
WORDS, SEQUENCES = -2, -1
KINDS = {WORDS: np.uint32, SEQUENCES: np.float64}  # a word below MIN_SHARE has few occurrences


@dataclass
class Heavy:
    """What the scorers hold: of the most frequent words the log10 chances, of the
    most frequent sequences the values, both by sorted keys."""

    words: np.ndarray
    alone: np.ndarray
    unknown: float
    keys: np.ndarray
    values: np.ndarray


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Of each row: hashes, codes, starts, the row's number (its texts' numbers
    follow it), and which text each token is of."""
    for number, line in zip(batch.column("row").to_pylist(), _lines(batch), strict=True):
        hashes, codes, starts, _ = line
        yield hashes, codes, starts, number << 20, np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def _own_scorer(shared: Broadcast, heavy_keys: SharedFilter):
    """A row per text, with what Heavy holds, whose sequences `heavy_keys` lets
    through; other words as if they were unknown."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = shared.value
        values = np.append(heavy.values, 0.0)
        for batch in batches:
            for place, (hashes, codes, starts, row, owner) in enumerate(_rows_of(batch)):
                n = len(starts) - 1
                total = lambda x: np.bincount(owner, x, n)  # noqa: B023, E731
                found = _find(heavy.words, hashes)
                own = np.where(found >= 0, np.append(heavy.alone, 0.0)[found], heavy.unknown)[codes]
                value = values[_find(heavy.keys, hashes)][codes]
                keys = sequence_keys(hashes[codes], _starts(codes, starts))
                for key, ok in islice(keys, 1, None):
                    at = np.flatnonzero(ok & heavy_keys.value.holds(key))
                    value[at] += values[_find(heavy.keys, key[at])]
                yield pa.record_batch(
                    [
                        pa.array(row + np.arange(n)),
                        batch.column("carried")[place].values,
                        pa.array(np.diff(starts)),
                        pa.array(total(found[codes] >= 0).astype(np.int64)),
                        pa.array(total(own)),
                        pa.array(total(own + value)),
                    ],
                    ["row", "carried", "n_tokens", "n_known", "base", "score"],
                )

    return score


def _requester(shared: Broadcast, others: SharedFilter, n_segments: int):
    """The texts' other sequences that may have a value (`others` lets them through),
    and their other words: a row for each segment that a row's keys are in."""

    def request(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = shared.value
        for batch in batches:
            for hashes, codes, starts, row, owner in _rows_of(batch):
                words, first = hashes[codes], _starts(codes, starts)
                light = (_find(heavy.words, hashes) < 0)[codes]
                of, keys = [owner[light]], [words[light]]
                for key, ok in islice(sequence_keys(words, first), 1, None):
                    at = np.flatnonzero(ok)
                    at = at[others.value.holds(key[at])]
                    of.append(owner[at])
                    keys.append(key[at])
                of, keys = np.concatenate(of).astype(np.uint32), np.concatenate(keys)
                order = np.argsort(of, kind="stable")
                yield _packed(row, of[order], keys[order], n_segments)

    return request


def _packed(row: int, more: np.ndarray, keys: np.ndarray, n_segments: int) -> pa.RecordBatch:
    """A row of PACKED for each segment that some of the keys are in, which stay in order."""
    segment = keys % n_segments
    order = np.argsort(segment.astype(np.uint16) if n_segments < 1 << 16 else segment, kind="stable")
    more, keys, segment = more[order], keys[order], segment[order]
    cuts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(segment) else []
    bounds = list(zip(cuts, [*cuts[1:], len(segment)], strict=True))
    return pa.record_batch(
        [
            pa.array(segment[cuts].astype(np.int32) if bounds else [], pa.int32()),
            pa.array([row] * len(bounds), pa.int64()),
            *(pa.array([x[a:b].tobytes() for a, b in bounds], pa.binary()) for x in (more, keys)),
        ],
        ["segment", "row", "more", "keys"],
    )


def _packer(kind: int, n_segments: int):
    """The tree's keys, and what goes with them, as rows of PACKED."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for batch in batches:
            held.append((batch.column(1).to_numpy().astype(KINDS[kind]), batch.column(0).to_numpy()))
            n_held += batch.num_rows
            if n_held >= HELD:
                yield _packed(kind, *map(np.concatenate, zip(*held, strict=True)), n_segments)
                held, n_held = [], 0
        if held:
            yield _packed(kind, *map(np.concatenate, zip(*held, strict=True)), n_segments)

    return pack


class _Known:
    """The tree's part of a segment: sorted keys, the counts of words, the values of
    sequences; one more of each, zero, for what is not there."""

    def __init__(self, packed: dict[int, list[tuple[np.ndarray, np.ndarray]]]) -> None:
        parts = {}
        for kind, dtype in KINDS.items():
            some = [(np.empty(0, np.int64), np.empty(0, dtype)), *packed[kind]]
            parts[kind] = [np.concatenate(x) for x in zip(*some, strict=True)]
        # A word that is a state by itself is in both.
        self.keys = np.unique(np.concatenate([keys for keys, _ in parts.values()]))
        self.of = {kind: np.zeros(len(self.keys) + 1, dtype) for kind, dtype in KINDS.items()}
        for kind, (keys, more) in parts.items():
            self.of[kind][np.searchsorted(self.keys, keys)] = more

    def answer(self, row: int, text: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, ...]:
        """What the keys of a row's texts add to their scores, by text."""
        order = np.argsort(asked)  # looked up one after the other, not here and there
        place, of = _find(self.keys, asked[order]), text[order]
        counts, values = self.of[WORDS][place], self.of[SEQUENCES][place]
        own = np.log10(counts + 1.0)
        n = int(text[-1]) + 1 if len(text) else 0  # they are in order
        some = np.flatnonzero(np.bincount(of, minlength=n))
        total = lambda x: np.bincount(of, x, n)[some]
        return row + some, total(counts > 0).astype(np.int64), total(own), total(own + values)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the texts' sequences add to their scores. Rows of PACKED come by segment
    and `row`: all that the tree has of a segment, then the texts' rows, each of which
    is answered when it comes."""
    at, packed, known = None, {}, None
    for batch in batches:
        out = []
        numbers = (batch.column(c).to_pylist() for c in ("segment", "row"))
        arrays = (batch.column(c) for c in ("more", "keys"))
        for segment, row, more, keys in zip(*numbers, *arrays, strict=True):
            if segment != at:
                at, packed, known = segment, {kind: [] for kind in KINDS}, None
            keys = np.frombuffer(keys.as_buffer(), np.int64)
            if row < 0:
                packed[row].append((keys, np.frombuffer(more.as_buffer(), KINDS[row])))
                continue
            if known is None:
                known = _Known(packed)
                packed.clear()
            out.append(known.answer(row, np.frombuffer(more.as_buffer(), np.uint32), keys))
        if out:
            columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
            yield pa.record_batch(columns, ["row", "n_known", "base", "score"])


def score_texts(texts: DataFrame, tree: Tree) -> DataFrame:
    """Per text of `encode_texts`: `carried`, n_tokens, n_known, train_tokens,
    base_score, score.

    `base_score` adds log10((c + 1) / (N + V + 1)) over the tokens, `score` the
    tree's log10 probabilities. Repeated rows are scored like others; an empty
    table gives no rows; a tree of no texts gives every token probability 1. Very
    long texts are one row of word numbers; what they ask for is spread over all
    segments.
    """
    spark = texts.sparkSession
    # At most n_tokens / heavy, so at most 1 / MIN_SHARE rows of each length.
    above = lambda frame: frame.where(F.col("n") >= tree.heavy).orderBy("key").toArrow()
    light = tree.values.where(F.col("n") < tree.heavy)
    often, values = above(tree.words), above(tree.values)
    keys, n_light = values["key"].to_numpy(), light.count()
    held = Heavy(
        often["key"].to_numpy(),
        np.log10((often["n"].to_numpy() + 1) / tree.whole),
        -log10(tree.whole),
        keys,
        values["value"].to_numpy(),
    )
    shared = spark.sparkContext.broadcast(held)
    heavy_keys = SharedFilter(spark.sparkContext, Filter.holding(keys))
    others = SharedFilter(spark.sparkContext, key_filter(light, n_light))
    _free_shuffles(spark)
    texts, _ = _in_tasks(texts)
    n_known = tree.n_words + n_light
    n_segments = max(LEAST_SEGMENTS, ceil(n_known / SEGMENT_ROWS))
    words = tree.words.where(F.col("n") < tree.heavy).select("key", "n")
    packed = words.mapInArrow(_packer(WORDS, n_segments), PACKED)
    packed = packed.union(light.select("key", "value").mapInArrow(_packer(SEQUENCES, n_segments), PACKED))
    lines = texts.drop("carried")
    packed = packed.union(lines.mapInArrow(_requester(shared, others, n_segments), PACKED))
    dealt = packed.repartitionById(n_segments, "segment").sortWithinPartitions("segment", "row")
    answers = dealt.mapInArrow(_answers, ANSWERS)
    kind = texts.schema["carried"].dataType.elementType.simpleString()
    own = texts.mapInArrow(_own_scorer(shared, heavy_keys), SCORED.format(kind))
    return (
        own.unionByName(answers, allowMissingColumns=True)
        .groupBy("row")
        .agg(
            F.max("carried").alias("carried"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .select(
            "carried",
            "n_tokens",
            "n_known",
            F.lit(tree.n_tokens).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )
