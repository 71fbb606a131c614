"""Near duplicates by one-permutation MinHash, banded buckets and stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.llm.components import components
from cartstream.llm.tables import keep_rows, text_of, written
from cartstream.llm.text import LIGHT_BYTES, mixed, shingle_sets, slices

# Bins that the one permutation is cut into, by the top bits of a hash.
BIN_BITS = 9
BINS = 1 << BIN_BITS

# Bands of rows, from the first BANDS x ROWS bins: sets of similarity 0.8 share
# no band with probability (1 - 0.8^4)^32, about 5 in 100 million.
BANDS, ROWS = 32, 4

# Two sets are likely similar if the share of filled bins in which they agree is
# at most this many deviations of that estimate below what is asked for: a similar
# pair is not, once in some millions.
DEVIATIONS = 5

# Members of a bucket that one comparison holds on each side.
BLOCK = 512

EMPTY = np.uint64(2**64 - 1)

# Tries per empty bin; a set whose tries all meet empty bins (odds of one in ten
# million, for a single shingle) takes its first filled bin.
TRIES = 8192


def _tries(k: int, bins: np.ndarray) -> np.ndarray:
    """The k-th bin that an empty bin looks at, alike for all sets."""
    place = bins.astype(np.uint64) * np.uint64(TRIES) + np.uint64(k + 1)
    return (mixed(place) >> np.uint64(64 - BIN_BITS)).astype(np.int64)


def signatures(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (n x BANDS) and marks (n x BINS) of n sets; see `shingle_sets`.

    A bin holds the smallest hash that falls in it. For the bands, empty bins
    are filled by optimal densification: each looks at bins in an order of its
    own until one is filled. A mark is a byte of the bin's hash, 0 if empty.
    """
    filled = np.full((n, BINS), EMPTY, np.uint64)
    bins = (values >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    flat = owner * BINS + bins
    first = np.ones(len(flat), bool)
    first[1:] = flat[1:] != flat[:-1]
    filled.reshape(-1)[flat[first]] = values[first]
    marks = np.where(filled == EMPTY, 0, mixed(filled) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    dense = filled[:, : BANDS * ROWS].copy()
    row, column = np.nonzero((dense == EMPTY) & (filled != EMPTY).any(axis=1)[:, None])
    for k in range(TRIES):
        if not len(row):
            break
        found = filled[row, _tries(k, column)]
        hit = found != EMPTY
        dense[row[hit], column[hit]] = found[hit]
        row, column = row[~hit], column[~hit]
    if len(row):
        dense[row, column] = filled[row, (filled[row] != EMPTY).argmax(axis=1)]
    keys = np.zeros((n, BANDS), np.uint64)
    for k in range(ROWS):
        keys = mixed(keys + dense.reshape(n, BANDS, ROWS)[:, :, k])
    return keys.view(np.int64), marks


def set_digests(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """128 bits for each of n sets, as two numbers."""
    bounds = np.searchsorted(owner, np.arange(n + 1))
    raw = memoryview(values.tobytes())
    digests = [xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) for a, b in zip(bounds, bounds[1:])]
    return np.frombuffer(b"".join(digests), "<i8").reshape(n, 2)


SIGNED = (
    "doc_id long, text_key long, n_shingles long, set_hi long, set_lo long, bands array<long>, "
    "marks binary"
)


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", limit=LIGHT_BYTES):
                n = part.num_rows
                values, owner = shingle_sets(part.column("text"), size)
                keys, marks = signatures(values, owner, n)
                whole = set_digests(values, owner, n)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.ravel())
                )
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array(np.bincount(owner, minlength=n), pa.int64()),
                        pa.array(whole[:, 0]),
                        pa.array(whole[:, 1]),
                        bands,
                        pa.array([m.tobytes() for m in marks], pa.binary()),
                    ],
                    ["doc_id", "text_key", "n_shingles", "set_hi", "set_lo", "bands", "marks"],
                )

    return sign


def _verifier(size: int, percent: int):
    """Keeps the pairs whose full sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", "text_b", limit=LIGHT_BYTES):
                n = part.num_rows
                left, of_left = shingle_sets(part.column("text_a"), size)
                right, of_right = shingle_sets(part.column("text_b"), size)
                value, owner = np.concatenate([left, right]), np.concatenate([of_left, of_right])
                order = np.lexsort((value, owner))
                value, owner = value[order], owner[order]
                twice = (value[1:] == value[:-1]) & (owner[1:] == owner[:-1])
                common = np.bincount(owner[1:][twice], minlength=n)
                union = np.bincount(owner, minlength=n) - common
                similar = pa.array(100 * common >= percent * union)
                yield part.select(["a", "b"]).filter(similar)

    return verify


def _own_text(size: int):
    """Drops texts of other rows that have the same doc_id."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", limit=LIGHT_BYTES):
                whole = set_digests(*shingle_sets(part.column("text"), size), part.num_rows)
                same = (whole[:, 0] == part.column("set_hi").to_numpy()) & (
                    whole[:, 1] == part.column("set_lo").to_numpy()
                )
                yield part.select(["node", "text"]).filter(pa.array(same))

    return own


def _likely(filled: np.ndarray, sizes: np.ndarray, limit: float) -> np.ndarray:
    """Share of agreeing bins from which a pair may reach similarity `limit`.

    The `filled` bins are a sample of the union, without repetition; `sizes` is
    the sum of both sets' sizes, which is 1 + limit times the union at the limit.
    """
    unseen = np.clip(1 - filled * (1 + limit) / sizes, 0.02, 1)
    return limit - DEVIATIONS * np.sqrt(limit * (1 - limit) / filled * unseen)


def _compared(batches: Iterator[pa.RecordBatch], limit: float) -> Iterator[pa.RecordBatch]:
    """Likely pairs within groups of (bucket, asked block, block), in rows sorted
    by group, each pair once; a group of about 2 x BLOCK rows is held at a time."""

    def pairs(group: pa.Table) -> pa.RecordBatch | None:
        node = group.column("node").to_numpy()
        part = group.column("component").to_numpy()
        n = group.column("n_shingles").to_numpy()
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        asked_too = group.column("asked_too").to_numpy(zero_copy_only=False)
        marks = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint8).reshape(-1, BINS)
        keys = group.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        band = group.column("band")[0].as_py()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        data = np.flatnonzero(~asks)
        for i in np.flatnonzero(asks):
            # Two members that both ask meet once.
            of = data[(part[data] != part[i]) & ~(asked_too[data] & (node[data] <= node[i]))]
            of = of[np.minimum(n[of], n[i]) >= limit * np.maximum(n[of], n[i])]
            # Of the buckets that two members share, the first band's compares them.
            of = of[(keys[of] == keys[i]).argmax(axis=1) == band]
            same = ((marks[of] == marks[i]) & (marks[i] != 0)).sum(axis=1)
            either = ((marks[of] | marks[i]) != 0).sum(axis=1)
            of = of[same >= either * _likely(either, n[of] + n[i], limit)]
            if len(of):
                found.append((np.minimum(node[of], node[i]), np.maximum(node[of], node[i])))
        if not found:
            return None
        a, b = (pa.array(np.concatenate(x)) for x in zip(*found, strict=True))
        return pa.record_batch([a, b], ["a", "b"])

    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "q", "d")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1 if len(keys) else []
        start = 0
        for stop in [*cuts, len(keys)]:
            if stop == start:
                continue
            if last is not None and (keys[start] != last).any():
                if (out := pairs(pa.Table.from_batches(kept))) is not None:
                    yield out
                kept = []
            kept.append(batch.slice(start, stop - start))
            last, start = keys[start], stop
    if kept and (out := pairs(pa.Table.from_batches(kept))) is not None:
        yield out


class _Texts:
    """Texts of classes, brought together for the pairs that need them."""

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> None:
        self.docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
        self.classes, self.size, self.percent = classes, size, percent
        self.repeated = not classes.where("copies > 1").isEmpty()

    def similar(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) of nodes, those that are similar by their full sets."""
        pairs = written(pairs, "pairs", slim=True)
        needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        first = self.classes.join(needed, "node").select(
            "node", "set_hi", "set_lo", "first_id"
        )
        texts = (
            self.docs.join(
                first.hint("shuffle_hash"),
                F.col("doc_id").eqNullSafe(F.col("first_id")),
            )
            .select("node", "set_hi", "set_lo", "text")
            .mapInArrow(_own_text(self.size), "node long, text string")
        )
        if self.repeated:
            texts = texts.groupBy("node").agg(F.min("text").alias("text"))
        texts = written(texts, "texts")
        side = lambda end: texts.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}"))
        return (
            pairs.join(side("b"), "b")
            .join(side("a"), "a")
            .select("a", "b", "text_a", "text_b")
            .mapInArrow(_verifier(self.size, self.percent), "a long, b long")
        )


def _star_edges(members: DataFrame) -> DataFrame:
    """Each bucket's members with its centre: the one that shares most buckets
    with others, so that one centre serves a group in all its bands."""
    degree = members.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = members.join(degree, "node").select(
        "bucket", "node", F.struct("degree", (-F.col("node")).alias("place")).alias("rank")
    )
    centre = ranked.groupBy("bucket").agg((-F.max("rank")["place"]).alias("centre"))
    return (
        members.join(centre, "bucket")
        .where("node != centre")
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        .distinct()
    )


def _comparer(percent: int):
    return lambda batches: _compared(batches, percent / 100)


def _open_pairs(
    members: DataFrame, parts: DataFrame, classes: DataFrame, percent: int
) -> DataFrame:
    """Likely pairs of bucket members that the stars left in different components.

    All members outside a bucket's largest component ask all its members, in
    blocks of at most about BLOCK on either side; the pairs are compared by
    their marks inside the task, and only likely ones leave it.
    """
    members = members.join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    members = written(members, "bucket-members", slim=True)
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = (
        sizes.groupBy("bucket")
        .agg(
            F.max(F.struct("n", "component")).alias("top"),
            F.sum("n").alias("n"),
        )
        .where("top.n < n")
        .select(
            "bucket",
            F.col("top.component").alias("largest"),
            F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("qs"),
            F.ceil(F.col("n") / BLOCK).cast("int").alias("ds"),
        )
    )
    facts = classes.select("node", "n_shingles", "marks", "bands")
    rows = members.select("bucket", "band", "node", "component").join(largest, "bucket").join(facts, "node")
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = F.col("component") != F.col("largest")
    columns = ["bucket", "q", "d", "asks", "asked_too", "node", "component"]
    columns += ["band", "n_shingles", "marks", "bands"]
    data = rows.withColumn("asks", F.lit(False)).withColumn("asked_too", asks)
    data = data.withColumn("d", deal("ds")).withColumn("q", each("qs")).select(columns)
    query = rows.where(asks).withColumn("asks", F.lit(True)).withColumn("asked_too", F.lit(True))
    query = query.withColumn("q", deal("qs")).withColumn("d", each("ds")).select(columns)
    return (
        data.unionByName(query)
        .repartition("bucket", "q", "d")
        .sortWithinPartitions("bucket", "q", "d")
        .mapInArrow(_comparer(percent), "a long, b long")
        .distinct()
    )


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept (and the
    component and a hash of the text).

    A document's set holds its distinct runs of `words` words (white space
    separates them, A-Z are lower-cased); with fewer words, all of them as one;
    without any, nothing, and then it is linked with nothing (component null). Documents are
    linked when 100 x intersection >= percent x union (`percent` at least 80:
    the bands are made for that). component_id is the smallest doc_id that can
    be reached, itself included, and a row is kept if that is its own. Null
    doc_ids come last; rows that repeat a doc_id are rows of their own. An empty
    table gives no rows; other columns are not read.

    Equal sets are one class from the start, so copies cost nothing further.
    Classes meet in banded buckets. First each bucket is a star: its centre is
    compared with every member, as many pairs as members. Pairs that the stars
    leave open, in different components, are then looked up by their marks,
    block by block, and likely ones compared as well, so a link between two
    members that are both unlike their centre is not lost. Every link is
    confirmed on the full sets.
    """
    if not 80 <= percent <= 100:
        raise ValueError(f"links are found from 80 percent on, not from {percent}")
    text = text_of(docs)
    signed = written(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            F.xxhash64(text).alias("text_key"),
            text.alias("text"),
        ).mapInArrow(_signer(words), SIGNED),
        "signatures",
    )
    some = signed.where("n_shingles > 0")
    one = ["set_hi", "set_lo"]
    ids = (
        some.groupBy(*one, "doc_id")
        .agg(F.count("*").alias("copies"))
        .groupBy(*one)
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "copies")).alias("first"))
        .select(*one, F.col("first.doc_id").alias("first_id"), "first.copies")
    )
    facts = some.groupBy(*one).agg(
        *(F.first(c).alias(c) for c in ("n_shingles", "bands", "marks"))
    )
    classes = written(
        ids.join(facts, one).withColumn("node", F.monotonically_increasing_id()),
        "classes",
        slim=True,
    )
    banded = classes.select("node", F.posexplode("bands").alias("band", "key")).select(
        "node", "band", F.xxhash64("band", "key").alias("bucket")
    )
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(banded.join(shared, "bucket"), "buckets", slim=True)
    texts = _Texts(docs, classes, words, percent)
    parts = components(texts.similar(_star_edges(members)))
    more = texts.similar(_open_pairs(members, parts, classes, percent))
    parts = components(parts.select("node", "component").union(more).toDF("a", "b"))
    part = classes.select(*one, "node", "first_id").join(parts, "node", "left")
    part = part.withColumn("component", F.coalesce("component", "node"))
    least = part.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_set = part.join(least, "component").select(*one, "component", "component_id")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        signed.select("doc_id", "n_shingles", "text_key", *one)
        .join(by_set, one, "left")
        .withColumn("component_id", component_id)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", "kept", "component", "text_key")
    )


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each component
    the row with the smallest doc_id, and all rows without words."""
    per_text = ["doc_id", "text_key"]
    rows = written(
        near_groups(docs, words, percent)
        .groupBy("component", *per_text)
        .agg(F.max("kept").alias("kept"), F.count("*").alias("copies")),
        "settled-rows",
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "copies")).alias("first")
    winners = (
        rows.where("component is not null and kept")
        .groupBy("component")
        .agg(first)
        .select("first.doc_id", "first.text_key", "first.copies")
    )
    wordless = rows.where("component is null").select(
        *per_text, F.lit(1).cast("long").alias("copies")
    )
    kept = written(winners.unionByName(wordless), "kept-rows")
    others = rows.select(*per_text).distinct()
    same = [others[c].eqNullSafe(kept[c]) for c in per_text]
    key = {"doc_id": docs["doc_id"].cast("long"), "text_key": F.xxhash64(text_of(docs))}
    return keep_rows(docs, key, kept, others.join(kept, same, "left_anti"))
