"""Document quality by Bradley-Terry ranking of preference pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartstream.llm.tables import text_of
from cartstream.llm.text import (
    LIGHT_BYTES,
    SPACE,
    slices,
    split_words,
    text_bytes,
    white_space_table,
)

# Labelled rows of each class that the model is fitted on, at most: those with
# the smallest hashes of their doc_id. Their features (about 4 kB a row) are all
# that comes to the driver.
FIT_ROWS = 4000

# Preferred rows that each rejected row is paired with.
PAIRS_PER_ROW = 16

# Rounds of gradient descent, and the weight of the squared length penalty.
ROUNDS = 300
RIDGE = 1e-3

# A text is accepted when its score is at least this.
ACCEPT = 0.3

# Hash buckets for runs of three bytes.
BUCKETS = 512

# Bytes below which a text's triples count for much less.
SHORT = 200
MEASURES = 13
WIDTH = BUCKETS + MEASURES


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.float64)


def features(texts: pa.Array) -> np.ndarray:
    """One row of WIDTH numbers per text: measures of its characters and words,
    and the square roots of the shares of hashed byte triples, which count for
    less where a text is too short for shares to mean much. Empty: zeros."""
    data, bounds = text_bytes(texts)
    n, sizes = len(bounds) - 1, np.diff(bounds).astype(np.float64)
    out = np.zeros((n, WIDTH))
    if not len(data):
        return out
    size = np.maximum(sizes, 1)
    upper = _per_text((data >= 65) & (data <= 90), bounds)
    lower = _per_text((data >= 97) & (data <= 122), bounds)
    digit = _per_text((data >= 48) & (data <= 57), bounds)
    blank = _per_text((data == SPACE) | (data == 10), bounds)
    beyond = _per_text(data >= 128, bounds)
    words = split_words(texts, white_space_table())
    n_words = np.diff(words.starts).astype(np.float64)
    owner = words.owners()
    pair, count = np.unique(owner * max(len(words.distinct), 1) + words.codes, return_counts=True)
    of = pair // max(len(words.distinct), 1)
    top = np.zeros(n)
    np.maximum.at(top, of, count)
    some = np.maximum(n_words, 1)
    echo = np.zeros(len(words.codes), bool)
    echo[1:] = (words.codes[1:] == words.codes[:-1]) & (owner[1:] == owner[:-1])
    echoes = np.bincount(owner[echo], minlength=n)
    repeated = np.zeros(len(data), bool)
    repeated[1:] = data[1:] == data[:-1]
    measures = [
        np.log1p(n_words), (size - blank) / some, upper / np.maximum(upper + lower, 1),
        digit / size, (sizes - upper - lower - digit - blank - beyond) / size, blank / size,
        beyond / size, np.bincount(of, minlength=n) / some, top / some,
        _per_text(repeated, bounds) / size, np.sqrt(some) * np.bincount(of, minlength=n) / some,
        echoes / some, np.sqrt(echoes / some),
    ]
    out[:, :MEASURES] = np.stack(measures, axis=1) * (sizes > 0)[:, None]
    if len(data) > 2:
        triple = data[:-2].astype(np.uint32) << 16 | data[1:-1].astype(np.uint32) << 8 | data[2:]
        bucket = (triple * np.uint32(2654435761)) >> np.uint32(32 - 9)
        text = np.repeat(np.arange(n), sizes.astype(np.int64))[:-2]
        inside = np.arange(len(triple)) + 2 < bounds[1:][text]
        flat = np.bincount((text * BUCKETS + bucket)[inside], minlength=n * BUCKETS)
        out[:, MEASURES:] = np.sqrt(flat.reshape(n, BUCKETS) / (size[:, None] + SHORT))
    return out


@dataclass
class Ranking:
    """score = 1 / (1 + exp(-(strength - threshold)) x (1 - ACCEPT) / ACCEPT), so
    that a text of strength `threshold` gets just ACCEPT."""

    weights: np.ndarray
    threshold: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        # Summed text by text: equal texts score alike whatever they are scored with.
        strength = np.einsum("ij,j->i", features(texts), self.weights)
        strength = np.clip(strength - self.threshold, -500, 500)
        return 1 / (1 + np.exp(-strength) * (1 - ACCEPT) / ACCEPT)


def fit(preferred: np.ndarray, rejected: np.ndarray, rejected_share: float) -> Ranking:
    """Bradley-Terry strengths w·x from pairs: -log sigmoid(w·(better - worse)).

    The threshold is the quantile of strength, over the labelled rows with each
    class at its true share, below which `rejected_share` of them lie. Without
    rows of both classes all strengths are 0 and every text is accepted.
    """
    if not len(preferred) or not len(rejected):
        return Ranking(np.zeros(WIDTH), 0.0)
    rows = np.concatenate([preferred, rejected])
    centre, spread = rows.mean(axis=0), rows.std(axis=0)
    spread[spread < 1e-9] = np.inf
    x = (rows - centre) / spread
    better = np.arange(len(rejected) * PAIRS_PER_ROW) * 7919 % len(preferred)
    worse = np.tile(np.arange(len(rejected)), PAIRS_PER_ROW) + len(preferred)
    w, slope, square = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH)
    for step in range(1, ROUNDS + 1):  # Adam over all pairs
        strength = x @ w
        doubt = 1 / (1 + np.exp(np.clip(strength[better] - strength[worse], -50, 50)))
        pull = np.bincount(worse, doubt, len(x)) - np.bincount(better, doubt, len(x))
        gradient = x.T @ pull / len(better) + RIDGE * w
        slope = 0.9 * slope + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        w -= 0.05 * slope / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    strength = x @ w
    order = np.argsort(strength, kind="stable")
    share = np.concatenate(
        [
            np.full(len(preferred), (1 - rejected_share) / len(preferred)),
            np.full(len(rejected), rejected_share / len(rejected)),
        ]
    )[order]
    at = int(np.searchsorted(np.cumsum(share) - share / 2, rejected_share))
    at = min(max(at, 1), len(x) - 1)
    threshold = (strength[order[at - 1]] + strength[order[at]]) / 2
    weights = w / spread
    return Ranking(weights, float(threshold + centre @ weights))


def _featurer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", limit=LIGHT_BYTES):
            rows = features(part.column("text")).astype(np.float32)
            packed = pa.array([row.tobytes() for row in rows], pa.binary())
            yield pa.record_batch(
                [part.column("doc_id").cast(pa.string()), part.column("quality"), packed],
                ["doc_id", "quality", "features"],
            )


def learn(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Ranking:
    """A ranking from `labels` (doc_id, quality 1 or 0); a better row of class 1
    is preferred to one of class 0. `usable` says, by doc_id, which labels count.

    Labels that are null, or have no row in `docs`, are left out; repeated rows
    count once. Fitted on at most FIT_ROWS documents of each class.
    """
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        "doc_id is not null and quality in (0, 1)"
    )
    if usable is not None:
        labels = labels.where(usable)
    counts = dict(labels.groupBy("quality").count().collect())
    by_hash = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    sample = labels.where("quality = 0").distinct().orderBy(*by_hash).limit(FIT_ROWS)
    sample = sample.unionByName(
        labels.where("quality = 1").distinct().orderBy(*by_hash).limit(FIT_ROWS)
    )
    # At most 2 x FIT_ROWS rows.
    rows = (
        docs.select("doc_id", text_of(docs).alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .select("doc_id", "quality", "text")
        .mapInArrow(_featurer, "doc_id string, quality int, features binary")
        .groupBy("doc_id", "quality")
        .agg(F.min("features").alias("features"))
        .collect()
    )
    rows.sort(key=lambda row: (row["quality"], row["doc_id"]))
    unpack = lambda q: np.array(
        [np.frombuffer(r["features"], np.float32) for r in rows if r["quality"] == q], np.float64
    ).reshape(-1, WIDTH)
    share = counts.get(0, 0) / max(sum(counts.values()), 1)
    return fit(unpack(1), unpack(0), share)


def _scorer(ranking: Ranking):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", limit=LIGHT_BYTES):
                values = pa.array(ranking.scores(part.column("text")), pa.float64())
                yield pa.record_batch([part.column("carried"), values], ["carried", "score"])

    return scored


def score(docs: DataFrame, carried: Column, ranking: Ranking) -> DataFrame:
    """Per row of `docs`: `carried` and its score from 0 to 1.

    Null text is empty; a very long one is scored whole, in one task. Repeated rows
    are scored like others; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(carried.alias("carried"), text_of(docs).alias("text"))
    schema = StructType([rows.schema["carried"]]).add("score", "double")
    return rows.mapInArrow(_scorer(ranking), schema)


def accepted(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The rows of `docs` that score at least ACCEPT, with all their columns, whatever
    their names. Rows of one text stay or go together, ties of score included."""
    return score(docs, F.struct("*"), ranking).where(F.col("score") >= ACCEPT).select("carried.*")
