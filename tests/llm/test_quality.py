"""The ranking: held-out accuracy, and rows it must not trip over."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cartstream.llm import quality_ranking
from cartstream.llm.quality_ranking import WIDTH, accepted, features, fit, learn, score
from cartstream.llm.queries import op1_quality_ranking
from conftest import TESTDATA

from .conftest import awkward_rows


def test_held_out_labels(llm_spark):
    folder = f"{TESTDATA}/sf0.1"
    labels = llm_spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    scored = op1_quality_ranking(llm_spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    right = scored.predicted == scored.quality
    good, bad = scored[scored.quality == 1].score, scored[scored.quality == 0].score
    ranked = (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean()
    assert len(bad) > 50 and ranked > 0.97
    assert right[scored.quality == 1].mean() > 0.95 and right[scored.quality == 0].mean() > 0.85


def test_fold_and_range(llm_spark):
    import zlib

    rows = op1_quality_ranking(llm_spark, f"{TESTDATA}/sf0.001").collect()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)


def test_awkward_rows(llm_spark, awkward):
    labels = llm_spark.createDataFrame(
        [(7, 1), (7, 1), (13, 0), (None, 1), (8, None), (9, 5), (99_999, 0), (10, 1)],
        "doc_id long, quality int",
    )
    ranking = learn(awkward, labels)
    assert score(awkward, awkward["doc_id"], ranking).count() == len(awkward_rows())
    kept = accepted(awkward, ranking)
    assert kept.columns == awkward.columns
    assert score(awkward, F.col("doc_id"), ranking).where("score is null").isEmpty()


def test_no_labels_accept_everything(llm_spark, awkward, empty):
    ranking = learn(awkward, llm_spark.createDataFrame([], "doc_id long, quality int"))
    assert accepted(awkward, ranking).count() == len(awkward_rows())
    assert accepted(empty, ranking).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = ["", None, "ab", "One two, THREE!!", "é 1", "One two, THREE!!"]
    together = features(pa.array(texts, pa.string()))
    apart = np.concatenate([features(pa.array([t], pa.string())) for t in texts])
    assert together.shape == (6, WIDTH) and np.allclose(together, apart)


def test_threshold_is_the_quantile_of_the_rejected_share():
    rng = np.random.default_rng(0)
    better, worse = np.zeros((200, WIDTH)), np.zeros((100, WIDTH))
    better[:, 0], worse[:, 0] = rng.normal(2, 1, 200), rng.normal(-2, 1, 100)
    ranking = fit(better, worse, 1 / 3)
    below = (np.concatenate([better, worse]) @ ranking.weights < ranking.threshold).mean()
    assert abs(below - 1 / 3) < 0.02 and ranking.weights[0] > 0


def test_fit_against_a_plain_bradley_terry_fit():
    """The same pairs one by one, by plain gradient descent down to the minimum."""
    rng = np.random.default_rng(5)
    direction = rng.normal(size=WIDTH) * (np.arange(WIDTH) < 6)
    rows = np.zeros((60, WIDTH))
    rows[:, :6] = rng.normal(size=(60, 6))
    strength = rows @ direction + rng.normal(size=60)
    preferred, rejected = rows[strength > 0.5], rows[strength <= 0.5]
    model = fit(preferred, rejected, 0.4)

    centre, spread = rows.mean(axis=0), rows.std(axis=0)
    scale = np.where(spread < 1e-9, np.inf, spread)
    better, worse = (preferred - centre) / scale, (rejected - centre) / scale
    pairs = [
        (better[n * 7919 % len(better)], worse[n % len(worse)])
        for n in range(len(worse) * quality_ranking.PAIRS_PER_ROW)
    ]

    def loss(w):
        total = sum(np.log1p(np.exp(-(a - b) @ w)) for a, b in pairs)
        return total / len(pairs) + quality_ranking.RIDGE / 2 * (w @ w)

    w = np.zeros(WIDTH)
    for _ in range(3000):
        gradient = quality_ranking.RIDGE * w
        for a, b in pairs:
            gradient = gradient - (a - b) / (1 + np.exp((a - b) @ w)) / len(pairs)
        w = w - 2.0 * gradient
        if np.abs(gradient).max() < 1e-6:
            break
    own = model.weights * np.where(spread < 1e-9, 0, spread)
    assert loss(own) <= loss(w) * 1.01 + 1e-4
    expected, actual = rows @ (w / scale), rows @ model.weights
    assert np.corrcoef(expected, actual)[0, 1] > 0.999
    # Each class at its true share, about 0.4 of the rows lie below the threshold.
    below = np.array([(x @ model.weights < model.threshold).mean() for x in (preferred, rejected)])
    assert abs(below @ [0.6, 0.4] - 0.4) < 0.05
