"""What a scoring worker holds does not grow with the texts that ask in a segment, nor
with the size of a filter."""

import pickle
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from cartstream.llm import suffix_tree
from cartstream.llm.filters import Filter, SharedFilter, key_filter
from cartstream.llm.suffix_tree import KINDS, SEQUENCES, WORDS, _answers, _packed

KEYS = np.arange(0, 4000, 2, dtype=np.int64)


def _batches(n_rows, n_keys):
    """One segment: the tree's keys, then rows of 3 texts each that ask for many."""
    yield _packed(WORDS, np.full(len(KEYS), 9, KINDS[WORDS]), KEYS, 1)
    yield _packed(SEQUENCES, np.full(len(KEYS), 0.5, KINDS[SEQUENCES]), KEYS, 1)
    for row in range(n_rows):
        keys = np.random.default_rng(row).integers(0, 8000, n_keys)
        yield _packed(row << 20, np.sort(keys % 3).astype(np.uint32), keys, 1)


def test_a_segment_is_answered_row_by_row():
    peaks = []
    for n_rows in (4, 60):
        tracemalloc.start()
        n = sum(batch.num_rows for batch in _answers(_batches(n_rows, 50_000)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert n == 3 * n_rows
    assert peaks[1] < 1.2 * peaks[0]


def test_answers_are_those_of_a_lookup():
    batches = [*_batches(2, 500)]
    out = pa.Table.from_batches([*_answers(iter(batches))])
    keys = np.concatenate([np.frombuffer(b.column("keys")[0].as_buffer(), np.int64) for b in batches[2:]])
    known = int(np.isin(keys, KEYS).sum())
    assert pc.sum(out["n_known"]).as_py() == known
    assert pc.sum(out["base"]).as_py() == pytest.approx(known)
    assert pc.sum(out["score"]).as_py() == pytest.approx(1.5 * known)


def test_workers_map_a_filter(llm_spark):
    """It passes what the filter passes, from the file that Spark has made of it."""
    keys = llm_spark.range(0, 50_000).selectExpr("xxhash64(id) AS key")
    made = key_filter(keys, 50_000)
    shared = SharedFilter(llm_spark.sparkContext, made)

    def seen(batches):
        mapped = isinstance(shared.value.bits.base, np.memmap)
        for batch in batches:
            held = shared.value.holds(batch.column("key").to_numpy())
            yield pa.record_batch([pa.array(held), pa.array([mapped] * len(held))], ["held", "mapped"])

    asked = llm_spark.range(0, 100_000).selectExpr("xxhash64(id) AS key")
    rows = asked.mapInArrow(seen, "held boolean, mapped boolean").toArrow()
    assert pc.all(rows["mapped"]).as_py()
    wanted = made.holds(asked.toArrow()["key"].to_numpy())
    assert pc.sum(rows["held"]).as_py() == int(wanted.sum()) < 60_000
    shared.destroy()


def test_a_filter_that_is_not_in_a_file_is_loaded(tmp_path):
    made = Filter.holding(np.arange(100, dtype=np.int64))
    other = tmp_path / "other"
    other.write_bytes(pickle.dumps("no array"))

    class Sent:
        value = made.bits

    for path in (None, str(other), str(tmp_path / "gone")):
        shared = SharedFilter.__new__(SharedFilter)
        shared.width, shared.bytes, shared.bits = made.width, len(made.bits), Sent()
        shared.bits._path = path
        assert shared.value.holds(np.arange(100, dtype=np.int64)).all()


def test_nothing_is_gathered_by_segment(small):
    texts = suffix_tree.encode_texts(small, small["doc_id"])
    scores = suffix_tree.score_texts(texts, suffix_tree.grow_tree(texts))
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan and "FlatMapGroups" not in plan
