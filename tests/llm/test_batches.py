"""What a Python worker takes at once is bounded in bytes, not in rows alone."""

import numpy as np
import pyarrow as pa

from cartstream.llm import packing
from cartstream.llm.filters import MAX_BITS, _counts, _total
from cartstream.llm.packing import ENCODED_BYTES, pack_documents
from cartstream.llm.queries import TOKENIZER
from cartstream.llm.ship import BATCH_BYTES, BATCH_SETTING, bound_batches
from cartstream.llm.suffix_tree import ROW_BYTES


def _largest(spark, row_bytes, rows):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    texts = spark.range(0, rows, 1, 1).selectExpr(f"repeat('x', {row_bytes}) AS text")
    return max(row["n"] for row in texts.mapInArrow(sizes, "n long").collect())


def test_a_batch_holds_few_wide_rows(llm_spark):
    assert _largest(llm_spark, 1 << 20, 24) <= BATCH_BYTES + (2 << 20)


def test_rows_of_word_numbers_are_smaller_than_a_batch():
    assert 2 * ROW_BYTES < BATCH_BYTES


def test_the_setting_of_a_session_stays(llm_spark):
    own = llm_spark.newSession()
    own.conf.set(BATCH_SETTING, 3 << 20)
    bound_batches(own)
    assert own.conf.get(BATCH_SETTING) == str(3 << 20)


def test_counts_of_buckets_add_up_and_stop_at_a_byte():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 50, n) for n in (400, 1, 3000)] + [np.full(500, (1 << MAX_BITS) - 1)]
    held = _total([_counts(p) for p in parts])
    bucket, n = np.unique(np.concatenate(parts), return_counts=True)
    assert held.dtype.itemsize == 8  # a bucket with its count, not two numbers
    assert (held >> np.uint64(8)).tolist() == bucket.tolist()
    assert (held & np.uint64(255)).tolist() == np.minimum(n, 255).tolist()


def test_pieces_do_not_depend_on_how_much_is_encoded_together(awkward, monkeypatch):
    assert 4 * ENCODED_BYTES <= BATCH_BYTES
    some = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = [sorted(map(str, pack_documents(awkward, TOKENIZER).select(some).collect()))]
    monkeypatch.setattr(packing, "ENCODED_BYTES", 1000)
    rows.append(sorted(map(str, pack_documents(awkward, TOKENIZER).select(some).collect())))
    assert rows[0] == rows[1]
