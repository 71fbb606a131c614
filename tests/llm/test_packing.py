"""Packing: an exact round trip of the pieces, and few sequences."""

import random
import zlib
from collections import defaultdict
from math import ceil

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartstream.llm import packing
from cartstream.llm.packing import best_fit, pack_documents, pack_items

from .conftest import texts_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_packing(docs, rows, capacity):
    model = Tokenizer.from_file(PATH)
    pieces = defaultdict(list)
    for doc_id, text in texts_of(docs):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) - (ceil(len(ids) / capacity) - 1) * capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            pieces[(doc_id, k, a, b - a, crc)].append(1)
    actual = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        actual[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)].append(1)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert actual == pieces
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(r.length for r in rows)


@pytest.mark.parametrize("name", ["awkward", "small", "empty"])
@pytest.mark.parametrize("per_task", [30, 50_000])
def test_round_trip(request, monkeypatch, name, per_task):
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", per_task)
    docs = request.getfixturevalue(name)
    n, total = check_packing(docs, pack_documents(docs, PATH).collect(), 1024)
    if name == "small" and per_task == 50_000:
        assert n <= 1.01 * total / 1024 + 1


def test_short_sequences(awkward):
    check_packing(awkward, pack_documents(awkward, PATH, capacity=16).collect(), 16)


def test_best_fit_takes_the_tightest_bin():
    bins, places, used = best_fit(np.array([5, 7, 3, 2, 5]), 10)
    assert used.tolist().count(10) == 2 and used.sum() == 22
    assert bins[1] == bins[2] and places[2] == 7


def test_rounds_join_what_tasks_left_open(llm_spark, monkeypatch):
    rng = random.Random(1)
    sizes = [(i, rng.choice([1, 40, 300, 520, 700, 1023])) for i in range(4000)]
    items = llm_spark.createDataFrame(sizes, "item long, size long")

    def sequences():
        return pack_items(items, 1024).select("sequence").distinct().count()

    whole = sequences()
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", 100)
    assert sequences() <= 1.01 * whole + 2


def test_items_that_never_fit_together_end_the_rounds(llm_spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", 50)
    items = llm_spark.range(1000).selectExpr("id AS item", "600L AS size")
    assert pack_items(items, 1024).select("sequence").distinct().count() == 1000
