"""The search against a comparison of every window."""

import hashlib
import random
import re
from collections import Counter

import pytest

from cartstream.llm import decontaminate
from cartstream.llm.decontaminate import contamination
from conftest import TESTDATA

from .conftest import texts_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1) if size else ():
            windows.setdefault(tuple(w[i : i + size]), set()).update([item] if item else [])
    sizes = {len(w) for w in windows}
    out = Counter()
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[(doc_id, len(w), len(hit), len(found), digest, bool(hit))] += 1
    return out


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string, spans string")


AWKWARD_ITEMS = [
    ("a", "one two three", None), ("b", "", None), ("c", None, None), (None, "it's", None),
    ("d", "w1", None), ("e", "W2 w3", None), ("f", "w1", None), ("d", "w1", None),
    ("g", "mixed spaces here", None), ("h", "🙂 🙂🙂", None),
]


@pytest.mark.parametrize("name", ["awkward", "empty"])
@pytest.mark.parametrize("pass_bytes", [20, 8 << 20])
def test_awkward_items(request, monkeypatch, llm_spark, name, pass_bytes):
    monkeypatch.setattr(decontaminate, "PASS_BYTES", pass_bytes)
    docs = request.getfixturevalue(name)
    rng = random.Random(3)
    long_text = max((t or "" for _, t in texts_of(docs)), key=len, default="")
    quoted = " ".join(long_text.split()[100:130])
    rows = [*AWKWARD_ITEMS, ("q", quoted, None), ("r", f"{quoted} w1 {rng.random()}", None)]
    found = contamination(docs, items_of(llm_spark, rows))
    assert Counter(map(tuple, found.collect())) == brute(
        texts_of(docs), [r[:2] for r in rows], 10
    )


def test_no_items(llm_spark, awkward):
    found = contamination(awkward, items_of(llm_spark, [])).collect()
    assert found and not any(row.contaminated for row in found)


@pytest.mark.parametrize("window", [1, 3, 10])
def test_given_tables(llm_spark, small, window):
    items = llm_spark.read.parquet(f"{TESTDATA}/sf0.001/benchmark.parquet")
    expected = brute(
        texts_of(small), [(str(r.item_id), r.text) for r in items.collect()], window
    )
    found = Counter(map(tuple, contamination(small, items, window).collect()))
    assert found == expected
    assert any(row[5] for row in found)


def test_only_clean_rows_stay(llm_spark, small):
    items = llm_spark.read.parquet(f"{TESTDATA}/sf0.001/benchmark.parquet")
    clean = decontaminate.decontaminate(small, items)
    assert clean.columns == small.columns
    flagged = {r.doc_id for r in contamination(small, items).where("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in texts_of(small)} - flagged
