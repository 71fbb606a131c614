"""Phrases against plain counting, the SQL, and what the scans count when."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cartstream.llm import collocations as module
from cartstream.llm import filters
from cartstream.llm.collocations import collocations
from cartstream.llm.filters import heavy_filter, key_column, key_filter, width_for
from cartstream.llm.queries import phrases_sql, queries
from compare import assert_same
from conftest import TESTDATA

from .conftest import SCHEMA, awkward_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        wanted = [p for p in f if len(p) > 1 and f[p] >= least]
        inside = set()
        for q in wanted:
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    p = q[i : i + k]
                    if 100 * f[q] >= 100 * f[p]:
                        inside.add(p)
        rows = []
        for p in wanted:
            if p in inside:
                continue
            score, _, left, right = min(
                (1000 * f[p] * n[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                for k in range(1, len(p))
            )
            rows.append((-score, -f[p], " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def frame(spark, rows, parts=3):
    filler = ("s", 1, None, True, "d", "c", 5)
    docs = spark.createDataFrame([(i, text, lang, *filler) for i, (lang, text) in enumerate(rows)], SCHEMA)
    return docs.repartition(parts)


def found(docs, **options):
    return sorted(tuple(row) for row in collocations(docs, **options).collect())


def corpus(seed):
    """Fixed phrases of all lengths among words of all frequencies, in languages
    that share words; some phrases only in a part of the corpus."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Übung", "A_b", "x\u0085y", "\x00"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = [rng.sample(words, k) for k in (2, 3, 4, 5, 5, 7)]
    rows = []
    for i in range(400):
        out = []
        for _ in range(rng.randint(0, 12)):
            if rng.random() < 0.3:
                out += rng.choice(fixed[: 3 if i < 150 else 6])
            out += rng.choices(words, weights, k=rng.randint(0, 6))
            out.append(rng.choice(["", ".", ",", "\n", "\t", "!?", "\x0b"]))
        text = " ".join(out)
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text if rng.random() < 0.95 else None))
    return [*rows, ("en", "go go go go go go " * 50), ("fr", None), ("de", "A,b;c")]


@pytest.mark.parametrize("least,top,n_shards", [(5, 2000, 3), (12, 7, 2), (30, 50, 1)])
def test_against_plain_counting(llm_spark, monkeypatch, least, top, n_shards):
    monkeypatch.setattr(module, "HELD", 300)
    monkeypatch.setattr(filters, "HELD", 300)
    rows = corpus(least)
    expected = plain(rows, least, top)
    assert len(expected) > 6
    assert found(frame(llm_spark, rows, 5), least=least, top=top, n_shards=n_shards) == expected


def test_rows_of_all_kinds(llm_spark, empty, awkward):
    assert found(empty) == []
    rows = [("en", text) for _, text in awkward_rows()]
    expected = plain(rows, 20, 2000)
    assert expected and found(awkward, least=20) == expected


def test_pieces_separate(llm_spark):
    rows = [("en", "new york, new york. New\tYork; york new")] * 10
    expected = [("en", 1, "new york", 30, 40, 40, 80, 1500), ("en", 2, "york new", 10, 40, 40, 80, 500)]
    assert found(frame(llm_spark, rows), least=10, n_shards=2) == expected


def test_products_beyond_64_bits(llm_spark):
    a, n, left, right = 5 * 10**9, 10**15, 3 * 10**10 + 1, 7 * 10**9 + 3
    row = llm_spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert row.select(module.score()).first()[0] == 1000 * a * n // (left * right)


def test_filters_keep_all_their_keys(llm_spark, monkeypatch):
    monkeypatch.setattr(filters, "HELD", 1000)
    rng = np.random.default_rng(2)
    keys = rng.integers(-(2**63), 2**63, 4000)
    times = rng.integers(1, 40, 4000)
    rows = llm_spark.createDataFrame([(int(k),) for k in np.repeat(keys, times)], "key long").repartition(4)
    heavy = heavy_filter(rows, key_column, 20, width_for(1 << 18))
    passed = heavy.holds(keys)
    assert passed[times >= 20].all() and passed[times < 20].mean() < 0.05
    every = key_filter(rows.distinct(), 4000)
    assert every.holds(keys).all() and every.holds(rng.integers(-(2**63), 2**63, 4000)).mean() < 0.1


def test_query_equals_sql(llm_spark):
    folder = f"{TESTDATA}/sf0.01"
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    n = assert_same(queries()["op11_phrase_collocations"](llm_spark, folder), database, phrases_sql())
    assert n > 50


def test_sql_equals_plain_counting():
    rows = corpus(3)
    database = duckdb.connect()
    database.execute("CREATE TABLE documents (lang VARCHAR, text VARCHAR)")
    database.executemany("INSERT INTO documents VALUES (?, ?)", [r for r in rows if "\x00" not in (r[1] or "")])
    names = "lang, rank, phrase, a, l, r, n, score"
    result = database.execute(f"SELECT {names} FROM ({phrases_sql(12, 40)})").fetchall()
    assert sorted(result) == plain([r for r in rows if "\x00" not in (r[1] or "")], 12, 40)


def test_frame_has_no_extra_columns(llm_spark):
    docs = frame(llm_spark, [("en", "a b " * 200)]).withColumn("phrase", F.lit(1)).withColumn("key", F.lit(2))
    rows = collocations(docs, n_shards=1)
    assert rows.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(row) for row in rows.collect()) == plain([("en", "a b " * 200)], 100, 2000)


def test_a_scan_is_added_up_in_one_shuffle(llm_spark):
    """With a partition for each hash, every shuffle of a scan counts: the check's table
    of large groups has 211 of them."""
    rows = [  # length, key, n, start, end, scan; of two shards, the first scanned twice
        *((2, 1, n, 7, 8, scan) for n, scan in ((6, 0), (3, 1), (6, 2))),
        *((2, 2, n, 7, 9, scan) for n, scan in ((6, 0), (4, 1), (6, 2))),
        *((2, 3, n, 9, 7, scan) for n, scan in ((5, 1), (5, 2))),
        *((5, 4, n, 2, 3, scan) for n, scan in ((9, 1), (9, 2))),
    ]
    counted = llm_spark.createDataFrame(rows, f"{module.COUNTS}, scan int")
    totals, new = module._totals(counted, 10, 2), module._newly_reached(counted, 10, 2, 2)
    assert sorted(map(tuple, totals.collect())) == [(2, 2, 10, 7, 9), (2, 3, 10, 9, 7), (5, 4, 18, 2, 3)]
    assert [row["key"] for row in new.collect()] == [3]
    for frame_ in (totals, new):
        plan = frame_._jdf.queryExecution().sparkPlan().toString()
        assert "Join" not in plan
        plan = frame_._jdf.queryExecution().executedPlan().initialPlan().toString()
        assert plan.count("Exchange") == 1
