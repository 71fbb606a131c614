"""Exact duplicates, shards and token counts against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from cartstream.llm import exact_dedup
from cartstream.llm.exact_dedup import exact_groups
from cartstream.llm.queries import oracle_sql, queries
from cartstream.llm.sharding import assign_shards
from cartstream.llm.token_cache import cached_counts, token_counts
from compare import assert_same
from conftest import TESTDATA

from .conftest import texts_of

BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")
SETS = ["awkward", "small", "empty"]


def rows_of(frame):
    return Counter(tuple(row) for row in frame.collect())


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(BLANK)].append((doc_id, text or ""))
    out = Counter()
    for plain, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        digest = hashlib.sha256(plain.encode()).hexdigest()
        members.remove(best)
        out[(best[0], best[0], len(members) + 1, True, digest)] += 1
        for doc_id, _ in members:
            out[(doc_id, best[0], len(members) + 1, False, digest)] += 1
    return out


@pytest.mark.parametrize("name", SETS)
@pytest.mark.parametrize("heavy", [4, 1000])
def test_exact_groups(request, monkeypatch, name, heavy):
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    docs = request.getfixturevalue(name)
    assert rows_of(exact_groups(docs).drop("shorter")) == plain_groups(texts_of(docs))


@pytest.mark.parametrize("name", SETS)
def test_exact_dedup_keeps_one_whole_row_a_group(request, name):
    docs = request.getfixturevalue(name)
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    expected = Counter()
    for (doc_id, _, _, stays, digest), n in plain_groups(texts_of(docs)).items():
        expected[(doc_id, digest)] += n if stays else 0
    actual = Counter(
        (doc_id, hashlib.sha256((text or "").translate(BLANK).encode()).hexdigest())
        for doc_id, text in texts_of(kept)
    )
    assert actual == +expected


def test_heavy_digests_are_not_shuffled(small):
    plan = exact_groups(small)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def plain_shard(doc_id, shards):
    key = "n" if doc_id is None else f"k{doc_id}"
    first = xxhash.xxh64_intdigest(key.encode(), seed=42)
    unit = [
        ((xxhash.xxh64_intdigest((i).to_bytes(4, "little"), seed=first) >> 11) + 0.5) * 2.0**-53
        for i in range(shards)
    ]
    return max(range(shards), key=lambda i: unit[i])


@pytest.mark.parametrize("name", SETS)
def test_shards(request, name):
    docs = request.getfixturevalue(name)
    rows = assign_shards(docs, 16).collect()
    expected = Counter(
        (
            doc_id, len((text or "").encode()) + 1, zlib.crc32((text or "").encode()), "key",
            plain_shard(doc_id, 16), plain_shard(doc_id, 17),
        )
        for doc_id, text in texts_of(docs)
    )
    assert expected == Counter(
        (r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in rows
    )
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r.grown_shard in (r.shard, 16) for r in rows)


def test_weights_set_the_shares(llm_spark):
    docs = llm_spark.range(8000).selectExpr("id AS doc_id", "'t' AS text")
    shares = Counter(r.shard for r in assign_shards(docs, 3, [1.0, 1.0, 2.0]).collect())
    assert 3700 < shares[2] < 4300 and 1800 < shares[0] < 2200


def tokenizer_counts(name, texts):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(model.encode(text)) for text in texts]
    model = Tokenizer.from_file(path)
    model.no_padding()
    model.no_truncation()
    return [len(model.encode(text, add_special_tokens=False).ids) for text in texts]


@pytest.mark.parametrize("tokenizer", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
@pytest.mark.parametrize("name", SETS)
def test_token_counts(request, folder, name, tokenizer):
    docs = request.getfixturevalue(name)
    rows = texts_of(docs)
    counts = tokenizer_counts(tokenizer, [text or "" for _, text in rows])
    expected = Counter(
        (doc_id, len((text or "").encode()), n, n > 1024)
        for (doc_id, text), n in zip(rows, counts, strict=True)
    )
    cache = f"{folder}/cache"
    path = public_tokenizers.path(tokenizer)
    assert rows_of(token_counts(docs, path, cache)) == expected
    entries = cached_counts(docs, cache).count()
    assert entries == len({text or "" for _, text in rows})
    assert rows_of(token_counts(docs, path, cache)) == expected
    assert cached_counts(docs, cache).count() == entries  # nothing is encoded twice


def test_cache_is_used_and_kept_apart(small, folder):
    cache = f"{folder}/cache"
    first = public_tokenizers.path("byte_bpe_50k.json")
    other = public_tokenizers.path("word_bpe_49k.json")
    half = small.where("doc_id % 2 = 0")
    token_counts(half, first, cache)
    before = cached_counts(small, cache).count()
    full = rows_of(token_counts(small, first, cache))
    assert cached_counts(small, cache).count() > before
    assert rows_of(token_counts(small, other, cache)) != full
    assert rows_of(token_counts(small, first, cache)) == full


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_over_the_tables(llm_spark, name):
    folder = f"{TESTDATA}/sf0.01"
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        connection.execute(f"CREATE VIEW {table} AS FROM read_parquet('{folder}/{table}.parquet')")
    assert assert_same(queries()[name](llm_spark, folder), connection, oracle_sql()[name])
