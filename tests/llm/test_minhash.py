"""Near duplicates against a comparison of all pairs, and components of graphs."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cartstream.llm import minhash
from cartstream.llm.components import components
from cartstream.llm.minhash import near_dedup, near_groups, signatures
from cartstream.llm.text import shingle_sets

from .conftest import docs_frame, texts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1)))


class Forest:
    def __init__(self):
        self.above = {}

    def root(self, x):
        while self.above.get(x, x) != x:
            x = self.above[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.above[b] = a


def brute(rows, size):
    """For each row: its set's size and the smallest id it is linked with."""
    by_set = defaultdict(list)
    for doc_id, text in rows:
        by_set[shingle_set(text, size)].append(doc_id)
    sets = [s for s in by_set if s]
    forest = Forest()
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(i)
    shared = defaultdict(int)
    for members in holders.values():
        for x, i in enumerate(members):
            for j in members[:x]:
                shared[j, i] += 1
    for (i, j), n in shared.items():
        if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
            forest.join(i, j)
    least = {}
    for i, s in enumerate(sets):
        ids = [d for d in by_set[s] if d is not None]
        least.setdefault(forest.root(i), []).extend(ids)
    root_of = {s: forest.root(i) for i, s in enumerate(sets)}
    out = []
    for doc_id, text in rows:
        s = shingle_set(text, size)
        own = min(least[root_of[s]], default=None) if s else doc_id
        out.append((doc_id, len(s), own, doc_id == own))
    return sorted(out, key=repr)


def found(docs, size):
    rows = near_groups(docs, words=size).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["awkward", "small", "empty"])
@pytest.mark.parametrize("size", [4, 5])
def test_groups(request, name, size):
    docs = request.getfixturevalue(name)
    assert found(docs, size) == brute(texts_of(docs), size)


def edited(rng, words, share):
    out = list(words)
    for i in rng.sample(range(len(out)), int(share * len(out))):
        out[i] = f"n{rng.randrange(10**9)}"
    return out


def cloud(n, share):
    """Copies of one text with edits of their own: many are near the limit."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(300)]
    rows = [(i, " ".join(edited(rng, base, rng.uniform(0, share)))) for i in range(n)]
    others = [(n + i, " ".join(f"o{rng.randrange(10**6)}" for _ in range(50))) for i in range(40)]
    return rows + others


@pytest.mark.parametrize("block", [16, 512])
def test_links_that_the_star_misses(llm_spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = cloud(250, 0.08)
    assert found(docs_frame(llm_spark, rows), 4) == brute(rows, 4)


def test_chain_of_small_edits(llm_spark):
    rng = random.Random(2)
    words = [f"c{i}" for i in range(200)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = edited(rng, words, 0.02)
    result = found(docs_frame(llm_spark, rows), 4)
    assert result == brute(rows, 4) and {r[2] for r in result} == {0}


def test_one_row_of_each_group_stays(awkward, small):
    for docs in (awkward, small):
        kept = near_dedup(docs)
        assert kept.columns == docs.columns
        sets = [shingle_set(text, 5) for _, text in texts_of(kept)]
        assert len([s for s in sets if s]) == len({s for s in sets if s})
        expected = brute(texts_of(docs), 5)
        assert {d for d, _ in texts_of(kept)} >= {r[0] for r in expected if r[3]} - {None}
        wordless = sum(not shingle_set(t, 5) for _, t in texts_of(docs))
        assert sum(not s for s in sets) == wordless


def test_bands_and_marks():
    rng = random.Random(0)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base), " ".join(edited(rng, base, 0.02)), "one", "one", "two"]
    values, owner = shingle_sets(pa.array(texts), 4)
    keys, marks = signatures(values, owner, len(texts))
    assert (keys[0] == keys[1]).sum() > 10 and (keys[2] == keys[3]).all()
    assert not (keys[2] == keys[4]).any() and (marks[2] > 0).sum() == 1
    alone = signatures(*shingle_sets(pa.array(texts[1:2]), 4), 1)
    assert np.array_equal(alone[0][0], keys[1]) and np.array_equal(alone[1][0], marks[1])


@pytest.mark.parametrize("seed", range(3))
def test_components(llm_spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(100)]
    forest = Forest()
    for a, b in edges:
        forest.join(a, b)
    expected = {x: forest.root(x) for a, b in edges if a != b for x in (a, b)}
    frame = llm_spark.createDataFrame(edges, "a long, b long")
    rows = components(frame).collect()
    assert {r.node: r.component for r in rows} == expected and len(rows) == len(expected)


def test_no_links(llm_spark):
    assert components(llm_spark.createDataFrame([], "a long, b long")).isEmpty()


@pytest.mark.parametrize("percent", [0, 79, 101])
def test_links_that_the_bands_may_miss_are_refused(small, percent):
    with pytest.raises(ValueError, match="80 percent"):
        near_groups(small, percent=percent)
