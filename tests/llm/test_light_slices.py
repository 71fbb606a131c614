"""What a task holds beside its rows is a small multiple of a slice, not of a batch."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from cartstream.llm import quality_ranking
from cartstream.llm.decontaminate import Searcher, _finder
from cartstream.llm.minhash import _own_text, _signer, _verifier
from cartstream.llm.quality_ranking import WIDTH, Ranking, _featurer, _scorer
from cartstream.llm.ship import BATCH_BYTES

SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
WORDS = [f"word{n}" for n in range(500)]


def _texts(n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(WORDS[i] for i in rng.integers(0, len(WORDS), 300)) for _ in range(n)]


TEXTS = _texts(BATCH_BYTES // 2300, 1)
N = len(TEXTS)
NUMBERS = pa.array(range(N), pa.int64())
RANKING = Ranking(np.linspace(-1, 1, WIDTH), 0.0)
FINDER = _finder(SimpleNamespace(value=Searcher([("a", " ".join(WORDS[:12]))], 10)))

STEPS = {
    "features": (_featurer, {"doc_id": NUMBERS, "quality": NUMBERS}, "text"),
    "scores": (_scorer(RANKING), {"carried": NUMBERS}, "text"),
    "signatures": (_signer(5), {"doc_id": NUMBERS, "text_key": NUMBERS}, "text"),
    "own texts": (_own_text(5), {"node": NUMBERS, "set_hi": NUMBERS, "set_lo": NUMBERS}, "text"),
    "pairs": (_verifier(5, 80), {"a": NUMBERS, "b": NUMBERS}, "text_a", "text_b"),
    "passages": (
        FINDER,
        {
            "carried": NUMBERS,
            "spans": pa.array([[]] * N, SPANS),
            "items": pa.array([[]] * N, pa.list_(pa.string())),
        },
        "text",
    ),
}


@pytest.mark.parametrize("name", STEPS)
def test_memory_of_a_batch(name):
    step, columns, *texts = STEPS[name]
    columns = columns | {column: pa.array(TEXTS) for column in texts}
    batch = pa.record_batch(list(columns.values()), list(columns))
    tracemalloc.start()
    for _ in step(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak <= 6 * BATCH_BYTES


def test_a_score_does_not_depend_on_the_texts_beside_it(monkeypatch):
    texts = [*_texts(200, 2), "", "a", "short text", None, "word " * 5000]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["carried", "text"])
    scores = []
    for limit in (1, 3000, 1 << 30):
        monkeypatch.setattr(quality_ranking, "LIGHT_BYTES", limit)
        parts = _scorer(RANKING)(iter([batch]))
        scores.append(np.concatenate([p.column("score").to_numpy() for p in parts]).tolist())
    assert scores[0] == scores[1] == scores[2]
