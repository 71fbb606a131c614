"""Language mixtures against a plain version, mixed texts, held-out accuracy."""

import re
import zlib
from collections import Counter
from math import exp, log, log1p

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartstream.llm import language_id
from cartstream.llm.language_id import identify, learn_languages, mixture
from cartstream.llm.queries import op13_language_mixture
from conftest import TESTDATA

from .conftest import docs_frame

ENGLISH = "the house of the king was on the hill and there they thought that nothing would ever change"
GERMAN = "der alte mann ging durch den wald und sah dort nichts als bäume schnee und den grauen himmel"
FRENCH = "la maison était près de la rivière où les enfants jouaient pendant que leur mère préparait le repas"


def words_of(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


class Plain:
    """The same model in dictionaries."""

    def __init__(self, rows):
        self.counts, self.totals = {}, Counter()
        for lang, text in rows:
            if lang is None:
                continue
            counts = self.counts.setdefault(lang, Counter())
            for word in words_of(text):
                line = b" " + word.encode() + b" "
                for i in range(1, len(line)):
                    self.totals[lang] += 1
                    for k in range(1, language_id.ORDER + 1):
                        if i - k + 1 >= 0:
                            counts[line[i - k + 1 : i + 1]] += 1
        self.names = sorted(self.counts)

    def units(self, word):
        """Log likelihoods by language of the word's units."""
        line, out = b" " + word.encode() + b" ", []
        for i in range(1, len(line)):
            row = []
            for lang in self.names:
                chance, counts = 1 / 256, self.counts[lang]
                for k in range(1, language_id.ORDER + 1):
                    if i - k + 1 < 0:
                        break
                    context = counts[line[i - k + 1 : i]] if k > 1 else self.totals[lang]
                    if k > 1 and i - k + 1 == 0 and k == 2:
                        context = counts[b" "]
                    n = counts[line[i - k + 1 : i + 1]]
                    chance = min((n + language_id.PRIOR * chance) / (context + language_id.PRIOR), 1)
                row.append(log(chance))
            if (i - 1) % language_id.UNIT == 0:
                out.append([0.0] * len(self.names))
            out[-1] = [a + b for a, b in zip(out[-1], row, strict=True)]
        return out

    def fit(self, units, allowed):
        shares = {a: 1 / len(allowed) for a in allowed}
        for _ in range(language_id.ROUNDS):
            new, logs = dict.fromkeys(allowed, 0.0), 0.0
            for unit in units:
                part = {a: shares[a] * unit[a] for a in allowed}
                whole = sum(part.values())
                logs += log(whole)
                for a in allowed:
                    new[a] += part[a] / whole / len(units)
            moved = max(abs(new[a] - shares[a]) for a in allowed)
            shares = new
            if moved <= language_id.SETTLED:
                break
        return shares, logs

    def judge(self, text):
        units = []
        for word in words_of(text):
            for row in self.units(word):
                units.append([exp(max(x - max(row), -language_id.FLOOR)) for x in row])
        if not units or not self.names:
            return "und", 0.0, []
        shares, _ = self.fit(units, list(range(len(self.names))))
        allowed = [a for a in shares if shares[a] * len(units) >= 0.5 or shares[a] == max(shares.values())]
        best = (-np.inf, None)
        while allowed:
            shares, logs = self.fit(units, allowed)
            value = logs - language_id.PENALTY * (len(allowed) - 1) * log1p(len(units))
            best = max(best, (value, tuple(shares.items())), key=lambda b: b[0])
            allowed.remove(min(allowed, key=lambda a: shares[a]))
        ranked = sorted(best[1], key=lambda s: (-s[1], s[0]))
        return self.names[ranked[0][0]], ranked[0][1], [self.names[a] for a, _ in ranked]


def training():
    rows = []
    for lang, text in (("en", ENGLISH), ("de", GERMAN), ("fr", FRENCH)):
        words = text.split()
        rows += [(lang, " ".join(words[i:] + words[:i])) for i in range(len(words))]
    return [*rows, (None, "qqq zzz"), ("fr", None), ("en", "")]


def with_lang(spark, rows):
    plain = docs_frame(spark, [(i, text) for i, (_, text) in enumerate(rows)])
    langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, l string")
    return plain.join(langs, "doc_id").withColumn("lang", F.col("l")).drop("l")


TEXTS = [
    ENGLISH, GERMAN, FRENCH, f"{ENGLISH} {GERMAN}", " ".join([GERMAN, FRENCH] * 4),
    " ".join([ENGLISH, GERMAN, FRENCH] * 5), "the", "", None, "12 34 !!", "é", "́ ́",
    "x" * 500, "王 東京都", f"{ENGLISH.upper()}!!! 99", "house&&& the*** king###",
]


def test_judgements_against_plain_version(llm_spark):
    rows = training()
    model = learn_languages(with_lang(llm_spark, rows))
    plain = Plain(rows)
    assert model.names == plain.names == ["de", "en", "fr"]
    docs = docs_frame(llm_spark, list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, GERMAN)])
    found = identify(docs, docs["doc_id"], model).collect()
    assert len(found) == len(TEXTS) + 2
    for row in found:
        text = GERMAN if row.carried is None else TEXTS[row.carried]
        lang, share, chosen = plain.judge(text)
        if text == "́ ́":  # marks without a letter
            lang, share, chosen = "und", 0.0, []
        assert (row.lang_pred, [x.lang for x in row.languages]) == (lang, chosen), text
        assert abs(row.score - share) < 0.02 and 0 <= row.score <= 1


def test_mixed_texts_keep_their_languages(llm_spark):
    model = learn_languages(with_lang(llm_spark, training()))
    rows = [(1, f"{ENGLISH} {GERMAN} {GERMAN}"), (2, ENGLISH), (3, f"{FRENCH} {GERMAN} {ENGLISH}")]
    docs = docs_frame(llm_spark, rows)
    found = {r.carried: {x.lang: x.share for x in r.languages} for r in identify(docs, docs["doc_id"], model).collect()}
    assert set(found[1]) == {"de", "en"} and 0.55 < found[1]["de"] < 0.75
    assert set(found[2]) == {"en"} and found[2]["en"] == 1
    assert set(found[3]) == {"de", "en", "fr"}


def test_expectation_maximisation_only_improves(monkeypatch):
    rng = np.random.default_rng(1)
    like = rng.random((300, 4)) ** 3 + 1e-6
    starts, times = np.array([0, 10, 200]), rng.integers(1, 5, 300)
    allowed = np.ones((3, 4))
    before = None
    for rounds in (1, 2, 4, 8, 16, 60):
        monkeypatch.setattr(language_id, "ROUNDS", rounds)
        shares, logs = mixture(like, times, starts, allowed)
        assert np.allclose(shares.sum(axis=1), 1)
        assert before is None or (logs >= before - 1e-9).all()
        before = logs


def test_smaller_tables_and_few_held_languages(llm_spark, monkeypatch):
    rows = with_lang(llm_spark, training())
    whole = learn_languages(rows)
    monkeypatch.setattr(language_id, "HELD", 1)
    assert (learn_languages(rows).counts == whole.counts).all()
    monkeypatch.setattr(language_id, "MODEL_CELLS", 3 << 16)
    small = learn_languages(rows)
    assert len(small.counts) == 1 << 16
    assert (whole.counts.reshape(1 << 16, -1, 3).sum(axis=1) == small.counts).all()
    docs = docs_frame(llm_spark, [(0, ENGLISH), (1, GERMAN), (2, FRENCH)])
    found = identify(docs, docs["doc_id"], small).collect()
    assert {r.carried: r.lang_pred for r in found} == {0: "en", 1: "de", 2: "fr"}


def test_nothing_to_learn_from_and_odd_rows(llm_spark, awkward, empty):
    model = learn_languages(empty)
    assert model.names == []
    found = identify(awkward, awkward["doc_id"], model)
    assert found.count() == awkward.count()
    assert found.where("lang_pred != 'und' or score != 0 or size(languages) > 0").isEmpty()
    model = learn_languages(awkward)
    assert identify(empty, empty["doc_id"], model).isEmpty()
    found = identify(awkward, F.struct("*"), model)
    assert found.select("carried.*").columns == awkward.columns
    assert found.where("not coalesce(rlike(carried.text, '\\\\p{L}'), false) and lang_pred != 'und'").isEmpty()
    assert found.where("rlike(carried.text, '\\\\p{L}') and lang_pred = 'und'").isEmpty()


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query_names_held_out_languages(llm_spark, sf):
    folder = f"{TESTDATA}/{sf}"
    rows = op13_language_mixture(llm_spark, folder)
    docs = llm_spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = rows.join(docs, "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
