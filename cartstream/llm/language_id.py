"""Languages of documents as mixtures, by expectation-maximisation.

Each language has a model of bytes: a byte's chance after the up to three before
it in its word, from counts over all training texts, higher orders resting on the
lower ones. A document is a mixture: each of its words is from one of the
languages, and what share each language has is found by expectation-maximisation
on the words' likelihoods. Languages are then taken out one at a time, the least
first, and the set of the best likelihood less a penalty for each language stays.

The counts are in hashed buckets, so the model has a fixed size whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartstream.llm.tables import text_of
from cartstream.llm.text import SPACE, mixed, slices, split_words

UNKNOWN = "und"

# Bytes of a word, the one in question included, that its chance depends on.
ORDER = 4

# Hash buckets of counts, fewer where there are many languages: the model has at
# most MODEL_CELLS counts of four bytes.
MAX_BUCKETS = 1 << 20
MODEL_CELLS = 1 << 25

# What a shorter context's chance weighs against a longer one's counts.
PRIOR = 4.0

# Bytes of a word that are taken from one language; longer words are several.
UNIT = 24

# Penalty, in nats times ln(1 + words), for each language after the first.
PENALTY = 2.0

ROUNDS = 60
SETTLED = 1e-4

# A likelihood this many nats below the word's best counts as just that.
FLOOR = 50.0

# Languages whose counts a task holds before it hands them on.
HELD = 24

LANGUAGES = "array<struct<lang: string, share: double>>"


def _letters(texts: pa.Array) -> pa.Array:
    """The texts' words of letters and marks, in lower case."""
    return pc.utf8_lower(pc.replace_substring_regex(texts.cast(pa.string()), r"[^\pL\pM]+", " "))


_AS_IT_IS = np.arange(256, dtype=np.uint8)


class Grams:
    """The byte runs of distinct words, by order, as hash buckets.

    The line holds the words with a space before and after each. `grams[k - 1]`
    are the buckets of the k bytes up to each place, -1 where these would begin
    before the word's own space.
    """

    def __init__(self, words: list[bytes]) -> None:
        line = np.frombuffer(b" ".join([b"", *words, b""]), np.uint8) if words else np.empty(0, np.uint8)
        spaces = np.flatnonzero(line == SPACE)
        sizes = np.diff(spaces)  # of the word with the space after it
        self.sizes = sizes
        self.word = np.repeat(np.arange(len(sizes)), sizes)
        self.inside = np.arange(len(self.word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        byte = line.astype(np.uint64)
        self.hashes = []
        value = np.zeros(max(len(line) - 1, 0), np.uint64)
        for k in range(1, ORDER + 1):
            # Place i of the line is 1 + i here: the first space ends no word.
            back = np.maximum(np.arange(1, len(line)) - (k - 1), 0)
            value = value | byte[back] << np.uint64(8 * (k - 1))
            there = self.inside + 2 >= k
            self.hashes.append((mixed(value + np.uint64(k << 40)), there))

    def buckets(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        shift = np.uint64(64 - (n.bit_length() - 1))
        return [((value >> shift).astype(np.int64), there) for value, there in self.hashes]


@dataclass
class Languages:
    """`counts[bucket, language]`, of all orders together."""

    names: list[str]
    counts: np.ndarray

    def _of(self, single: np.ndarray) -> np.ndarray:
        """Counts of single bytes."""
        shift = np.uint64(64 - (len(self.counts).bit_length() - 1))
        bucket = mixed(single.astype(np.uint64) + np.uint64(1 << 40)) >> shift
        return self.counts[np.unique(bucket).astype(np.int64)].sum(axis=0, dtype=np.float64)

    @cached_property
    def totals(self) -> np.ndarray:
        return self._of(np.arange(256))

    def log_chances(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithms by unit and language, and each word's first unit
        (and, last, the number of units)."""
        grams = Grams(words)
        chance = np.full((len(grams.word), len(self.names)), 1 / 256)
        context = np.broadcast_to(self.totals, chance.shape)
        for bucket, there in grams.buckets(len(self.counts)):
            count = self.counts[bucket].astype(np.float64)
            longer = np.minimum((count + PRIOR * chance) / (context + PRIOR), 1.0)
            chance = np.where(there[:, None], longer, chance)
            # What is counted up to a place is the next place's context.
            context = np.empty_like(count)
            context[1:] = count[:-1]
            first = grams.inside == 0
            context[first] = self._spaces
        units = -(-grams.sizes // UNIT)
        starts = np.concatenate(([0], np.cumsum(units)))
        if not len(grams.word):
            return np.empty((0, len(self.names))), starts
        begins = np.flatnonzero(grams.inside % UNIT == 0)
        return np.add.reduceat(np.log(chance), begins, axis=0), starts

    @cached_property
    def _spaces(self) -> np.ndarray:
        """Counts of the space that ends each word, as often as one begins it."""
        return self._of(np.array([SPACE]))


def _occurrences(codes: np.ndarray, owner: np.ndarray, n_words: int) -> tuple[np.ndarray, ...]:
    """Distinct (text, word) pairs by text, with their number."""
    pair, n = np.unique(owner.astype(np.int64) * max(n_words, 1) + codes, return_counts=True)
    return pair // max(n_words, 1), pair % max(n_words, 1), n


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of buckets by language, in MAX_BUCKETS of them."""
    held: dict[str, np.ndarray] = {}

    def handed_on():
        for lang, counts in held.items():
            bucket = np.flatnonzero(counts)
            langs = pa.array([lang]).take(pa.array(np.zeros(len(bucket), np.int32)))
            yield pa.record_batch(
                [langs, pa.array(bucket.astype(np.int32)), pa.array(counts[bucket].astype(np.int64))],
                ["lang", "bucket", "n"],
            )
        held.clear()

    for batch in batches:
        for part in slices(batch, "text"):
            words = split_words(_letters(part.column("text")), _AS_IT_IS)
            langs = part.column("lang").dictionary_encode()
            code = langs.indices.to_numpy(zero_copy_only=False)[words.owners()]
            grams = Grams(words.distinct)
            buckets = grams.buckets(MAX_BUCKETS)
            of, word, n = _occurrences(words.codes, code, len(words.distinct))
            for number, lang in enumerate(langs.dictionary.to_pylist()):
                times = np.zeros(len(words.distinct))
                times[word[of == number]] = n[of == number]
                times = times[grams.word]
                some = times > 0
                counts = held.setdefault(lang, np.zeros(MAX_BUCKETS))
                for bucket, there in buckets:
                    counts += np.bincount(bucket[some & there], times[some & there], MAX_BUCKETS)
            if len(held) >= HELD:
                yield from handed_on()
    yield from handed_on()


def learn_languages(docs: DataFrame) -> Languages:
    """Models of all languages that `lang` names, from every text of `docs`.

    Rows without a language are left out; null and empty texts add nothing but
    their language's name; repeated rows count each time. An empty table gives no
    language.
    """
    rows = docs.select(F.col("lang").cast("string").alias("lang"), text_of(docs).alias("text"))
    rows = rows.where(F.col("lang").isNotNull())
    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    buckets = MAX_BUCKETS
    while buckets * len(names) > MODEL_CELLS:
        buckets //= 2
    # Of a bucket's number the highest bits are kept, so buckets of a smaller
    # table are sums of neighbours. At most MODEL_CELLS rows.
    shrink = (MAX_BUCKETS // buckets).bit_length() - 1
    counted = (
        rows.mapInArrow(_counter, "lang string, bucket int, n long")
        .groupBy("lang", F.shiftright("bucket", shrink).alias("bucket"))
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros((buckets, len(names)), np.float32)
    number = pc.index_in(counted["lang"], pa.array(names, pa.string())).to_numpy()
    counts[counted["bucket"].to_numpy(), number] = counted["n"].to_numpy()
    return Languages(names, counts)


def mixture(like: np.ndarray, times: np.ndarray, starts: np.ndarray, allowed: np.ndarray):
    """Shares of the `allowed` languages by text, and each text's log likelihood.

    `like`: likelihoods by unit and language; unit i counts `times[i]` times; the
    units of text t begin at `starts[t]`, and each text has some.
    """
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    sizes = np.diff(np.append(starts, len(like)))
    owner = np.repeat(np.arange(len(starts)), sizes)
    n = np.add.reduceat(times, starts).astype(np.float64)
    logs = np.zeros(len(starts))
    live = np.arange(len(starts))
    unit, count, own = like, times, owner
    for step in range(ROUNDS):
        part = shares[own] * unit
        whole = part.sum(axis=1)
        begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        logs[live] = np.add.reduceat(count * np.log(whole), begins)
        part *= (count / whole)[:, None]
        new = np.add.reduceat(part, begins, axis=0) / n[live][:, None]
        moved = np.abs(new - shares[live]).max(axis=1)
        shares[live] = new
        moving = moved > SETTLED
        if not moving.any():
            break
        if step % 4 == 3 and moving.mean() < 0.8:
            # Texts whose shares have settled are left out of further rounds.
            stays = np.zeros(len(starts), bool)
            stays[live[moving]] = True
            keep = stays[own]
            unit, count, own = unit[keep], count[keep], own[keep]
            live = live[moving]
    return shares, logs


def choose(like: np.ndarray, times: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Shares by text and language, 0 for languages outside the chosen set."""
    n_texts, n_languages = len(starts), like.shape[1]
    n = np.add.reduceat(times, starts)
    sizes = np.diff(np.append(starts, len(like)))
    shares, _ = mixture(like, times, starts, np.ones((n_texts, n_languages)))
    # A language of less than half a word explains nothing.
    allowed = shares * n[:, None] >= 0.5
    allowed[np.arange(n_texts), shares.argmax(axis=1)] = True
    chosen, best = np.zeros_like(shares), np.full(n_texts, -np.inf)
    live = np.arange(n_texts)
    while len(live):
        member = np.zeros(n_texts, bool)
        member[live] = True
        whole = np.repeat(member, sizes)
        begins = np.concatenate(([0], np.cumsum(sizes[live])))[:-1]
        shares, logs = mixture(like[whole], times[whole], begins, allowed[live])
        count = allowed[live].sum(axis=1)
        value = logs - PENALTY * (count - 1) * np.log1p(n[live])
        better = value > best[live]
        chosen[live[better]], best[live[better]] = shares[better], value[better]
        least = np.where(allowed[live], shares, np.inf).argmin(axis=1)
        allowed[live, least] = False
        live = live[count > 1]
    return chosen


def _shares(languages: Languages, texts: pa.Array) -> np.ndarray:
    """By text and language; zeros where there is no letter."""
    out = np.zeros((len(texts), len(languages.names)))
    if not languages.names:
        return out
    words = split_words(_letters(texts), _AS_IT_IS)
    if not len(words.codes):
        return out
    logs, first = languages.log_chances(words.distinct)
    text, word, n = _occurrences(words.codes, words.owners(), len(words.distinct))
    units = np.diff(first)[word]
    at = np.repeat(first[word] - (np.cumsum(units) - units), units) + np.arange(units.sum())
    logs, times, owner = logs[at], np.repeat(n, units), np.repeat(text, units)
    like = np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -FLOOR))
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    out[owner[starts]] = choose(like, times, starts)
    letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
    return out * letters[:, None]


def identify(docs: DataFrame, carried: Column, languages: Languages) -> DataFrame:
    """Per row of `docs`: `carried`, lang_pred, score, languages.

    `languages` are the chosen set's names and shares, the greatest first, of
    equal ones the first by name; `lang_pred` and `score` are the first of them.
    Null and empty texts, texts without a letter, and all texts if no language
    has been learnt are `und` with score 0 and no languages. Repeated rows are
    judged like others; an empty table gives no rows; no other column is read. A
    text is judged whole, in one task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(languages)  # at most MODEL_CELLS counts

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.names, UNKNOWN], object)
        for batch in batches:
            for part in slices(batch, "text"):
                shares = _shares(model, part.column("text"))
                shares = np.hstack([shares, np.zeros((len(shares), 1))])
                order = np.argsort(-shares, axis=1, kind="stable")
                ranked = np.take_along_axis(shares, order, axis=1)
                some = ranked > 0
                first = np.where(some[:, 0], order[:, 0], len(names) - 1)
                bounds = np.concatenate(([0], np.cumsum(some.sum(axis=1)))).astype(np.int32)
                chosen = pa.StructArray.from_arrays(
                    [pa.array(names[order[some]], pa.string()), pa.array(ranked[some])], ["lang", "share"]
                )
                yield pa.record_batch(
                    [
                        part.column("carried"),
                        pa.array(names[first], pa.string()),
                        pa.array(np.minimum(ranked[:, 0], 1.0)),
                        pa.ListArray.from_arrays(pa.array(bounds), chosen),
                    ],
                    ["carried", "lang_pred", "score", "languages"],
                )

    rows = docs.select(carried.alias("carried"), text_of(docs).alias("text"))
    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(
        judge, f"carried {kind}, lang_pred string, score double, languages {LANGUAGES}"
    )
