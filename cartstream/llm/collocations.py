"""Phrases of two to five words that belong together, by dynamic itemset counting.

The corpus is dealt into shards, which are scanned one after the other, round and
round. All lengths are counted in the same scans: a phrase becomes active as soon
as the phrase without its last and the one without its first word have reached
the threshold, wherever the scan is then, and is counted until each shard has been
scanned once. The scans end when a whole round has activated nothing.

Shards hold numbers of words, not text, written once. Counts are rows of (length,
key, scan, n), a key being a hash of language and words; a shard's count of a phrase
is the same whenever it is scanned, so a phrase scanned twice does no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartstream.llm.filters import SPARE, Filter, heavy_filter, key_column, key_filter, width_for
from cartstream.llm.tables import few_tasks, text_of, written
from cartstream.llm.text import Words, mixed, piece_table, pieces, slices, split_words, word_hash
from cartstream.session import new_run_dir

# Lengths of phrases, least occurrences, phrases reported for each language.
LONGEST = 5
LEAST = 100
TOP = 2000

# Parts of the corpus, scanned in turn.
SHARDS = 4

# Bytes of text that one row of a shard is made of.
ROW_BYTES = 1 << 20

# Words and phrases whose hash bucket has fewer than LEAST of them in all are never
# counted; there is a bucket for every so many words of the corpus.
BUCKET_LOAD = 8

# Parts of a language's phrases that are ranked by themselves first.
SALTS = 64

# Distinct phrases that a task counts before it hands them on.
HELD = 1 << 20

ENCODED = (
    "shard int, hashes binary, codes binary, langs array<string>, lang_of binary, "
    "n_words array<long>, words array<string>"
)
COUNTS = "length byte, key long, n long, start long, end long"
STEP = np.uint64(0x9E3779B97F4A7C15)


def _encoder(n_shards: int):
    """Rows of a shard: `codes` are places, from 1, in `hashes` and `words`; 0 is
    where a piece ends. `lang_of` has each word's place in `langs`, `n_words` each
    language's words in all."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        table = piece_table()
        for batch in batches:
            for part in slices(batch, "text", limit=ROW_BYTES):
                words = split_words(part.column("text"), table)
                lang = part.column("lang").dictionary_encode()
                langs = lang.dictionary.to_pylist()
                salt = mixed(np.array([word_hash(name.encode()) for name in langs], np.int64))
                of = lang.indices.to_numpy(zero_copy_only=False)[words.owners()]
                pair = of.astype(np.int64) * max(len(words.distinct), 1) + words.codes
                distinct, place = np.unique(pair, return_inverse=True)
                word, own = distinct % max(len(words.distinct), 1), distinct // max(len(words.distinct), 1)
                hashes = mixed(words.hashes().view(np.uint64)[word] + salt[own]) | np.uint64(1)
                first = pieces(part.column("text"), words)
                codes = np.insert(place + 1, np.flatnonzero(first), 0)
                text = pa.array(words.distinct, pa.binary()).take(pa.array(word)).cast(pa.string())
                yield pa.record_batch(
                    [
                        pa.array([number % n_shards], pa.int32()),
                        pa.array([hashes.tobytes()], pa.binary()),
                        pa.array([codes.astype(np.int32).tobytes()], pa.binary()),
                        pa.array([langs], pa.list_(pa.string())),
                        pa.array([own.astype(np.int32).tobytes()], pa.binary()),
                        pa.array([np.bincount(of, minlength=len(langs)).tolist()], pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(pa.array([0, len(text)], pa.int32()), text),
                    ],
                    ["shard", "hashes", "codes", "langs", "lang_of", "n_words", "words"],
                )
                number += 1

    return encode


def _encoded(docs: DataFrame, n_shards: int) -> DataFrame:
    spark = docs.sparkSession
    lang = F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang")
    rows = docs.select(lang, text_of(docs).alias("text")).mapInArrow(_encoder(n_shards), ENCODED)
    folder = new_run_dir(spark, "phrase-shards")
    rows.write.partitionBy("shard").parquet(folder)
    return spark.read.schema(ENCODED).parquet(folder)


def _keys(hashes: np.ndarray, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length the key of the phrase that ends at each place, and whether
    one does: it lies within one piece."""
    words = np.append(np.uint64(0), hashes)[codes]
    key, there = words, codes > 0
    out = [(key.view(np.int64), there)]
    for _ in range(LONGEST - 1):
        before, ok = key, there
        key, there = np.zeros_like(words), np.zeros_like(ok)
        key[1:] = mixed(before[:-1] * STEP + words[1:])
        there[1:] = ok[:-1] & (codes[1:] > 0)
        out.append((key.view(np.int64), there))
    return out


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for hashes, codes in zip(batch.column("hashes"), batch.column("codes"), strict=True):
        yield np.frombuffer(hashes.as_buffer(), np.uint64), np.frombuffer(codes.as_buffer(), np.int32)


def _short_keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """All words and pairs."""
    for row in _rows(batch):
        for key, there in _keys(*row)[:2]:
            yield key[there]


def _long_keys(shared: Broadcast):
    """All longer phrases whose pairs all pass the filter."""

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for row in _rows(batch):
            (pair, there), *longer = _keys(*row)[1:]
            at = np.flatnonzero(there)
            passed = np.zeros(len(pair), bool)
            passed[at[shared.value.holds(pair[at])]] = True
            ending = passed
            for key, there in longer:
                ending = there & passed & np.append(False, ending[:-1])
                yield key[ending]

    return keys


def _scanner(shared: Broadcast, first_round: bool):
    """Counts of the active phrases of a shard's rows: length, key, n, and the keys
    of the phrase without its last and without its first word."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plausible, plausible_longer, reached, young = shared.value
        held: list[tuple[np.ndarray, ...]] = []
        n_held = 0

        def total():
            length, key, n, *parts = (np.concatenate(x) for x in zip(*held, strict=True))
            distinct, at, of = np.unique(key, return_index=True, return_inverse=True)
            n = np.bincount(of, n, len(distinct)).astype(np.int64)
            return length[at], distinct, n, *(part[at] for part in parts)

        def add(length: int, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> int:
            distinct, at, n = np.unique(keys, return_index=True, return_counts=True)
            held.append((np.full(len(distinct), length, np.int8), distinct, n, start[at], end[at]))
            return len(distinct)

        def batch_of(*columns):
            return pa.record_batch([pa.array(c) for c in columns], ["length", "key", "n", "start", "end"])

        for batch in batches:
            for hashes, codes in _rows(batch):
                if first_round:
                    times = np.bincount(codes, minlength=len(hashes) + 1)[1:]
                    some = plausible.holds(hashes) & (times > 0)
                    key, none = hashes.view(np.int64)[some], np.zeros(some.sum(), np.int64)
                    held.append((np.ones(len(key), np.int8), key, times[some], none, none))
                    n_held += len(key)
                known = np.append(False, reached.holds(hashes))[codes]
                fresh = np.append(False, young.holds(hashes))[codes]
                # Places, ending a phrase that has reached the threshold, and
                # whether it did so less than a round ago.
                keys = _keys(hashes, codes)
                for length, (key, there) in enumerate(keys[1:], start=2):
                    open_ = there.copy()
                    open_[1:] &= known[1:] & known[:-1]
                    at = np.flatnonzero(open_)
                    at = at[(plausible if length == 2 else plausible_longer).holds(key[at])]
                    active = at[fresh[at] | fresh[at - 1]]
                    shorter = keys[length - 2][0]
                    n_held += add(length, key[active], shorter[active - 1], shorter[active])
                    known, fresh = np.zeros_like(known), np.zeros_like(fresh)
                    if length < LONGEST:
                        known[at] = reached.holds(key[at])
                        fresh[at] = young.holds(key[at])
                if n_held >= HELD:
                    held = [total()]
                    n_held = len(held[0][0])
                    if n_held >= HELD // 2:
                        yield batch_of(*held[0])
                        held, n_held = [], 0
        if held:
            yield batch_of(*total())

    return scan


class _Scans:
    """Counts in parts, one for each scan, that are read together."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.schema = spark, f"{COUNTS}, scan int"
        self.folder = new_run_dir(spark, "phrase-counts")
        self.parts: list[str] = []

    def add(self, rows: DataFrame) -> None:
        self.parts.append(f"{self.folder}/{len(self.parts)}")
        few_tasks(rows).write.parquet(self.parts[-1])

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.parts)


def _occurrences(n_shards: int, before: int | None = None) -> Column:
    """Of a phrase's counts, the sum over the shards; of the scans `before` that one alone."""
    n = F.col("n") if before is None else F.when(F.col("scan") < before, F.col("n"))
    of_shard = [F.max(F.when(F.col("scan") % n_shards == shard, n)) for shard in range(n_shards)]
    return reduce(add, (F.coalesce(most, F.lit(0).cast("long")) for most in of_shard))


def _totals(counted: DataFrame, least: int, n_shards: int) -> DataFrame:
    """Occurrences of phrases that have `least` of them: length, key, n, start, end."""
    parts = [F.first(part).alias(part) for part in ("start", "end")]
    totals = counted.groupBy("length", "key").agg(_occurrences(n_shards).alias("total"), *parts)
    return totals.where(F.col("total") >= least).select("length", "key", F.col("total").alias("n"), "start", "end")


def _newly_reached(counted: DataFrame, least: int, n_shards: int, scan: int) -> DataFrame:
    """Keys of phrases that have `least` occurrences since this scan, and may be part
    of longer ones."""
    totals = counted.where(F.col("length") < LONGEST).groupBy("length", "key")
    totals = totals.agg(_occurrences(n_shards).alias("now"), _occurrences(n_shards, scan).alias("before"))
    return totals.where((F.col("now") >= least) & (F.col("before") < least)).select("key")


def count_phrases(shards: DataFrame, n_shards: int, least: int) -> DataFrame:
    """Occurrences of all words and phrases that have `least`: length, key, n, and
    of phrases the keys of all but the last (`start`) and all but the first word (`end`)."""
    spark = shards.sparkSession
    scanned = shards.select("shard", "hashes", "codes")
    n_words = shards.select(F.explode("n_words").alias("n")).agg(F.sum("n")).first()[0] or 0
    plausible = heavy_filter(scanned, _short_keys, least, width_for(2 * n_words / BUCKET_LOAD))
    pairs = spark.sparkContext.broadcast(plausible)
    longer = heavy_filter(scanned, _long_keys(pairs), least, width_for(n_words / BUCKET_LOAD))
    pairs.unpersist()
    width = width_for(SPARE * (plausible.size() + longer.size()))
    counted = _Scans(spark)
    filters: list[Filter] = []  # by scan, the keys that reached the threshold in it
    while True:
        scan = len(filters)
        shared = spark.sparkContext.broadcast(
            (plausible, longer, Filter.of(filters, width), Filter.of(filters[-n_shards:], width))
        )
        counts = (
            scanned.where(F.col("shard") == scan % n_shards)
            .mapInArrow(_scanner(shared, scan < n_shards), COUNTS)
            .groupBy("length", "key")
            .agg(F.sum("n").alias("n"), F.first("start").alias("start"), F.first("end").alias("end"))
            .withColumn("scan", F.lit(scan))
        )
        counted.add(counts)
        shared.unpersist()
        new = few_tasks(_newly_reached(counted.read(), least, n_shards, scan))
        filters.append(heavy_filter(new, key_column, 1, width))
        if scan + 1 >= n_shards and not any(f.size() for f in filters[-n_shards:]):
            return _totals(counted.read(), least, n_shards)


def score() -> Column:
    """Of the columns a, n, l, r. 38 digits hold the products, whatever the corpus."""
    number = lambda c: f"cast({c} as decimal(18,0))"
    return F.expr(f"({number('a')} * {number('n')} * 1000) div ({number('l')} * {number('r')})")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, n_shards: int = SHARDS) -> DataFrame:
    """Each language's `top` phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are cut into pieces at `[.,;:!?\\x0A-\\x0D]`, pieces into words
    `[^\\x20\\x09]+`, A-Z lower-cased; a phrase lies within a piece. All occurrences
    count, overlapping ones too. Of a language (null: `und`), n is the number of
    words, a that of the phrase, l and r those of the two parts of the cut with the
    lowest score floor(1000 a n / (l r)), the first of such cuts. Phrases of a >=
    `least` (up to 200) count, unless a longer one around them is as frequent. Ranked by score
    and a, both descending, then by the phrase's bytes, so ties have one order.

    Null and empty texts add nothing; repeated rows count each time; a very long
    text is one row of a shard; an empty table gives no rows; other columns are
    not read.
    """
    shards = _encoded(docs, n_shards)
    totals = written(count_phrases(shards, n_shards, least), "phrase-totals")
    used = totals.where("length = 2").select(F.explode(F.array("start", "end")).alias("key"))
    words = written(_words(written(used.distinct(), "words-used"), shards), "phrase-words")
    phrases = written(_made_of(totals, words), "phrases")
    of = totals.select(F.col("key").alias("part"), F.col("n").alias("of_part"))
    n_words = (
        shards.select(F.explode(F.arrays_zip("langs", "n_words")).alias("x"))
        .groupBy(F.col("x.langs").alias("lang"))
        .agg(F.sum("x.n_words").alias("n"))
    )
    cuts = (
        phrases.select("key", "lang", "a", F.posexplode(F.arrays_zip("first", "rest")).alias("cut", "parts"))
        .select("key", "lang", "a", "cut", F.col("parts.first").alias("first"), F.col("parts.rest").alias("rest"))
        .join(of.select(F.col("part").alias("first"), F.col("of_part").alias("l")), "first")
        .join(of.select(F.col("part").alias("rest"), F.col("of_part").alias("r")), "rest")
        .join(n_words, "lang")
        .groupBy("key", "lang", "a", "n")
        .agg(F.min(F.struct(score().alias("score"), "cut", "l", "r")).alias("best"))
    )
    # A longer phrase as frequent holds one of one word more that is.
    around = (
        phrases.where(F.size("words") > 2)
        .select(F.explode(F.array(F.element_at("first", -1), F.element_at("rest", 1))).alias("key"), "a")
        .groupBy("key")
        .agg(F.max("a").alias("longest"))
    )
    ranked = (
        cuts.join(around, "key", "left")
        .where(F.col("longest").isNull() | (100 * F.col("longest") < 100 * F.col("a")))
        .select("key", "lang", "a", "n", "best.*")
    )
    best = [F.desc("score"), F.desc("a")]
    for part in (["lang", F.pmod("key", F.lit(SALTS))], ["lang"]):
        place = F.rank().over(Window.partitionBy(*part).orderBy(*best))
        ranked = ranked.withColumn("place", place).where(F.col("place") <= top).drop("place")
    ranked = written(ranked, "phrases-ranked")
    places = ranked.join(phrases.select("key", "words"), "key").select(
        "key", F.posexplode("words").alias("place", "part")
    )
    named = (
        places.join(words.select(F.col("key").alias("part"), "word"), "part")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
        .select("key", F.array_join(F.col("words.word"), " ").alias("phrase"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase"))
    return (
        ranked.join(named, "key")
        .withColumn("rank", place.cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def _made_of(totals: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with lang, words' keys, and for each cut the keys of both parts.

    A phrase is the one without its last word and the last word of the one without
    its first; its parts are that phrase, the other one, and their parts.
    """
    out = shorter = (
        totals.where("length = 2")
        .join(words.select(F.col("key").alias("start"), "lang"), "start")
        .select(
            "key", "lang", F.col("n").alias("a"), F.array("start", "end").alias("words"),
            F.array("start").alias("first"), F.array("end").alias("rest"),
        )
    )
    for length in range(3, LONGEST + 1):
        start = shorter.select(F.col("key").alias("start"), "lang", "words", "first")
        end = shorter.select(
            F.col("key").alias("end"), F.element_at("words", -1).alias("last"), "rest"
        )
        shorter = (
            totals.where(F.col("length") == length)
            .join(start, "start")
            .join(end, "end")
            .select(
                "key",
                "lang",
                F.col("n").alias("a"),
                F.concat("words", F.array("last")).alias("words"),
                F.concat("first", F.array("start")).alias("first"),
                F.concat(F.array("end"), "rest").alias("rest"),
            )
        )
        shorter = written(shorter, "phrases-of-a-length")
        out = out.unionByName(shorter)
    return out


def _words(used: DataFrame, shards: DataFrame) -> DataFrame:
    """key, lang, word of the words whose keys are in `used`."""
    wanted = used.sparkSession.sparkContext.broadcast(key_filter(used, used.count()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for row, (hashes, _) in enumerate(_rows(batch)):
                at = np.flatnonzero(wanted.value.holds(hashes))
                at = at[[key not in seen for key in hashes[at].tolist()]]
                seen.update(hashes[at].tolist())
                if len(seen) > HELD:
                    seen.clear()
                langs = pa.array(batch.column("langs")[row].as_py(), pa.string())
                own = np.frombuffer(batch.column("lang_of")[row].as_buffer(), np.int32)
                yield pa.record_batch(
                    [
                        pa.array(hashes.view(np.int64)[at]),
                        langs.take(pa.array(own[at])),
                        batch.column("words")[row].values.take(pa.array(at)),
                    ],
                    ["key", "lang", "word"],
                )

    found = shards.select("hashes", "codes", "langs", "lang_of", "words")
    found = found.mapInArrow(words, "key long, lang string, word string")
    found = found.groupBy("key").agg(F.min("lang").alias("lang"), F.min("word").alias("word"))
    return found.join(used, "key")
