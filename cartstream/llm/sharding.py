"""Shards by rendezvous hashing of record keys."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartstream.llm.tables import text_of, written

# Rows that are numbered in one group.
ROWS_PER_GROUP = 50_000


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, from 0, with the highest score for a text `key`.

    Shard i scores -weight / ln(u), where u in (0, 1) is a hash of key and i, so
    it wins a share of keys as large as its share of the weights. A shard's
    score depends on no other shard: with one more shard, a key stays or moves
    to the new one. Null is a key like any other, apart from the empty text; of
    equal scores the shard of the highest number wins.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("each shard needs a weight above 0")
    key = F.when(key.isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), key.cast("string")))
    unit = lambda i: (F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 11) + 0.5) * 2.0**-53
    scores = [
        F.struct((F.lit(-float(w)) / F.ln(unit(i))).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    return F.array_max(F.array(*scores))["shard"]


def numbered(rows: DataFrame, shard: str) -> DataFrame:
    """`rows` with a `slot`: within each shard 0, 1, 2 and so on, without gaps.

    A shard is numbered in groups of rows, dealt by row number, so neither a
    large shard nor a repeated key meets in one task; each group starts where
    the groups before it end.
    """
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    groups = ceil(rows.count() / ROWS_PER_GROUP) or 1
    rows = rows.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("int"))
    before = Window.partitionBy(shard).orderBy("_group").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = rows.groupBy(shard, "_group").agg(F.count("*").alias("_n"))
    starts = sizes.select(shard, "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(shard, "_group").orderBy("_row"))
    return (
        rows.withColumn("_within", within)
        .join(starts, [shard, "_group"])
        .withColumn("slot", (F.col("_start") + F.col("_within") - 1).cast("long"))
        .drop("_row", "_group", "_within", "_start")
    )


def assign_shards(docs: DataFrame, shards: int, weights: Sequence[float] | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `size` is the text's UTF-8 bytes plus 1; a null text has none, and the
    checksum of the empty text. `grown_shard` is the shard if there were one
    more, of mean weight. Repeated rows go to one shard, to slots of their own.
    An empty table gives no rows; other columns of `docs` are not read.
    """
    weights = list(weights or [1.0] * shards)
    grown = [*weights, sum(weights) / len(weights)]
    text = text_of(docs)
    rows = docs.select(
        docs["doc_id"].alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(docs["doc_id"], weights).alias("shard"),
        shard_of(docs["doc_id"], grown).alias("grown_shard"),
    )
    return numbered(rows, "shard").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
