"""Exact duplicates: frequent digests are settled on the map side, the rest by a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartstream.llm.tables import keep_rows, text_of, written

# A digest with more than 1/HEAVY of all rows is a heavy hitter, so there are
# fewer than HEAVY of them, whatever the table's size. With more shuffle partitions
# than this there may be one for each: no light digest is more than a task's share.
HEAVY = 1000

# Counters of the frequent-items sketch (Misra-Gries) for each heavy hitter there
# may be: its error is at most a quarter of what makes a digest heavy.
TRACKED = 4

# Tasks that merge the sketches of the scan's tasks, before one merges theirs.
MERGERS = 64


def normalised(text: Column) -> Column:
    """`text` without `[\\x20\\x09-\\x0D]`."""
    return F.translate(text, " \t\n\x0b\x0c\r", "")


def digest_of(docs: DataFrame) -> Column:
    return F.sha2(normalised(text_of(docs)).cast("binary"), 256)


def _frequent(rows: DataFrame) -> DataFrame:
    """The digests that may be heavy: all that are, and few others."""
    heavy = max(HEAVY, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tracked = TRACKED * heavy
    sketches = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(digest, {tracked})").alias("sketch")
    )
    # Grouped by a constant, since an empty table has no sketches to combine.
    merged = sketches.groupBy(F.lit("all")).agg(
        F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")
    )
    top = F.explode(F.expr(f"approx_top_k_estimate(sketch, {heavy})"))
    return (
        merged.select("n", top.alias("top"))
        .where(F.col("top.count") * heavy > F.col("n"))
        .select(F.col("top.item").alias("digest"))
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space; null counts as
    empty. Of equal texts the row with the most code points in its text stays,
    then the one with the smallest doc_id (null last); of rows that repeat a
    doc_id one stays. An empty table gives no rows; other columns are not read.

    The digests are written once. A frequent-items sketch names the digests
    that may hold over 1/HEAVY of the rows; their counts and winners are taken
    from all rows, by partial aggregation, and broadcast (fewer than HEAVY
    rows), so rows of large groups are settled where they are read. The others,
    in groups below that share, meet by digest in an ordinary shuffle.
    """
    rows = written(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            digest_of(docs).alias("digest"),
            F.struct(
                (-F.length(text_of(docs))).alias("shorter"),
                docs["doc_id"].isNull().alias("no_id"),
                docs["doc_id"].alias("doc_id"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("rank"),
        ),
        "digests",
    )
    frequent = written(_frequent(rows), "frequent-digests", slim=True)
    winners = written(
        rows.join(F.broadcast(frequent), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("rank").alias("best"), F.count("*").alias("group_size")),
        "winners",
        slim=True,
    )
    heavy = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    light = (
        rows.join(F.broadcast(winners), "digest", "left_anti")
        .withColumn("best", F.min("rank").over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return heavy.unionByName(light).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("rank.row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        F.col("rank.shorter").alias("shorter"),
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; see `exact_groups`."""
    per_text = ["doc_id", "text_sha256", "shorter"]
    rows = written(
        exact_groups(docs)
        .groupBy(*per_text)
        .agg(F.max("kept").alias("kept"), F.count("*").alias("copies")),
        "settled-rows",
    )
    key = {
        "doc_id": docs["doc_id"],
        "text_sha256": digest_of(docs),
        "shorter": -F.length(text_of(docs)),
    }
    return keep_rows(docs, key, rows.where("kept"), rows.where("not kept"))
