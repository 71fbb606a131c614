"""Tables between jobs, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartstream.session import new_run_dir


def few_tasks(frame: DataFrame) -> DataFrame:
    """`frame`, in as many tasks as there are cores: for rows of a few numbers after a
    shuffle, whose partitions are each aggregated by themselves still."""
    return frame.coalesce(frame.sparkSession.sparkContext.defaultParallelism)


def written(frame: DataFrame, label: str, slim: bool = False) -> DataFrame:
    """`frame`, computed once and read back: what follows does not hang on its
    lineage, and a lost executor costs no more than its own tasks.

    `slim` is for rows of a few numbers after a shuffle: one file per core, in
    place of one per shuffle partition.
    """
    spark = frame.sparkSession
    folder = new_run_dir(spark, label)
    if slim:
        frame = few_tasks(frame)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


# Keys that are broadcast to where the rows are, at most; with a digest each they
# take about 20 MB. More of them meet the rows in a shuffle.
BROADCAST_KEYS = 200_000


def keep_rows(
    docs: DataFrame, key: dict[str, Column], kept: DataFrame, dropped: DataFrame | None = None
) -> DataFrame:
    """The rows of `docs` whose `key` is in `kept`, with all their columns.

    `kept` has the key's columns and `copies`, the number of rows with that key;
    of several rows with one key one stays. Null is a value like any other.
    `dropped`, if it is known, has the keys of all other rows: where few rows go
    or are repeated, the others stay where they are read.
    """
    whole = docs.select(F.struct("*").alias("row"), *(c.alias(n) for n, c in key.items()))
    kept = kept.select(*(F.col(n).alias(f"kept_{n}") for n in key), "copies")
    same = [F.col(n).eqNullSafe(F.col(f"kept_{n}")) for n in key]
    repeated = kept.where("copies > 1")
    n_repeated = repeated.count()
    again = whole.join(repeated, same, "left_semi").dropDuplicates([*key])
    if dropped is not None:
        gone = dropped.select(*(F.col(n).alias(f"kept_{n}") for n in key))
        gone = gone.union(repeated.drop("copies"))
        if gone.count() <= BROADCAST_KEYS:
            rows = whole.join(F.broadcast(gone), same, "left_anti")
            if n_repeated:
                rows = rows.unionByName(
                    whole.join(F.broadcast(repeated), same, "left_semi").dropDuplicates([*key])
                )
            return rows.select("row.*")
    alone = whole.join(kept.where("copies = 1").hint("shuffle_hash"), same, "left_semi")
    return (alone.unionByName(again) if n_repeated else alone).select("row.*")
