"""Left join that stays balanced when one key holds much of either side.

Adaptive execution splits a hot key on the left of a left join, but not one on
the right. Here both are cut, by a plan made from the tables' keys beforehand.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartstream.schemas import INT, STRING, struct

ROW = "_row"

# The sketch tracks this many keys per part, which keeps its error at about a
# fifth of the share that makes a key hot; the most it can track is MAX_TRACKED.
# A missed key would cost balance, never rows.
TRACKED_PER_PART = 10
MAX_TRACKED = 1_000_000

# Chunks per hot key; the entry None stands for rows without a key.
Hot = dict[str | None, int]


def part_count(spark: SparkSession) -> int:
    """A key is hot when it holds more than 1/parts of its table's rows, so a table
    has fewer than `parts` hot keys: that many are collected and broadcast here."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_row(frame: DataFrame) -> DataFrame:
    """Number the rows of a table scan, to deal a hot key's rows out evenly.

    Do this right after the scan: there the order of rows is fixed by the files,
    so a task that is run again numbers its rows the same way. Copies of a row
    get different numbers, which a hash of their contents would not give them.
    """
    return frame.withColumn(ROW, F.monotonically_increasing_id())


def hot_keys(*columns: tuple[DataFrame, str]) -> list[Hot]:
    """The hot values of some columns, with the chunks to cut each into.

    One job over just these columns: a frequent-items sketch per task, merged in
    two steps. Runs at once and brings back fewer than `parts` values per column.
    """
    parts = part_count(columns[0][0].sparkSession)
    tracked = min(parts * TRACKED_PER_PART, MAX_TRACKED)
    # Tasks that merge the sketches of the scan's tasks, before one merges theirs.
    mergers = ceil(sqrt(parts))
    keys = reduce(
        DataFrame.unionAll,
        [
            table.select(F.lit(place).alias("place"), F.col(name).alias("k"))
            for place, (table, name) in enumerate(columns)
        ],
    )
    merger = F.pmod(F.spark_partition_id(), F.lit(mergers)).alias("merger")
    top = F.expr(f"approx_top_k_estimate(sketch, {parts})")
    is_hot = lambda item: item["item"].isNotNull() & (item["count"] * parts > F.col("n"))
    found = (
        keys.groupBy("place", merger)
        .agg(
            F.count("*").alias("n"),
            F.count("k").alias("n_keys"),
            F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("sketch"),
        )
        .groupBy("place")
        .agg(
            F.sum("n").alias("n"),
            F.sum("n_keys").alias("n_keys"),
            F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"),
        )
        .select("place", "n", "n_keys", F.filter(top, is_hot).alias("items"))
        .collect()
    )

    hot: list[Hot] = [{} for _ in columns]
    for row in found:
        rows_of = {item["item"]: item["count"] for item in row["items"]}
        without_key = row["n"] - row["n_keys"]
        if without_key * parts > row["n"]:
            rows_of[None] = without_key
        hot[row["place"]] = {
            key: min(parts, ceil(rows * parts / row["n"])) for key, rows in rows_of.items()
        }
    return hot


def _cuts(left: Hot, right: Hot) -> list[tuple[str, int, int]]:
    """Key, left chunks, right chunks. A key hot on both sides has its pairs
    spread over left x right chunks, so each side takes the root of its number."""
    cuts = []
    for key in sorted(({*left, *right}) - {None}):
        lefts, rights = left.get(key, 1), right.get(key, 1)
        if lefts > 1 and rights > 1:
            lefts, rights = ceil(sqrt(lefts)), ceil(sqrt(rights))
        cuts.append((key, lefts, rights))
    return cuts


def _dealt(name: str) -> Column:
    return F.pmod(F.col(ROW), F.coalesce(F.col(name), F.lit(1))).cast("int")


def _copied(name: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(name), F.lit(1)) - 1))


def spread_left_join(
    left: DataFrame, right: DataFrame, key: str, left_hot: Hot, right_hot: Hot
) -> DataFrame:
    """`left` LEFT JOIN `right` on a text `key`; hot keys are cut into chunks.

    Both sides come from `with_row`; apart from it and `key` they share no
    column name. The result has the columns of both and a row number again.
    With nothing hot this is a plain join. Which keys are called hot, and into
    how many chunks they are cut, does not change the result; only a key called
    hot on the right has to be there, as those found by `hot_keys` are.

    Rows of a hot key are dealt into chunks by row number, and the other side's
    rows of that key are copied to each chunk: each pair meets exactly once.
    Rows without a key match nothing and are dealt out as well. `_i` numbers the
    chunks of left rows and `_j` those of right rows, each only if there are any.
    """
    right = right.where(F.col(key).isNotNull())
    cuts = _cuts(left_hot, right_hot)
    cut_left = bool(left_hot)
    cut_right = any(rights > 1 for _, _, rights in cuts)
    if not cut_left and not cut_right:
        return left.join(right.drop(ROW), key, "left")

    schema = struct({key: STRING, "_lefts": INT, "_rights": INT})
    # Fewer than two rows for each shuffle partition, whatever the tables' size.
    chunks = F.broadcast(left.sparkSession.createDataFrame(cuts, schema))
    left, right = left.join(chunks, key, "left"), right.join(chunks, key, "left")

    if cut_left:
        keyless = F.pmod(F.col(ROW), F.lit(left_hot.get(None, 1))).cast("int")
        number = F.when(F.col(key).isNull(), keyless).otherwise(_dealt("_lefts"))
        left = left.withColumn("_i", number)
        right = right.withColumn("_i", _copied("_lefts"))
    if cut_right:
        left = left.withColumn("_j", _copied("_rights"))
        right = right.withColumn("_j", _dealt("_rights"))

    numbers = [name for name in ("_i", "_j") if name in left.columns]
    right = right.withColumnRenamed(ROW, "_right_row").drop("_lefts", "_rights")
    joined = left.join(right, [key, *numbers], "left")
    if cut_right:
        # A left row copied to the chunks of a hot right key has a match in at
        # least one of them; its copies without one are not part of the answer.
        copied = F.coalesce(F.col("_rights"), F.lit(1)) > 1
        joined = joined.where(F.col("_right_row").isNotNull() | ~copied)
    return joined.withColumn(ROW, F.col(ROW) + F.coalesce("_right_row", F.lit(0))).drop(
        "_lefts", "_rights", "_right_row", *numbers
    )
