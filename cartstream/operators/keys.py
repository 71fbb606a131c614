"""Primary-key contract: a key is present and unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.schemas import PRIMARY_KEYS, RELATIONAL_SCHEMAS, TOPICS

# Why a row is rejected.
NULL_KEY = "null key"
STORED_KEY = "key already stored"
REPEATED_KEY = "key repeated in batch"


class KeyViolation(ValueError):
    """A batch breaks the key of its target table."""


def kept_rows(frame: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """What a keyed table holds of `frame`: one row per key, none without a key.

    Among rows with the same key the earliest is kept, then the smallest by
    column values in the table's order, so it does not matter in which batches
    they came. With `columns` only these are read and kept, and those before
    them in that order. Copies of a key are combined before the shuffle. Of a
    table without a key all rows are kept.
    """
    key = PRIMARY_KEYS.get(table)
    if key is None:
        return frame
    time = TOPICS[table].time_column
    order = [n for n in RELATIONAL_SCHEMAS[table].names if n in frame.columns and n not in (key, time)]
    columns = [time, *order] if columns is None else columns
    last = max((order.index(n) + 1 for n in columns if n in order), default=0)
    rows = frame.where(F.col(key).isNotNull()).groupBy(key)
    if not last:  # at most the time is asked for
        return rows.agg(F.min(time).alias(time)).select(key, *columns)
    ranked = F.struct(F.col(time).isNull().alias("timeless"), time, *order[:last])
    return rows.agg(F.min(ranked).alias("row")).select(
        key, *(F.col(f"row.{name}").alias(name) for name in columns)
    )


def acceptable_rows(batch: DataFrame, key: str, stored_keys: DataFrame) -> DataFrame:
    """The rows a keyed table takes that cannot replace a stored one: one per
    key, the smallest by column values, none of them stored yet.

    Copies of a key are combined before the shuffle, and the anti join sees each
    key once, so no key is hot in it.
    """
    others = [name for name in batch.columns if name != key]
    one_per_key = (
        batch.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*others)).alias("row"))
        .select(key, "row.*")
    )
    return one_per_key.join(stored_keys.select(key), key, "left_anti").select(*batch.columns)


def key_violations(batch: DataFrame, key: str, stored_keys: DataFrame) -> DataFrame:
    """Rejected rows per key and reason: `key`, `reason`, `rows_rejected`.

    With a stored key all rows of the batch go; with a new one all but one.
    """
    rows_per_key = batch.groupBy(key).agg(F.count("*").alias("n"))
    stored = stored_keys.select(key).distinct().withColumn("is_stored", F.lit(True))
    reason = (
        F.when(F.col(key).isNull(), NULL_KEY)
        .when(F.col("is_stored"), STORED_KEY)
        .otherwise(REPEATED_KEY)
    )
    rejected = F.when(F.col("reason") == REPEATED_KEY, F.col("n") - 1).otherwise(F.col("n"))
    return (
        rows_per_key.join(stored, key, "left")
        .withColumn("reason", reason)
        .select(F.col(key).alias("key"), "reason", rejected.alias("rows_rejected"))
        .where("rows_rejected > 0")
    )
