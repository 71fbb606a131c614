"""Rewrite landed tables with full-size files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartstream.plans.stored import store_partials
from cartstream.sources.lake import (
    Closed,
    Lake,
    closed,
    is_rewritten,
    read_landed,
    read_live_files,
    record_period,
)

# Files younger than this may belong to a batch that is not noted as done yet.
SETTLED_AFTER = dt.timedelta(hours=1)


def _write(rows: DataFrame, lake: Lake, table: str, folder: str, mode: str) -> None:
    """Micro-batches leave many small files. `rebalance` shuffles by period and
    lets Spark merge small partitions and split those of a busy period."""
    (
        rows.hint("rebalance", lake.period_column)
        .write.mode(mode)
        .partitionBy(*lake.partition_columns(table))
        .parquet(folder)
    )


def compact(spark: SparkSession, lake: Lake, table: str, target: Lake) -> None:
    """Copy a table, malformed messages included, to another lake.

    The target may use another period; its table folder must not exist yet.
    """
    record_period(spark, target)
    rows = target.with_period(read_landed(spark, lake, table).drop(lake.period_column), table)
    _write(rows, target, table, target.table(table), "error")


def compact_closed(
    spark: SparkSession,
    lake: Lake,
    table: str,
    before: dt.date,
    settled: dt.datetime | None = None,
) -> None:
    """Rewrite the periods that started before `before`, for readers of the lake.

    Takes only what no earlier call has taken: newly closed periods, and files
    that came late to older ones. Files written after `settled` (by default an
    hour ago) stay where they are, and readers go on taking them from there.
    The streams and the live files are left alone. A call that breaks off leaves
    nothing that readers see, and the next one writes over it. Totals of the
    rewritten rows are kept for the panels.
    """
    done = closed(spark, lake, table)
    if done and before < done.before:
        raise ValueError(f"{table} is compacted up to {done.before} already")
    settled = settled or dt.datetime.now() - SETTLED_AFTER
    now = Closed(done.run + 1 if done else 0, before, settled)
    rows = read_live_files(spark, lake, table).where(is_rewritten(lake, now))
    if done:
        rows = rows.where(~is_rewritten(lake, done))
    _write(rows, lake, table, f"{lake.compacted(table)}/run={now.run}", "overwrite")
    store_partials(spark, lake, table, now.run)
    note = spark.createDataFrame(
        [(now.run, now.before, now.settled)], "run int, before date, settled timestamp"
    )
    note.coalesce(1).write.mode("append").parquet(lake.closed_notes(table))
