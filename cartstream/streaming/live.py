"""Panels that follow the landed tables.

Of a table without a key the panel's totals are streaming state, one row per
group. After each batch the presented rows are written to one of two slots in
turn, tagged with the batch number, so a reader finds the newest complete result
while the next is written, and storage does not grow. Panels of keyed tables are
the totals that `start_keys` keeps, brought forward by what each batch changes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartstream.plans.panels import PANELS
from cartstream.sources.lake import Lake, check_period, stream_table
from cartstream.streaming.ingest import FILES_PER_BATCH, Trigger, start
from cartstream.streaming.keys import start_keys, store_of, stored_totals

EPOCH = "epoch"
SLOT = "slot"


def start_live(
    spark: SparkSession,
    lake: Lake,
    panel: str,
    trigger: Trigger = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Keep a panel up to date. One stream keeps all panels of a keyed table."""
    chosen = PANELS[panel]
    if chosen.keyed:
        return start_keys(spark, lake, chosen.table, trigger, files_per_batch)

    def show(totals: DataFrame, epoch: int) -> None:
        rows = chosen.present(totals, None).withColumn(EPOCH, F.lit(epoch).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{lake.live(panel)}/{SLOT}={epoch % 2}")

    table = stream_table(spark, lake, chosen.table, files_per_batch)
    writer = chosen.totals(table).writeStream.foreachBatch(show).outputMode("complete")
    return start(writer, lake, f"live_{panel}", trigger)


def read_live(
    spark: SparkSession, lake: Lake, panel: str, as_of: dt.date | None = None
) -> DataFrame | None:
    """The newest rows of a live panel, in its order, or None before the first
    batch. Totals are per day, so the answer moves on with the date."""
    chosen = PANELS[panel]
    if chosen.keyed:
        check_period(spark, lake)
        store = store_of(lake, chosen.table)
        note = store.note(spark)
        return note and chosen.present(stored_totals(spark, store, panel, note), as_of)
    try:
        slots = spark.read.parquet(lake.live(panel))
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    newest = slots.agg(F.max(EPOCH).alias(EPOCH))
    return chosen.sorted(slots.join(F.broadcast(newest), EPOCH).drop(EPOCH, SLOT))
