"""Panels of a lake from what is stored of them, and the rest.

Panels of keyed tables start from the totals that `start_keys` keeps, and add what
the files landed since then change; of the table's history only the buckets of
those files' keys are opened. The other panels start from the totals that each
compaction has left, and add the files not compacted yet. Where nothing is stored
the whole table is read. The rows are those of `Panel.run` on the whole table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartstream.plans.panels import PANELS
from cartstream.schemas import INT, struct
from cartstream.sources.files import names_in
from cartstream.sources.lake import Lake, closed, read_landed_since, read_run, read_table, read_unclosed
from cartstream.streaming.keys import store_of, stored_totals

RUN = "run"


def lake_panel(spark: SparkSession, lake: Lake, name: str, as_of: dt.date | None = None) -> DataFrame:
    """A panel's rows now, late and repeated rows included."""
    panel = PANELS[name]
    if not panel.keyed:
        return panel.present(_compacted_and_live(spark, lake, name), as_of)
    store = store_of(lake, panel.table)
    note = store.note(spark)
    if note is None:
        return panel.run(read_table(spark, lake, panel.table), as_of)
    rows = read_landed_since(spark, lake, panel.table, note.frontier)
    since = panel.signed(store.signed(store.changes(rows, note)))
    known = stored_totals(spark, store, name, note)
    return panel.present(panel.merged(known.unionByName(since)), as_of)


def store_partials(spark: SparkSession, lake: Lake, table: str, run: int) -> None:
    """Totals of the rows that compaction `run` has rewritten, for each panel."""
    for name, panel in PANELS.items():
        if panel.table == table and not panel.keyed:
            totals = panel.totals(read_run(spark, lake, table, [run]))
            totals.write.mode("overwrite").parquet(f"{lake.partials(name)}/{RUN}={run}")


def _compacted_and_live(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    panel = PANELS[name]
    totals = panel.totals(read_unclosed(spark, lake, panel.table))
    done = closed(spark, lake, panel.table)
    if done is None:
        return totals
    runs = range(done.run + 1)
    stored = {int(n.partition("=")[2]) for n in names_in(spark, lake.partials(name)) if "=" in n}
    if stored & {*runs}:
        schema = StructType([*totals.schema.fields, *struct({RUN: INT}).fields])
        parts = spark.read.schema(schema).parquet(lake.partials(name))
        totals = totals.unionByName(parts.where(F.col(RUN) <= done.run).drop(RUN))
    if without := sorted({*runs} - stored):  # compacted before totals were kept
        totals = totals.unionByName(panel.totals(read_run(spark, lake, panel.table, without)))
    return panel.merged(totals)
