"""A stream per table with a key: which row of each key counts, and what it adds up to.

Each batch is compared with the stored rows of its own keys. A key whose row
changes takes the old row off the panels' totals and adds the new one; all other
keys are left alone, so the work of a batch goes with the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartstream.plans.panels import PANELS
from cartstream.sources.keyed import STORED, KeyedStore, Note
from cartstream.sources.lake import LANDED_AT, Lake, stream_table
from cartstream.streaming.ingest import FILES_PER_BATCH, Trigger, start


def store_of(lake: Lake, table: str) -> KeyedStore:
    return KeyedStore(table, lake.keys(table))


def panels_of(table: str) -> list[str]:
    return [name for name, panel in PANELS.items() if panel.table == table]


def stored_totals(spark: SparkSession, store: KeyedStore, panel: str, note: Note | None) -> DataFrame:
    """A panel's totals after the batch of `note`."""
    empty = spark.createDataFrame([], store.runs.schema).withColumn("sign", F.lit(1))
    nothing = PANELS[panel].signed(empty)
    if note is None:
        return nothing
    return spark.read.schema(nothing.schema).parquet(store.totals(note.epoch, panel))


def follow_batch(batch: DataFrame, epoch: int, store: KeyedStore) -> None:
    """Bring the store and the totals of its panels from the batch before to this one.
    Of the batch only what the store keeps is read, and nothing is held: what is known
    of it ahead, and its keys, take a few columns."""
    spark = batch.sparkSession
    before = store.note(spark, before=epoch)
    batch = batch.select(store.key, *STORED[store.table], LANDED_AT)
    latest, n_keys = batch.agg(F.unix_micros(F.max(LANDED_AT)), F.count(store.key)).first()
    changes, runs = store.add(store.changes(batch, before, n_keys), epoch, before, n_keys)
    signed = store.signed(changes)
    for name in panels_of(store.table):
        panel = PANELS[name]
        known = stored_totals(spark, store, name, before)
        totals = panel.merged(known.unionByName(panel.signed(signed)))
        totals.write.mode("overwrite").parquet(store.totals(epoch, name))
    frontier = max((t for t in (latest, before and before.frontier) if t is not None), default=None)
    store.finish(spark, Note(epoch, frontier, runs))


def start_keys(
    spark: SparkSession,
    lake: Lake,
    table: str,
    trigger: Trigger = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Keep a keyed table's store and its panels' totals in step with what lands."""
    store = store_of(lake, table)
    rows = stream_table(spark, lake, table, files_per_batch, landed_at=True)

    def follow(batch: DataFrame, epoch: int) -> None:
        follow_batch(batch, epoch, store)

    writer = rows.writeStream.foreachBatch(follow).outputMode("append")
    return start(writer, lake, f"keys_{table}", trigger)
