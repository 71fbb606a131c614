"""Streams: topic to lake, lake to order lines, lake to relational tables.

Each topic is read once. Everything else reads the landed table as a stream of
its own, with its own checkpoint: a slow or stopped sink lags behind the lake,
but cannot differ from it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cartstream.operators.items import relational_shape, transaction_items
from cartstream.operators.keys import KeyViolation, kept_rows, key_violations
from cartstream.operators.parse import parse_messages
from cartstream.schemas import ITEMS, PRIMARY_KEYS, Topic
from cartstream.sources.lake import Lake, record_period, stream_table

AVAILABLE_NOW = {"availableNow": True}

ON_VIOLATION = ("skip", "fail")

# Files of a landed table that a following stream takes at once: a first run over
# a large table is many batches, and a failed one is little to do again.
FILES_PER_BATCH = 10_000

# Files that a landing task writes at once, one for each partition of the table. A task
# with rows of more partitions than that sorts the rest, which may spill.
OPEN_FILES = 16
OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"

# How landed files are compressed: ids, sessions and amounts take little more than half
# the space that Spark's own choice needs.
CODEC = "zstd"
CODEC_SETTING = "spark.sql.parquet.compression.codec"

Trigger = Mapping[str, object] | None


def start(
    writer: DataStreamWriter, lake: Lake, query: str, trigger: Trigger
) -> StreamingQuery:
    """Start with a checkpoint in the lake. No trigger means back-to-back batches."""
    # Names are unique per session, and a session may fill several lakes.
    writer = writer.queryName(f"{query} in {lake.root}")
    writer = writer.option("checkpointLocation", lake.checkpoint(query))
    return (writer.trigger(**trigger) if trigger else writer).start()


def open_files(spark: SparkSession) -> None:
    """Write OPEN_FILES at once, unless the session says how many."""
    if OPEN_FILES_SETTING not in spark.conf.getAll:
        spark.conf.set(OPEN_FILES_SETTING, OPEN_FILES)


def _append_to_lake(
    frame: DataFrame, lake: Lake, table: str, query: str, trigger: Trigger
) -> StreamingQuery:
    record_period(frame.sparkSession, lake)
    open_files(frame.sparkSession)
    # The session's own choice stays.
    codec = frame.sparkSession.conf.getAll.get(CODEC_SETTING, CODEC)
    writer = (
        lake.with_period(frame, table)
        .writeStream.format("parquet")
        .option("path", lake.table(table))
        .option("compression", codec)
        .partitionBy(*lake.partition_columns(table))
        .outputMode("append")
    )
    return start(writer, lake, query, trigger)


def start_landing(
    spark: SparkSession,
    topic: Topic,
    source,
    lake: Lake,
    trigger: Trigger = None,
    on_malformed: str = "quarantine",
) -> StreamingQuery:
    """Land a topic. Malformed messages go to their own folder of the same table."""
    rows = parse_messages(source.stream(spark), topic, on_malformed)
    return _append_to_lake(rows, lake, topic.name, f"land_{topic.name}", trigger)


def start_items(
    spark: SparkSession,
    lake: Lake,
    trigger: Trigger = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Unnest landed transactions into order lines."""
    transactions = stream_table(spark, lake, "transactions", files_per_batch)
    return _append_to_lake(
        transaction_items(transactions), lake, ITEMS, f"land_{ITEMS}", trigger
    )


def export_batch(
    batch: DataFrame,
    table: str,
    target,
    on_violation: str = "skip",
    feed: str = "export",
    epoch: int = 0,
) -> None:
    """Bring one batch of landed rows to a relational table.

    A keyed table takes each key once. A batch that comes again adds nothing: a
    target that replaces batches (`FolderTable`) settles keys of several batches
    itself, another one knows which batches it has, and takes only keys it has not
    stored. `on_violation="fail"` raises instead of leaving rows out. Where a target
    settles keys itself the batch goes there as it is; otherwise it is read once and
    kept while it is worked on.
    """
    if not target.replaces and target.has(batch.sparkSession, feed, epoch):
        return
    rows = relational_shape(batch, table)
    key = PRIMARY_KEYS.get(table)
    if not key or (target.replaces and on_violation != "fail"):
        target.append(rows, feed, epoch)
        return
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        accepted = kept_rows(rows, table).select(*rows.columns)
        if on_violation == "fail" or not target.replaces:
            stored = target.stored_keys(rows.select(key), key, feed, epoch)
            if on_violation == "fail":
                found = key_violations(rows, key, stored).limit(1).collect()
                if found:
                    raise KeyViolation(f"{table}: {found[0]['reason']}: {found[0]['key']}")
            if not target.replaces:
                accepted = accepted.join(stored.select(key), key, "left_anti")
        target.append(accepted.select(*rows.columns), feed, epoch)
    finally:
        rows.unpersist()


def start_export(
    spark: SparkSession,
    lake: Lake,
    table: str,
    target,
    trigger: Trigger = None,
    on_violation: str = "skip",
    files_per_batch: int = FILES_PER_BATCH,
    query: str | None = None,
) -> StreamingQuery:
    """Keep a relational table in step with a landed one.

    The query's name is the feed's: with its checkpoint lost, it writes its
    batches anew; under another name it is a feed of its own.
    """
    query = query or f"export_{table}"
    if on_violation not in ON_VIOLATION:
        raise ValueError(f"on_violation must be one of {ON_VIOLATION}, not {on_violation!r}")

    def push(batch: DataFrame, epoch: int) -> None:
        export_batch(batch, table, target, on_violation, query, epoch)

    frame = stream_table(spark, lake, table, files_per_batch)
    writer = frame.writeStream.foreachBatch(push).outputMode("append")
    return start(writer, lake, query, trigger)
