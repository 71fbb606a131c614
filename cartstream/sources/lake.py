"""Landed Parquet tables.

Layout: `<root>/tables/<table>/[status=…/]event_<period>=<date>/`. Topic tables
keep malformed messages apart under `status=malformed`, so one atomic write
covers both and a reader of good rows never opens the others.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartstream.functions import period_start
from cartstream.operators.parse import MALFORMED, MESSAGE, OK, STATUS
from cartstream.schemas import DATE, INT, ITEMS, STRING, TABLE_SCHEMAS, TOPICS, struct


LANDED_AT = "landed_at"
FILE_TIME = "_metadata.file_modification_time"


@dataclass(frozen=True)
class Lake:
    """Where the tables are, and how long a stretch of time one partition holds.

    Choose `period` so that a partition is large enough for full-size files:
    days for a busy shop, months or years for a quiet one.
    """

    root: str
    period: str = "day"

    @property
    def period_column(self) -> str:
        return f"event_{self.period}"

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def compacted(self, name: str) -> str:
        return f"{self.root}/compacted/{name}"

    def closed_notes(self, name: str) -> str:
        return f"{self.root}/closed/{name}"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/{query}"

    def live(self, panel: str) -> str:
        return f"{self.root}/live/{panel}"

    def keys(self, table: str) -> str:
        return f"{self.root}/keys/{table}"

    def partials(self, panel: str) -> str:
        return f"{self.root}/partials/{panel}"

    def partition_columns(self, table: str) -> list[str]:
        return [STATUS, self.period_column] if table in TOPICS else [self.period_column]

    def schema(self, table: str) -> StructType:
        """All columns on disk, those in folder names last."""
        extra = {MESSAGE: STRING, STATUS: STRING} if table in TOPICS else {}
        return StructType(
            TABLE_SCHEMAS[table].fields + struct({**extra, self.period_column: DATE}).fields
        )

    def with_period(self, frame: DataFrame, table: str) -> DataFrame:
        time = "timestamp" if table == ITEMS else TOPICS[table].time_column
        return frame.withColumn(self.period_column, period_start(F.col(time), self.period))


_periods: dict[str, str] = {}


def stored_period(spark: SparkSession, root: str) -> str | None:
    """The period that the lake was laid out with; None before the first landing."""
    if root not in _periods:
        try:
            _periods[root] = spark.read.text(f"{root}/period").first()["value"]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
    return _periods[root]


def check_period(spark: SparkSession, lake: Lake) -> str | None:
    stored = stored_period(spark, lake.root)
    if stored not in (None, lake.period):
        raise ValueError(f"{lake.root} is laid out by {stored}, not by {lake.period}")
    return stored


def record_period(spark: SparkSession, lake: Lake) -> None:
    """Note the period in a new lake; refuse another one in an old lake."""
    if check_period(spark, lake) is None:
        note = spark.createDataFrame([(lake.period,)], "value string").coalesce(1)
        note.write.mode("ignore").text(f"{lake.root}/period")
        check_period(spark, lake)


def open_lake(spark: SparkSession, root: str, period: str | None = None) -> Lake:
    """The lake with the period it has; a new one with `period`, or days."""
    lake = Lake(root, period or stored_period(spark, root) or "day")
    check_period(spark, lake)
    return lake


@dataclass(frozen=True)
class Closed:
    """What compaction `run` and those before it have rewritten: rows of periods
    before `before`, in files that were there at `settled`."""

    run: int
    before: dt.date
    settled: dt.datetime


def closed(spark: SparkSession, lake: Lake, table: str) -> Closed | None:
    """The last finished compaction of closed periods, if there is one."""
    try:
        notes = spark.read.schema("run int, before date, settled timestamp").parquet(
            lake.closed_notes(table)
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = notes.orderBy(F.desc("run")).first()
    return Closed(**last.asDict()) if last else None


def is_rewritten(lake: Lake, done: Closed) -> Column:
    """Of a scan of the live table: the row is in the compacted one. Decided by
    folder and file, before any row is read."""
    old = F.col(FILE_TIME) <= F.lit(done.settled)
    return F.coalesce((F.col(lake.period_column) < F.lit(done.before)) & old, F.lit(False))


def read_live_files(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """What the streams have landed; no rows if nothing has landed yet."""
    check_period(spark, lake)
    schema = lake.schema(table)
    try:
        return spark.read.schema(schema).parquet(lake.table(table))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _compacted(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    schema = StructType([*lake.schema(table).fields, *struct({"run": INT}).fields])
    return spark.read.schema(schema).parquet(lake.compacted(table))


def read_landed(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The table as landed: closed periods from where they were compacted, all
    else, late rows included, from the live files."""
    live = read_live_files(spark, lake, table)
    done = closed(spark, lake, table)
    if done is None:
        return live
    compacted = _compacted(spark, lake, table).where(F.col("run") <= done.run)
    names = lake.schema(table).names
    return live.where(~is_rewritten(lake, done)).select(names).unionAll(compacted.select(names))


def read_unclosed(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """Good rows that no compaction has taken."""
    live = read_live_files(spark, lake, table)
    done = closed(spark, lake, table)
    return _good_rows(live.where(~is_rewritten(lake, done)) if done else live, lake, table)


def read_run(spark: SparkSession, lake: Lake, table: str, runs: list[int]) -> DataFrame:
    """Good rows that these compactions have rewritten."""
    return _good_rows(_compacted(spark, lake, table).where(F.col("run").isin(runs)), lake, table)


def _good_rows(frame: DataFrame, lake: Lake, table: str) -> DataFrame:
    if table in TOPICS:
        frame = frame.where(F.col(STATUS) == OK)
    return frame.select(*TABLE_SCHEMAS[table].names, lake.period_column)


def read_table(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    return _good_rows(read_landed(spark, lake, table), lake, table)


def read_quarantine(spark: SparkSession, lake: Lake, topic: str) -> DataFrame:
    """Malformed messages with their text and whatever fields could be read."""
    frame = read_landed(spark, lake, topic).where(F.col(STATUS) == MALFORMED)
    return frame.drop(STATUS, lake.period_column)


def stream_table(
    spark: SparkSession,
    lake: Lake,
    table: str,
    files_per_batch: int | None = None,
    landed_at: bool = False,
) -> DataFrame:
    """A landed table as a stream; follows the sink's log of complete files.
    `landed_at` adds the time of each row's file."""
    check_period(spark, lake)
    reader = spark.readStream.schema(lake.schema(table))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(lake.table(table))
    if not landed_at:
        return _good_rows(rows, lake, table)
    names = [*TABLE_SCHEMAS[table].names, F.col(FILE_TIME).alias(LANDED_AT)]
    return (rows.where(F.col(STATUS) == OK) if table in TOPICS else rows).select(*names)


def read_landed_since(spark: SparkSession, lake: Lake, table: str, micros: int | None) -> DataFrame:
    """Rows of the live files of that time or later; no older file is opened."""
    rows = read_live_files(spark, lake, table)
    if micros is not None:
        rows = rows.where(F.col(FILE_TIME) >= F.timestamp_micros(F.lit(micros)))
    return _good_rows(rows, lake, table)
