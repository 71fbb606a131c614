"""Relational tables: find stored keys, append rows.

Both classes are export targets (`append`, `stored_keys`). `JdbcTable` is the
real one. `FolderTable` holds the same rows as Parquet in the shared folder, for
shops without a database and for checks that must not start one.

An export is a feed of numbered batches (epochs); a batch may come again.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartstream.operators.keys import kept_rows
from cartstream.schemas import INT, PRIMARY_KEYS, RELATIONAL_SCHEMAS, STRING, TOPICS, struct
from cartstream.sources.files import names_in, read_text, remove, write_text
from cartstream.sources.keyed import Run, Runs, runs_of

# Of each feed and target table the last batch that is in it.
EPOCHS = "export_epochs"


class Database:
    """A connection of the driver's, for the few statements that are not data."""

    def __init__(self, spark: SparkSession, options: Mapping[str, str]) -> None:
        java = spark._jvm.java
        settings = java.util.Properties()
        for name, value in options.items():
            if name not in ("url", "driver"):
                settings.setProperty(name, value)
        if "driver" in options:
            spark._jvm.org.apache.spark.util.Utils.classForName(options["driver"], True, True)
        self.connection = java.sql.DriverManager.getConnection(options["url"], settings)
        self.connection.setAutoCommit(False)

    def _prepared(self, sql: str, values: tuple):
        statement = self.connection.prepareStatement(sql)
        for place, value in enumerate(values, start=1):
            statement.setObject(place, value)
        return statement

    def execute(self, sql: str, *values) -> int:
        """How many rows it has changed."""
        statement = self._prepared(sql, values)
        try:
            return statement.executeUpdate()
        finally:
            statement.close()

    def value(self, sql: str, *values):
        """The first value of the first row, or None."""
        statement = self._prepared(sql, values)
        try:
            rows = statement.executeQuery()
            return rows.getObject(1) if rows.next() else None
        finally:
            statement.close()

    def commit(self) -> None:
        self.connection.commit()

    def close(self) -> None:
        """What is not committed is undone."""
        self.connection.rollback()
        self.connection.close()


@dataclass(frozen=True)
class JdbcTable:
    """`options` carry url, user, password and driver, from the caller's secrets.

    `tasks` bounds the connections that a read, an append or a key lookup opens.
    `part` is the database's expression for which of `tasks` parts a row is in.
    Stored rows stay as they are: of a key that comes in several batches, the
    first batch's row.

    A batch is written beside the table first, and moves into it in one
    transaction with its feed's mark in the table EPOCHS. One that comes again, with
    a key or without, finds the mark and adds nothing, wherever it broke off.
    """

    replaces = False

    table: str
    options: Mapping[str, str] = field(repr=False)
    tasks: int = 16
    part: str = "mod(abs(hashtext(CAST({column} AS text))::bigint), {tasks})"

    def lookup_table(self, feed: str) -> str:
        """Holds the keys of one batch of a feed; overwritten by its next one."""
        return f"{self.table}_keys_{sha256(feed.encode()).hexdigest()[:12]}"

    def read(self, spark: SparkSession) -> DataFrame:
        """The table over `tasks` connections, times without a zone."""
        column = RELATIONAL_SCHEMAS[self.table].names[0]
        part = self.part.format(column=column, tasks=self.tasks)
        parts = [f"{part} = {n}" for n in range(self.tasks)]
        parts[0] += f" OR {column} IS NULL"
        options = {name: value for name, value in self.options.items() if name != "url"}
        return spark.read.jdbc(
            self.options["url"],
            self.table,
            predicates=parts,
            properties={**options, "preferTimestampNTZ": "true"},
        )

    def stored_keys(self, keys: DataFrame, key: str, feed: str = "", epoch: int = 0) -> DataFrame:
        """Which of a batch's keys the table holds.

        The batch's keys go to a table of their own and the database joins the
        two, so what is read grows with the batch and not with the table. Keys
        are only compared for equality: the order of text in the database is
        not Spark's, so a range of keys would not mean the same there.
        """
        part = F.pmod(F.xxhash64(key), F.lit(self.tasks)).cast("int").alias("part")
        lookup = self.lookup_table(feed)
        self._write(keys.where(F.col(key).isNotNull()).select(key, part), lookup, "overwrite")
        known = (
            f"(SELECT batch.part, stored.{key} FROM {self.table} stored "
            f"JOIN {lookup} batch ON stored.{key} = batch.{key}) known"
        )
        return (
            keys.sparkSession.read.format("jdbc")
            .options(
                **self.options,
                dbtable=known,
                partitionColumn="part",
                lowerBound="0",
                upperBound=str(self.tasks),
                numPartitions=str(self.tasks),
            )
            .load()
            .select(F.col(key).alias(key))
        )

    def stage(self, feed: str) -> str:
        """Holds one batch of a feed on its way; overwritten by its next one."""
        return f"{self.table}_stage_{sha256(feed.encode()).hexdigest()[:12]}"

    def has(self, spark: SparkSession, feed: str, epoch: int) -> bool:
        """Whether the batch is in the table already."""
        database = self.connect(spark)
        try:
            database.execute(
                f"CREATE TABLE IF NOT EXISTS {EPOCHS} (feed VARCHAR(200), target VARCHAR(200), "
                "epoch BIGINT, PRIMARY KEY (feed, target))"
            )
            database.commit()
            return self._is_in(database, feed, epoch)
        finally:
            database.close()

    def append(self, rows: DataFrame, feed: str = "", epoch: int = 0) -> None:
        if self.has(rows.sparkSession, feed, epoch):
            return
        database = self.connect(rows.sparkSession)
        try:
            self._write(rows, self.stage(feed), "overwrite")
            # Again, in the transaction: another run of the batch may be ahead.
            if not self._is_in(database, feed, epoch):
                mark = (epoch, feed, self.table)
                if not database.execute(f"UPDATE {EPOCHS} SET epoch = ? WHERE feed = ? AND target = ?", *mark):
                    database.execute(f"INSERT INTO {EPOCHS} (epoch, feed, target) VALUES (?, ?, ?)", *mark)
                names = ", ".join(rows.columns)
                database.execute(
                    f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {self.stage(feed)}"
                )
            database.commit()
        finally:
            database.close()

    def _is_in(self, database: Database, feed: str, epoch: int) -> bool:
        where = (feed, self.table)
        last = database.value(f"SELECT epoch FROM {EPOCHS} WHERE feed = ? AND target = ?", *where)
        if last is not None and epoch < last:
            raise ValueError(
                f"feed {feed!r} of {self.table} starts over at batch {epoch} after {last}: "
                "give it another name, or empty the table and take its mark away"
            )
        return last == epoch

    def connect(self, spark: SparkSession) -> Database:
        return Database(spark, self.options)

    def _write(self, rows: DataFrame, table: str, mode: str) -> None:
        (
            rows.write.format("jdbc")
            .options(**self.options, dbtable=table, numPartitions=str(self.tasks))
            .mode(mode)
            .save()
        )


@dataclass(frozen=True)
class FolderTable:
    """Rows in a folder per feed and epoch.

    A batch that comes again replaces its folder, so nothing is there twice. A
    key that came in several batches is settled when the table is read, by the
    rule of `kept_rows`: how a feed was cut into batches does not matter. Of a
    keyed table each feed's batches are runs (`Runs`) that are merged as they get
    many, all but the last one, which may come again; a reader that started
    before a merge may have to start anew. A batch is written as it lies, with
    keys that it has several times, and so are the first runs that are merged; the
    next merge leaves one row per key. So most rows are shuffled only when the table is read.
    """

    table: str
    path: str

    replaces = True

    def _runs(self, feed: str) -> Runs:
        key, time = PRIMARY_KEYS[self.table], TOPICS[self.table].time_column
        others = [n for n in RELATIONAL_SCHEMAS[self.table].names if n not in (key, time)]
        return Runs(self.table, (time, *others), f"{self.path}/feed={feed}/runs")

    def _notes(self, spark: SparkSession, feed: str) -> list[int]:
        return sorted(int(n) for n in names_in(spark, f"{self.path}/feed={feed}/notes") if n.isdigit())

    def _noted(self, spark: SparkSession, feed: str) -> tuple[Run, ...]:
        """The feed's runs, as its last note says."""
        notes = self._notes(spark, feed)
        return runs_of(json.loads(read_text(spark, f"{self.path}/feed={feed}/notes/{notes[-1]}"))) if notes else ()

    def _feeds(self, spark: SparkSession) -> list[str]:
        return sorted(n.partition("=")[2] for n in names_in(spark, self.path) if n.startswith("feed="))

    def read(self, spark: SparkSession) -> DataFrame:
        schema = RELATIONAL_SCHEMAS[self.table]
        if self.table not in PRIMARY_KEYS:
            if not self._feeds(spark):
                return spark.createDataFrame([], schema)
            folders = struct({"feed": STRING, "epoch": INT})
            rows = spark.read.schema(StructType(schema.fields + folders.fields)).parquet(self.path)
            return rows.select(*schema.names)
        rows = spark.createDataFrame([], schema)
        for feed in self._feeds(spark):
            rows = rows.unionByName(self._runs(feed).rows(spark, self._noted(spark, feed)))
        return kept_rows(rows, self.table).select(*schema.names)

    def stored_keys(self, keys: DataFrame, key: str, feed: str = "", epoch: int = 0) -> DataFrame:
        """Keys in the buckets that the batch's keys are in (runs that are not settled
        have one), apart from those that this very batch has left in an earlier run."""
        spark = keys.sparkSession
        keys = keys.where(F.col(key).isNotNull())
        stored = spark.createDataFrame([], struct({key: STRING}))
        for other in self._feeds(spark):
            runs = self._noted(spark, other)
            if other == _folder(feed):
                runs = tuple(run for run in runs if run.name != f"{epoch}-0")
            here = self._runs(other)
            stored = stored.union(here.rows(spark, runs, here.touched(keys, runs)).select(key))
        return stored

    def append(self, rows: DataFrame, feed: str = "", epoch: int = 0) -> None:
        feed = _folder(feed)
        if self.table not in PRIMARY_KEYS:
            rows.write.mode("overwrite").parquet(f"{self.path}/feed={feed}/epoch={epoch}")
            return
        spark, here = rows.sparkSession, self._runs(feed)
        name = f"{epoch}-0"
        before = self._noted(spark, feed)
        others = tuple(run for run in before if run.name != name)
        run = here.append(rows, name)
        runs = here.merged(spark, (*others, run), epoch, newest=1, settle=1)
        notes = self._notes(spark, feed)
        folder = f"{self.path}/feed={feed}/notes"
        write_text(spark, f"{folder}/{notes[-1] + 1 if notes else 0}", json.dumps([asdict(run) for run in runs]))
        for old in notes[:-1]:
            remove(spark, f"{folder}/{old}")
        for gone in set(names_in(spark, here.root)) - {run.name for run in runs}:
            remove(spark, here.path(gone))


def _folder(feed: str) -> str:
    return feed or "rows"
