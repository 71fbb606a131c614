"""Log-structured tables of one row per key.

Each batch adds a run, and FAN_IN runs of a level are merged into one of the next.
A run's rows are in buckets by a hash of the key, as many as its size asks for, so
the keys of a batch are looked up in the buckets they can be in and nowhere else.

`KeyedStore` keeps what counts of each key of a landed table. Which runs make it up
after batch n stands in the note n, written last. A batch that comes again, after
a crash at any point, starts from the note before it and leaves the same table and
the same totals.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cartstream.operators.keys import kept_rows
from cartstream.schemas import INT, PRIMARY_KEYS, RELATIONAL_SCHEMAS, STRING
from cartstream.sources.files import codec, names_in, read_text, remove, write_text

# Runs of a level that are merged into one of the next level.
FAN_IN = 8

# Rows that a bucket of a merged run holds, about.
BUCKET_ROWS = 1 << 20

# Rows of a batch, at most, whose keys' hashes go to all tasks that scan stored runs:
# only rows that one of them may have leave the scan. A larger batch meets the whole
# of its buckets.
LOOKUP_ROWS = 1 << 21

# Rows of a batch for each bucket from which on all buckets count as touched.
TOUCHES_ALL = 32

# Notes that stay, with their runs and totals, for readers that started on them.
KEPT_NOTES = 4

# What is kept of each key's row: all that decides which row counts, up to the
# last column that a panel shows.
STORED = {
    "users": ("registered_at", "name", "email", "location"),
    "transactions": (
        "timestamp", "user_id", "session_id", "transaction_amount", "payment_method", "payment_status",
    ),
}

NEW, OLD, BUCKET = "new", "old", "bucket"


@dataclass(frozen=True)
class Run:
    name: str
    level: int
    buckets: int
    rows: int


Touched = dict[int, list[int]]


def buckets_for(n_rows: int) -> int:
    return 1 << max(-(-n_rows // BUCKET_ROWS) - 1, 0).bit_length()


def runs_of(stored: list[dict]) -> tuple[Run, ...]:
    return tuple(Run(**run) for run in stored)


@dataclass(frozen=True)
class Runs:
    """Runs of `table`'s rows below `root`. `columns`: what is kept of a row besides
    its key, the first ones of those that decide which row counts."""

    table: str
    columns: tuple[str, ...]
    root: str

    @property
    def key(self) -> str:
        return PRIMARY_KEYS[self.table]

    @property
    def schema(self) -> StructType:
        kinds = RELATIONAL_SCHEMAS[self.table]
        return StructType([StructField(self.key, STRING), *(kinds[name] for name in self.columns)])

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def touched(self, keys: DataFrame, runs: Sequence[Run]) -> Touched:
        """By number of buckets, those that `keys` are in: at most so many numbers."""
        return {
            n: [row[0] for row in keys.select(self.bucket(n)).distinct().collect()]
            for n in {run.buckets for run in runs} - {1}
        }

    def rows(self, spark: SparkSession, runs: Sequence[Run], touched: Touched | None = None) -> DataFrame:
        """All rows of `runs`, of the buckets that are touched."""
        if not runs:
            return spark.createDataFrame([], self.schema)
        schema = StructType([*self.schema.fields, StructField(BUCKET, INT)])
        parts, whole = [], []
        for run in runs:
            if touched is None or run.buckets == 1 or len(touched[run.buckets]) == run.buckets:
                whole.append(self.path(run.name))
                continue
            part = spark.read.schema(schema).parquet(self.path(run.name))
            parts.append(part.where(F.col(BUCKET).isin(touched[run.buckets])).drop(BUCKET))
        if whole:  # one scan, whose tasks take small files of several runs
            reader = spark.read.schema(self.schema).option("recursiveFileLookup", True)
            parts.append(reader.parquet(*whole))
        return reduce(DataFrame.unionAll, parts)

    def read(self, spark: SparkSession, runs: Sequence[Run], touched: Touched | None = None) -> DataFrame:
        """One row per key."""
        return kept_rows(self.rows(spark, runs, touched), self.table, self.columns)

    def lookup(self, keys: DataFrame, runs: Sequence[Run], n_keys: int | None = None) -> DataFrame:
        """One row per key, of `keys` and maybe of some others. Only the buckets
        that `keys` are in are opened; where they are few, nothing else is shuffled.
        `n_keys`: how many `keys` there are, null ones left out, if that is known."""
        spark, keys = keys.sparkSession, keys.where(F.col(self.key).isNotNull()).select(self.key)
        if runs and n_keys is None:
            n_keys = keys.count()
        most = max((run.buckets for run in runs), default=1)
        many = runs and n_keys >= TOUCHES_ALL * most
        stored = self.rows(spark, runs, None if many else self.touched(keys, runs))
        if runs and n_keys <= LOOKUP_ROWS:
            hashes = keys.select(F.xxhash64(self.key).alias("hash"))
            same = F.xxhash64(stored[self.key]) == hashes["hash"]
            stored = stored.join(F.broadcast(hashes), same, "left_semi")
        return kept_rows(stored, self.table, self.columns)

    def write(self, rows: DataFrame, name: str, level: int, buckets: int) -> Run:
        """`rows` may have more columns than are kept. They come from a shuffle by
        their key, so where there is one bucket they are written as they lie."""
        rows = rows.withColumn(BUCKET, self.bucket(buckets))
        rows = rows.hint("rebalance", BUCKET) if buckets > 1 else rows
        return self._saved(rows, name, level, buckets)

    def append(self, rows: DataFrame, name: str, level: int = 0) -> Run:
        """`rows` as they lie, of which several may have a key, as a run of one bucket;
        none without a key. Nothing is shuffled: keys are settled in merges and reads."""
        rows = rows.where(F.col(self.key).isNotNull()).select(*self.schema.names)
        return self._saved(rows.withColumn(BUCKET, F.lit(0)), name, level, 1)

    def _saved(self, rows: DataFrame, name: str, level: int, buckets: int) -> Run:
        spark = rows.sparkSession
        writer = rows.write.mode("overwrite").option("compression", codec(spark))
        writer.partitionBy(BUCKET).parquet(self.path(name))
        return self._written(spark, name, level, buckets)

    def _written(self, spark: SparkSession, name: str, level: int, buckets: int) -> Run:
        n_rows = spark.read.schema(self.schema).parquet(self.path(name)).count()
        return Run(name, level, buckets, n_rows)

    def merge(self, spark: SparkSession, runs: Sequence[Run], name: str, level: int, buckets: int) -> Run:
        """One row per key of `runs`, as a run. Rows are shuffled once, to the
        buckets that they are settled and written in."""
        rows = self.rows(spark, runs).withColumn(BUCKET, self.bucket(buckets)).repartitionById(buckets, BUCKET)
        time, *others = self.columns
        ranked = F.struct(F.col(time).isNull().alias("timeless"), time, *others)
        kept = rows.groupBy(BUCKET, self.key).agg(F.min(ranked).alias("row"))
        kept = kept.select(self.key, *(F.col(f"row.{column}") for column in self.columns), BUCKET)
        return self._saved(kept, name, level, buckets)

    def merged(
        self, spark: SparkSession, runs: Sequence[Run], epoch: int, newest: int = 0, settle: int = 0
    ) -> tuple[Run, ...]:
        """`runs` with each full level's merged into one of the next level, apart
        from the `newest` last ones. Levels below `settle` are only put together."""
        runs, last = list(runs[: len(runs) - newest]), list(runs[len(runs) - newest :])
        level = 0
        while sum(run.level == level for run in runs) >= FAN_IN:
            full = [run for run in runs if run.level == level]
            n_rows = sum(run.rows for run in full)
            buckets = buckets_for(n_rows)
            runs = [run for run in runs if run.level != level]
            name = f"{epoch}-{level + 1}"
            if level < settle:
                runs.append(self.append(self.rows(spark, full), name, level + 1))
            else:
                runs.append(self.merge(spark, full, name, level + 1, buckets))
            level += 1
        return (*runs, *last)


@dataclass(frozen=True)
class Note:
    """The table after a batch. `frontier`: microseconds; all landed files older
    than this are in it."""

    epoch: int
    frontier: int | None = None
    runs: tuple[Run, ...] = field(default=())


@dataclass(frozen=True)
class KeyedStore:
    """Of one landed table. `root` is a folder of its own."""

    table: str
    root: str

    @property
    def runs(self) -> Runs:
        return Runs(self.table, STORED[self.table], f"{self.root}/runs")

    @property
    def key(self) -> str:
        return PRIMARY_KEYS[self.table]

    def totals(self, epoch: int, panel: str) -> str:
        return f"{self.root}/totals/{epoch}/{panel}"

    # Notes

    def _epochs(self, spark: SparkSession) -> list[int]:
        names = names_in(spark, f"{self.root}/notes")
        return sorted(int(name) for name in names if name.isdigit())

    def note(self, spark: SparkSession, before: int | None = None) -> Note | None:
        """The last note, or the last one of an epoch below `before`."""
        epochs = [e for e in self._epochs(spark) if before is None or e < before]
        if not epochs:
            return None
        stored = json.loads(read_text(spark, f"{self.root}/notes/{epochs[-1]}"))
        return Note(**{**stored, "runs": runs_of(stored["runs"])})

    def finish(self, spark: SparkSession, note: Note) -> None:
        """Write a batch's note; from now on readers see the batch. Runs and
        totals that no kept note names are deleted."""
        write_text(spark, f"{self.root}/notes/{note.epoch}", json.dumps(asdict(note)))
        epochs = self._epochs(spark)
        # Numbers start again when the stream does: later ones are of the old one.
        gone = [e for e in epochs if e > note.epoch] + [e for e in epochs if e <= note.epoch][:-KEPT_NOTES]
        if not gone:
            return
        for epoch in gone:
            remove(spark, f"{self.root}/notes/{epoch}")
            remove(spark, f"{self.root}/totals/{epoch}")
        named = set()
        for epoch in set(epochs) - set(gone):
            stored = json.loads(read_text(spark, f"{self.root}/notes/{epoch}"))
            named |= {run["name"] for run in stored["runs"]}
        for name in set(names_in(spark, f"{self.root}/runs")) - named:
            remove(spark, self.runs.path(name))

    # Rows

    def _rank(self, row: str) -> Column:
        time, *others = STORED[self.table]
        return F.struct(F.col(f"{row}.{time}").isNull(), F.col(f"{row}.{time}"), *(F.col(f"{row}.{c}") for c in others))

    def changes(self, rows: DataFrame, note: Note | None, n_keys: int | None = None) -> DataFrame:
        """Keys whose row changes when `rows` come to the table of `note`: the key,
        its `new` row and its `old` one, NULL where there was none. `n_keys`: see `lookup`."""
        names = STORED[self.table]
        best = kept_rows(rows, self.table, names)
        before = self.runs.lookup(rows, note.runs if note else (), n_keys)
        both = best.select(self.key, F.struct(*names).alias(NEW)).join(
            before.select(self.key, F.struct(*names).alias(OLD)), self.key, "left"
        )
        return both.where(F.col(OLD).isNull() | (self._rank(NEW) < self._rank(OLD)))

    def add(
        self, changes: DataFrame, epoch: int, note: Note | None, n_keys: int
    ) -> tuple[DataFrame, tuple[Run, ...]]:
        """Write a batch's `changes`, at most `n_keys`, as a run; they, read back, and
        the runs now. Its buckets are those its own size asks for, so that it is one
        file or a few, however large the table is. Merged runs leave the old rows out."""
        spark = changes.sparkSession
        runs = note.runs if note else ()
        flat = changes.select(self.key, f"{NEW}.*", OLD)
        run = self.runs.write(flat, f"{epoch}-0", 0, buckets_for(n_keys))
        written = spark.read.schema(flat.schema).parquet(self.runs.path(run.name)).drop(BUCKET)
        return written, self.runs.merged(spark, (*runs, run), epoch)

    def signed(self, changes: DataFrame) -> DataFrame:
        """Changed keys' rows with a `sign`: 1 for the new row, -1 for the old one.
        `changes` as `add` returns them or as `changes` does."""
        if NEW in changes.columns:
            changes = changes.select(self.key, f"{NEW}.*", OLD)
        old = changes.where(F.col(OLD).isNotNull()).select(self.key, f"{OLD}.*", F.lit(-1).alias("sign"))
        return changes.drop(OLD).withColumn("sign", F.lit(1)).unionByName(old)
