"""A keyed table's batches are written as they lie; merges and reads settle their keys."""

import datetime as dt
import os

from cartstream.schemas import TABLE_SCHEMAS
from cartstream.sources import FolderTable, keyed
from cartstream.streaming.ingest import export_batch


def _users(spark, *rows):
    frame = spark.createDataFrame(rows, "user_id string, name string, registered_at timestamp_ntz")
    blank = spark.createDataFrame([], TABLE_SCHEMAS["users"])
    return blank.unionByName(frame, allowMissingColumns=True)


def _stored(target, spark):
    return sorted((r.user_id, r.name) for r in target.read(spark).collect())


def test_a_batch_is_not_shuffled(spark, tmp_path):
    target = FolderTable("users", f"{tmp_path}/users")
    day = dt.datetime(2025, 1, 2)
    rows = [("a", "late", day), ("a", "early", day - dt.timedelta(1)), ("a", "late", day), (None, "x", day), ("b", "y", day)]
    export_batch(_users(spark, *rows), "users", target, feed="one")
    (run,) = target._noted(spark, "one")
    assert (run.rows, run.buckets) == (4, 1)  # all but the one without a key
    path = target._runs("one").path(run.name)
    assert all(".zstd." in f for _, _, files in os.walk(path) for f in files if f.endswith(".parquet"))
    assert _stored(target, spark) == [("a", "early"), ("b", "y")]


def test_first_merges_put_together_later_ones_settle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "FAN_IN", 2)
    target = FolderTable("users", f"{tmp_path}/users")
    at = lambda n: dt.datetime(2025, 1, 28 - n)
    for epoch in range(5):
        batch = _users(spark, ("a", f"{epoch}", at(epoch)), ("a", f"{epoch}", at(epoch)), (f"b{epoch}", "", at(0)))
        export_batch(batch, "users", target, feed="one", epoch=epoch)
        runs = target._noted(spark, "one")
        if epoch == 2:
            assert [(run.level, run.rows) for run in runs] == [(1, 6), (0, 3)]
    assert [(run.level, run.rows) for run in runs] == [(2, 5), (0, 3)]  # a, b0 to b3
    assert _stored(target, spark) == [("a", "4"), *((f"b{n}", "") for n in range(5))]
