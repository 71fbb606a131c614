"""Relational export: key contract, column contract, repeated batches.

No database is started here. `FolderTable` stands in for the target; of
`JdbcTable` only the options it hands to Spark are checked.
"""

import contextlib
import datetime as dt
import os
from functools import reduce
from unittest.mock import MagicMock

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.operators.items import relational_shape
from cartstream.operators.keys import KeyViolation, acceptable_rows, key_violations
from cartstream.schemas import ITEM_COLUMNS, ITEMS, RELATIONAL_SCHEMAS, TABLE_SCHEMAS, USERS
from cartstream.sources import FolderTable, JdbcTable, Lake, TextTopic, keyed, relational
from cartstream.streaming import AVAILABLE_NOW, start_export, start_landing
from cartstream.streaming.ingest import export_batch


def users(spark, *rows):
    some = spark.createDataFrame(list(rows), "user_id string, name string")
    blank = spark.createDataFrame([], TABLE_SCHEMAS["users"])
    return blank.unionByName(some, allowMissingColumns=True)


def stored(target, spark):
    return sorted((row.user_id, row.name) for row in target.read(spark).collect())


def test_keyed_table_takes_each_key_once(spark, folder):
    target = FolderTable("users", f"{folder}/users")
    first = users(spark, ("a", "2"), ("a", "1"), ("b", "x"), (None, "y"))
    export_batch(first, "users", target)
    assert stored(target, spark) == [("a", "1"), ("b", "x")]
    export_batch(first, "users", target)
    assert stored(target, spark) == [("a", "1"), ("b", "x")]
    export_batch(users(spark, ("b", "y"), ("c", "z")), "users", target, epoch=1)
    assert stored(target, spark) == [("a", "1"), ("b", "x"), ("c", "z")]
    export_batch(users(spark, ("b", "new")), "users", target, epoch=2)
    assert stored(target, spark) == [("a", "1"), ("b", "new"), ("c", "z")]


@pytest.mark.parametrize(
    "rows, reason",
    [
        ([("a", "1"), ("a", "2")], "key repeated in batch"),
        ([(None, "1")], "null key"),
        ([("old", "1")], "key already stored"),
    ],
)
def test_strict_export_refuses_the_batch(spark, folder, rows, reason):
    target = FolderTable("users", f"{folder}/users")
    export_batch(users(spark, ("old", "0")), "users", target, on_violation="fail")
    with pytest.raises(KeyViolation, match=reason):
        export_batch(
            users(spark, ("new", "1"), *rows), "users", target, on_violation="fail", epoch=1
        )
    assert stored(target, spark) == [("old", "0")]


def test_strict_export_takes_the_same_batch_again(spark, folder):
    target = FolderTable("users", f"{folder}/users")
    for _ in range(2):
        export_batch(users(spark, ("a", "0")), "users", target, on_violation="fail", epoch=4)
    assert stored(target, spark) == [("a", "0")]


def test_a_key_keeps_its_earliest_row_in_any_cut(spark, folder):
    at = lambda day: dt.datetime(2025, 1, day)
    rows = [("a", "z", at(3)), ("a", "y", at(2)), ("a", "x", at(2)), ("a", "w", None), ("b", "v", None)]
    frames = [
        spark.createDataFrame([("n", "e", "l", *row)], "email string, location string, pad string, "
                              "user_id string, name string, registered_at timestamp_ntz").select(
            *TABLE_SCHEMAS["users"].names)
        for row in rows
    ]
    whole = FolderTable("users", f"{folder}/whole")
    export_batch(reduce(DataFrame.unionByName, frames), "users", whole)
    for order in ([0, 1, 2, 3, 4], [4, 3, 2, 1, 0], [2, 0, 4, 1, 3]):
        cut = FolderTable("users", f"{folder}/cut-{order[0]}")
        for epoch, n in enumerate(order):
            export_batch(frames[n], "users", cut, epoch=epoch)
        assert stored(cut, spark) == stored(whole, spark) == [("a", "x"), ("b", "v")]


def test_batches_of_a_feed_are_merged(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed, "FAN_IN", 2)
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 4)
    at = lambda n: dt.datetime(2025, 1, 28 - n)
    target = FolderTable("users", f"{folder}/users")
    expected = {}
    for epoch in range(9):
        rows = [(f"u{n}", f"{epoch}", at(epoch)) for n in range(epoch, epoch + 5)]
        frame = spark.createDataFrame(rows, "user_id string, name string, registered_at timestamp_ntz")
        blank = spark.createDataFrame([], TABLE_SCHEMAS["users"])
        batch = blank.unionByName(frame, allowMissingColumns=True)
        for again in range(2 if epoch % 3 == 2 else 1):  # some come twice
            export_batch(batch, "users", target, feed="one", epoch=epoch)
        export_batch(batch.limit(2), "users", target, feed="two", epoch=epoch)
        expected |= {key: name for key, name, _ in rows}
        assert stored(target, spark) == sorted(expected.items())
    runs = target._noted(spark, "one")
    assert len(runs) <= 5 and max(run.level for run in runs) > 1 and max(run.buckets for run in runs) > 1
    assert runs[-1].name == "8-0"  # the last one may still come again
    assert len(os.listdir(f"{target.path}/feed=one/runs")) == len(runs)
    # A strict batch sees merged keys, in the buckets it can be in, but not its own.
    keys = batch.select("user_id")
    known = {r[0] for r in target.stored_keys(keys, "user_id", "one", 8).collect()}
    assert {"u8", "u9", "u10", "u11"} <= known and "u12" not in known
    strict = users(spark, ("fresh", "1"))
    export_batch(strict, "users", target, on_violation="fail", feed="one", epoch=9)
    with pytest.raises(KeyViolation, match="already stored"):
        export_batch(users(spark, ("u3", "1")), "users", target, on_violation="fail", feed="one", epoch=10)


def test_a_crash_within_a_merge_leaves_the_table(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed, "FAN_IN", 2)
    target = FolderTable("users", f"{folder}/users")
    for epoch in range(2):
        export_batch(users(spark, ("a", "1"), (f"b{epoch}", "1")), "users", target, epoch=epoch)

    def crash(*_):
        raise RuntimeError("crash")

    for broken in ("write_text", "remove"):
        monkeypatch.setattr(relational, broken, crash)
        with pytest.raises(RuntimeError, match="crash"):
            export_batch(users(spark, ("c", "1")), "users", target, epoch=2)
        monkeypatch.undo()
        monkeypatch.setattr(keyed, "FAN_IN", 2)
        assert {"a", "b0", "b1"} <= {r.user_id for r in target.read(spark).collect()}
    export_batch(users(spark, ("c", "1")), "users", target, epoch=2)
    assert stored(target, spark) == [("a", "1"), ("b0", "1"), ("b1", "1"), ("c", "1")]


def test_unkeyed_table_takes_every_row(spark, folder):
    target = FolderTable("clickstream", f"{folder}/clicks")
    clicks = spark.createDataFrame([(None,) * 6] * 3, TABLE_SCHEMAS["clickstream"])
    for _ in range(2):  # the second time as after a crash
        export_batch(clicks, "clickstream", target)
    assert target.read(spark).count() == 3
    export_batch(clicks, "clickstream", target, epoch=1)
    assert target.read(spark).count() == 6


def test_violations_and_accepted_rows_cover_the_batch(spark):
    batch = users(spark, *[("hot", str(n)) for n in range(50)], ("a", "1"), ("s", "2"), (None, "3"))
    known = spark.createDataFrame([("s",), ("s",), ("other",)], "user_id string")
    rejected = key_violations(batch, "user_id", known)
    assert {tuple(row) for row in rejected.collect()} == {
        ("hot", "key repeated in batch", 49),
        ("s", "key already stored", 1),
        (None, "null key", 1),
    }
    accepted = acceptable_rows(batch, "user_id", known)
    assert {(row.user_id, row.name) for row in accepted.collect()} == {("hot", "0"), ("a", "1")}


def test_relational_shape(spark):
    transactions = spark.createDataFrame(
        [("u", "s", "t", None, 1.0, "UPI", "failed", None, [("p", 1, 2.0, None)])],
        TABLE_SCHEMAS["transactions"],
    ).withColumn("event_day", F.current_date())
    shaped = relational_shape(transactions, "transactions")
    assert shaped.schema == RELATIONAL_SCHEMAS["transactions"]
    row = shaped.first()
    assert row.product_category is None
    assert row.products == '[{"product_id":"p","quantity":1,"unit_price":2.0}]'
    items = spark.createDataFrame([], TABLE_SCHEMAS[ITEMS])
    assert relational_shape(items, ITEMS).columns == [c for c in ITEM_COLUMNS if c != "item_pos"]


def test_export_continues_and_survives_a_lost_checkpoint(spark, folder):
    lake, topic = Lake(f"{folder}/lake"), TextTopic(f"{folder}/topic")
    target = FolderTable("users", f"{folder}/users")

    def step(names, query="export_users"):
        if names:
            lines = [(f'{{"user_id":"{name}"}}',) for name in names]
            topic.publish(spark.createDataFrame(lines, "value string"))
        start_landing(spark, USERS, topic, lake, AVAILABLE_NOW).awaitTermination()
        start_export(spark, lake, "users", target, AVAILABLE_NOW, query=query).awaitTermination()
        return target.read(spark).count()

    assert step(["a", "b"]) == 2
    assert step([]) == 2
    assert step(["b", "c"]) == 3
    assert step([], query="export_users_again") == 3
    with pytest.raises(ValueError, match="on_violation"):
        start_export(spark, lake, "users", target, on_violation="ignore")


def options_of(call):
    return call.options.call_args.kwargs


class Double:
    """What a database does with the statements of `JdbcTable.append`: nothing is
    kept before a commit, and a step may fail."""

    def __init__(self):
        self.kept = {"epochs": {}, "rows": []}
        self.stages, self.now, self.fail_at, self.steps = {}, None, None, 0

    def step(self):
        self.steps += 1
        if self.steps == self.fail_at:
            raise RuntimeError("crash")

    def open(self, _=None):
        self.now = {"epochs": dict(self.kept["epochs"]), "rows": list(self.kept["rows"])}
        return self

    def execute(self, sql, *values):
        self.step()
        if sql.startswith("CREATE TABLE IF NOT EXISTS export_epochs"):
            return 0
        if sql.startswith("UPDATE export_epochs"):
            epoch, *key = values
            there = tuple(key) in self.now["epochs"]
            if there:
                self.now["epochs"][tuple(key)] = epoch
            return int(there)
        if sql.startswith("INSERT INTO export_epochs"):
            epoch, *key = values
            self.now["epochs"][tuple(key)] = epoch
            return 1
        target, stage = sql.split()[2], sql.split()[-1]
        assert sql.startswith("INSERT INTO") and target == "clickstream"
        self.now["rows"] += self.stages[stage]
        return len(self.stages[stage])

    def value(self, sql, *values):
        self.step()
        assert sql.startswith("SELECT epoch FROM export_epochs")
        return self.now["epochs"].get(tuple(values))

    def commit(self):
        self.step()
        self.kept, self.now = self.now, None
        self.open()

    def close(self):
        self.now = None

    def write(self, rows, stage, mode):
        self.step()
        assert mode == "overwrite"
        self.stages[stage] = [row.page for row in rows.collect()]


def into(double, monkeypatch):
    monkeypatch.setattr(JdbcTable, "connect", lambda self, spark: double.open())
    monkeypatch.setattr(JdbcTable, "_write", lambda self, rows, table, mode: double.write(rows, table, mode))
    return JdbcTable("clickstream", {"url": "jdbc:x"})


def clicks_of(spark, *pages):
    return spark.createDataFrame([(page,) for page in pages], "page string")


def test_a_batch_is_in_a_database_once_wherever_it_broke_off(spark, monkeypatch):
    batches = [clicks_of(spark, "a", "a"), clicks_of(spark, "b"), clicks_of(spark)]
    double = Double()
    target = into(double, monkeypatch)
    target.append(batches[0], "feed", 0)
    n_steps = double.steps
    for fail_at in range(1, n_steps + 1):
        double = Double()
        target = into(double, monkeypatch)
        for epoch, batch in enumerate(batches):
            double.steps, double.fail_at = 0, fail_at
            with contextlib.suppress(RuntimeError):  # later batches have a step less
                target.append(batch, "feed", epoch)
            assert double.steps == fail_at or epoch
            double.fail_at = None
            target.append(batch, "feed", epoch)
            target.append(batch, "feed", epoch)  # and once more
        assert double.kept["rows"] == ["a", "a", "b"], fail_at
        assert double.kept["epochs"] == {("feed", "clickstream"): 2}


def test_a_strict_batch_that_is_in_a_database_comes_again(spark, monkeypatch):
    """Its own keys are stored by then; that is no violation."""
    double = Double()
    into(double, monkeypatch)
    target = JdbcTable("users", {"url": "jdbc:x"})
    monkeypatch.setattr(JdbcTable, "stored_keys", lambda *_: users(spark).select("user_id"))

    def append(self, rows, feed, epoch):
        double.open().execute("INSERT INTO export_epochs", epoch, feed, "users")
        double.commit()

    monkeypatch.setattr(JdbcTable, "append", append)
    export_batch(users(spark, ("a", "1")), "users", target, on_violation="fail", feed="f", epoch=3)
    monkeypatch.setattr(JdbcTable, "stored_keys", lambda *_: users(spark, ("a", "1")).select("user_id"))
    export_batch(users(spark, ("a", "1")), "users", target, on_violation="fail", feed="f", epoch=3)
    with pytest.raises(KeyViolation):
        export_batch(users(spark, ("a", "1")), "users", target, on_violation="fail", feed="f", epoch=4)


def test_feeds_of_a_database_are_apart_and_do_not_start_over(spark, monkeypatch):
    double = Double()
    target = into(double, monkeypatch)
    for feed in ("one", "two"):
        for epoch in range(2):
            target.append(clicks_of(spark, f"{feed}{epoch}"), feed, epoch)
    assert double.kept["rows"] == ["one0", "one1", "two0", "two1"]
    with pytest.raises(ValueError, match="starts over"):
        target.append(clicks_of(spark, "x"), "one", 0)
    assert len(double.stages) == 2 and len(double.kept["rows"]) == 4


def test_jdbc_write():
    options = {"url": "jdbc:postgresql://db/shop", "user": "u", "password": "secret"}
    table = JdbcTable("users", options)
    assert "secret" not in repr(table)

    rows = MagicMock()
    table._write(rows, table.stage("feed"), "overwrite")
    rows.write.format.assert_called_once_with("jdbc")
    sent = options_of(rows.write.format.return_value)
    assert sent == {**options, "dbtable": table.stage("feed"), "numPartitions": "16"}
    rows.write.format.return_value.options.return_value.mode.assert_called_once_with("overwrite")


def test_a_connection_undoes_what_is_not_committed():
    from cartstream.sources.relational import Database

    spark = MagicMock()
    database = Database(spark, {"url": "jdbc:x", "user": "u", "driver": "d.Driver"})
    connection = spark._jvm.java.sql.DriverManager.getConnection.return_value
    connection.setAutoCommit.assert_called_once_with(False)
    spark._jvm.java.util.Properties.return_value.setProperty.assert_called_once_with("user", "u")
    database.execute("UPDATE t SET a = ? WHERE b = ?", 1, "x")
    statement = connection.prepareStatement.return_value
    assert [c.args for c in statement.setObject.call_args_list] == [(1, 1), (2, "x")]
    statement.executeQuery.return_value.next.return_value = False
    assert database.value("SELECT a FROM t") is None
    database.close()
    assert connection.rollback.called and connection.close.called and not connection.commit.called


def test_jdbc_key_lookup_stays_in_the_database(spark):
    table = JdbcTable("users", {"url": "jdbc:x"}, tasks=4)
    keys = MagicMock()
    table.stored_keys(keys, "user_id")
    write = keys.where.return_value.select.return_value.write.format.return_value
    lookup = options_of(write)["dbtable"]
    assert lookup.startswith("users_keys_") and lookup != table.lookup_table("another feed")
    write.options.return_value.mode.assert_called_once_with("overwrite")
    read = options_of(keys.sparkSession.read.format.return_value)
    assert "stored.user_id = batch.user_id" in read["dbtable"]
    assert (read["partitionColumn"], read["numPartitions"], read["upperBound"]) == ("part", "4", "4")


def test_jdbc_reads_in_parts_without_zones():
    table = JdbcTable("clickstream", {"url": "jdbc:x", "user": "u"}, tasks=3)
    spark = MagicMock()
    table.read(spark)
    (url, name), options = spark.read.jdbc.call_args
    assert (url, name) == ("jdbc:x", "clickstream") and len(options["predicates"]) == 3
    assert "IS NULL" in options["predicates"][0] and "= 2" in options["predicates"][2]
    assert options["properties"] == {"user": "u", "preferTimestampNTZ": "true"}
