"""What keeps disk, shuffles and time in proportion to the input."""

from pathlib import Path

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from cartstream.operators.keys import kept_rows
from cartstream.schemas import TOPICS
from cartstream.sources import Lake, TextTopic, keyed, read_table, topics
from cartstream.sources.lake import LANDED_AT
from cartstream.sources.warehouse import repeated_transaction_messages, transaction_messages
from cartstream.streaming import AVAILABLE_NOW, ingest, start_landing
from cartstream.streaming.keys import follow_batch


def _bytes(folder) -> int:
    return sum(path.stat().st_size for path in Path(folder).rglob("part-*"))


def test_topic_takes_a_fraction_of_its_text(spark, folder):
    messages = transaction_messages(spark, f"{TESTDATA}/sf0.001").persist()
    length = messages.agg(F.sum(F.length("value") + 1)).first()[0]
    topic = TextTopic(f"{folder}/topic")
    topic.publish(messages)
    assert _bytes(topic.path) < length / 4
    assert not messages.exceptAll(topic.read(spark)).count()
    assert topic.read(spark).count() == messages.count()
    messages.unpersist()


def test_topic_files_are_bounded(spark, folder, monkeypatch):
    """A compressed file is read by one task, so none may grow with the topic."""
    monkeypatch.setattr(topics, "FILE_MESSAGES", 100)
    topic = TextTopic(f"{folder}/topic")
    topic.publish(spark.range(1000, numPartitions=1).select(F.col("id").cast("string").alias("value")))
    assert len(list(Path(topic.path).glob("part-*"))) == 10
    assert topic.read(spark).count() == 1000


def test_repeated_shop_publishes_only_what_is_asked_for(spark):
    import __spark_entry__ as entry

    entry._repeated_shop.cache_clear()
    shop = entry.repeated_shop_for(spark, f"{TESTDATA}/sf0.001")
    shop.topic("users")
    assert [path.name for path in Path(shop.root.removeprefix("file:"), "topics").iterdir()] == ["users"]


def test_repeated_messages_join_once(spark):
    messages = repeated_transaction_messages(spark, f"{TESTDATA}/sf0.001")
    plan = messages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2
    rows = messages.groupBy("value").count()
    number = F.regexp_extract("value", r"TXN0*(\d+)-", 1).cast("long")
    sent = rows.groupBy((number % 42).alias("rest")).agg(F.sum("count").alias("n"), F.count("*").alias("kinds"))
    plain = transaction_messages(spark, f"{TESTDATA}/sf0.001").groupBy((number % 42).alias("rest"))
    for row in sent.join(plain.count(), "rest").collect():
        copies = 1 + (row["rest"] % 3 == 0) + (row["rest"] % 7 in (0, 1))
        assert row["n"] == copies * row["count"], row


def _users(spark, numbers: range, day: int):
    time = F.make_date(F.lit(2024), F.lit(1), F.lit(day)).cast("timestamp_ntz")
    user = F.concat(F.lit("U"), F.col("id").cast("string"))
    frame = spark.range(numbers.start, numbers.stop)
    return frame.select(user.alias("user_id"), time.alias("registered_at"), *(user.alias(n) for n in ("name", "email", "location")))


@pytest.mark.parametrize("few", [True, False])
def test_a_batch_takes_only_its_own_keys_from_the_store(spark, folder, monkeypatch, few):
    if not few:
        monkeypatch.setattr(keyed, "LOOKUP_ROWS", 0)
    runs = keyed.KeyedStore("users", folder).runs
    stored = runs.write(_users(spark, range(1000), 2), "0-0", 0, 4)
    found = runs.lookup(_users(spark, range(990, 1010), 1), (stored,))
    wanted = found.where(F.substring("user_id", 2, 9).cast("int") >= 990)
    assert wanted.count() == 10 and (found.count() == 10) is few


def test_runs_are_merged_in_one_shuffle(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 100)
    runs = keyed.KeyedStore("users", folder).runs
    parts = [runs.write(_users(spark, range(n * 50, n * 50 + 100), 9 - n), f"{n}-0", 0, 1) for n in range(keyed.FAN_IN)]
    (whole,) = runs.merged(spark, parts, 7)
    assert (whole.level, whole.buckets, whole.rows) == (1, 8, 450)
    rows = runs.rows(spark, [whole])
    kept = kept_rows(runs.rows(spark, parts), "users", runs.columns)
    assert rows.count() == 450 and not rows.exceptAll(kept).count()
    touched = runs.touched(rows, [whole])
    assert runs.rows(spark, [whole], touched).count() == 450
    files = list(Path(runs.path(whole.name)).rglob("part-*"))
    assert len(files) == len(touched[8])  # one file a bucket


@pytest.mark.parametrize("buckets, shuffles", [(1, 0), (4, 1)])
def test_a_run_of_one_bucket_is_written_as_it_lies(spark, folder, monkeypatch, buckets, shuffles):
    hints = []
    hint = type(spark.range(0)).hint
    monkeypatch.setattr(type(spark.range(0)), "hint", lambda self, *a: hints.append(a) or hint(self, *a))
    run = keyed.KeyedStore("users", folder).runs.write(_users(spark, range(50), 1), "0-0", 0, buckets)
    assert run.rows == 50 and len(hints) == shuffles


def test_parts_meet_the_lines_after_the_shuffle(spark):
    """Lines are shuffled with the orders; a part's text is not carried through that."""
    messages = transaction_messages(spark, f"{TESTDATA}/sf0.001")
    plan = messages._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "p_partkey" in joins[0] and "o_orderkey" in joins[1]


def test_small_runs_are_one_scan(spark, folder):
    runs = keyed.KeyedStore("users", folder).runs
    parts = [runs.write(_users(spark, range(n * 10, n * 10 + 20), 9 - n), f"{n}-0", 0, 1 + n % 2) for n in range(6)]
    rows = runs.rows(spark, parts, {2: [0, 1]})
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert rows.count() == 120 and rows.columns == runs.schema.names
    some = runs.rows(spark, parts, {2: [1]})
    assert some.count() == 60 + sum(runs.rows(spark, [run], {2: [1]}).count() for run in parts[1::2])


def test_a_batch_is_read_only_in_what_is_stored(spark, folder):
    store = keyed.KeyedStore("users", folder)
    batch = _users(spark, range(20), 1).withColumn(LANDED_AT, F.current_timestamp())
    batch = batch.withColumn("more", F.raise_error(F.concat(F.lit("read of "), "user_id")))
    follow_batch(batch, 0, store)
    assert sum(run.rows for run in store.note(spark).runs) == 20


@pytest.mark.parametrize("most", [2, 16])
def test_landing_sorts_nothing_but_rows_of_too_many_periods(spark, folder, monkeypatch, most):
    """A sorted task of compressed messages spills."""
    monkeypatch.setattr(ingest, "OPEN_FILES", most)
    spark.conf.unset(ingest.OPEN_FILES_SETTING)
    line = '{"user_id":"u%d","registered_at":"2025-01-0%d 10:00:00"}'
    messages = [(line % (n, 1 + n % 5),) for n in range(100)]
    topic, lake = TextTopic(f"{folder}/topic"), Lake(f"{folder}/lake")
    topic.publish(spark.createDataFrame(messages, "value string").coalesce(1))
    start_landing(spark, TOPICS["users"], topic, lake, AVAILABLE_NOW).awaitTermination()
    assert spark.conf.get(ingest.OPEN_FILES_SETTING) == str(most)
    rows = read_table(spark, lake, "users")
    assert sorted(int(r["user_id"][1:]) for r in rows.select("user_id").collect()) == [*range(100)]
    assert len(list(Path(lake.table("users")).rglob("part-*.parquet"))) == 5
    spark.conf.unset(ingest.OPEN_FILES_SETTING)


def test_a_small_batch_is_one_file_beside_a_large_table(spark, folder, monkeypatch):
    """And of a batch that touches all buckets nothing is asked but its size."""
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 100)
    store = keyed.KeyedStore("users", folder)
    asked = []
    touched = keyed.Runs.touched
    monkeypatch.setattr(keyed.Runs, "touched", lambda self, *a: asked.append(a) or touched(self, *a))
    landed = lambda numbers, day: _users(spark, numbers, day).withColumn(LANDED_AT, F.current_timestamp())
    follow_batch(landed(range(1000), 2), 0, store)
    (large,) = store.note(spark).runs
    assert (large.buckets, large.rows) == (16, 1000)
    asked.clear()
    follow_batch(landed(range(960, 1020), 1), 1, store)  # 40 keys are there, later
    large, small = store.note(spark).runs
    assert (small.buckets, small.rows, len(asked)) == (1, 60, 1)
    asked.clear()
    follow_batch(landed(range(0, 600), 1), 2, store)
    assert not asked
    rows = store.runs.read(spark, store.note(spark).runs)
    assert rows.count() == 1020
    assert rows.where(F.dayofmonth("registered_at") == 1).count() == 600 + 60
