"""What Spark is asked to do: scans, pushdown, shuffles, no Python in tasks."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cartstream.operators.items import transaction_items
from cartstream.operators.parse import parsed_table
from cartstream.plans.panels import PANELS
from cartstream.plans.shop import shop_for
from cartstream.schemas import ITEMS, TRANSACTIONS
from conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"
DAY = dt.date(1998, 10, 3)


def plan(frame, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()


@pytest.fixture(scope="module")
def shop(spark):
    shop = shop_for(spark, FOLDER)
    for table in ("users", "clickstream", "transactions", ITEMS):
        shop.ensure(table)
    return shop


@pytest.mark.parametrize(
    "name, columns",
    [
        ("total_users", "user_id:string"),
        ("new_users_today", "user_id:string,registered_at:timestamp_ntz"),
        (
            "top_locations",
            "user_id:string,name:string,email:string,location:string,registered_at:timestamp_ntz",
        ),
        ("top_pages", "page:string"),
        (
            "revenue_today",
            "user_id:string,session_id:string,transaction_id:string,timestamp:timestamp_ntz,"
            "transaction_amount:double,payment_method:string,payment_status:string",
        ),
        ("top_categories", "product_category:string,quantity:int"),
        ("revenue_by_category", "product_category:string,product_spend:double"),
    ],
)
def test_a_panel_reads_only_its_columns(shop, name, columns):
    panel = PANELS[name]
    text = plan(panel.run(shop.table(panel.table), DAY))
    assert f"ReadSchema: struct<{columns}>" in text
    assert ("partial_" in text or name == "total_users") and "Python" not in text


@pytest.mark.parametrize("name", ["new_users_today", "revenue_today"])
def test_today_opens_no_later_period_and_pushes_the_day(shop, name):
    panel = PANELS[name]
    text = plan(panel.run(shop.table(panel.table), DAY))
    partitions = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    assert "event_year" in partitions and "1998-01-01" in partitions and "ok" in partitions
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert f"LessThan({panel.day_column},1998-10-04T00:00)" in pushed


@pytest.mark.parametrize("name", ["top_pages", "top_categories", "top_locations"])
def test_top_five_is_not_a_full_sort(shop, name):
    panel = PANELS[name]
    text = plan(panel.run(shop.table(panel.table)))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_parsing_is_one_pass_without_a_shuffle(spark, shop):
    text = plan(parsed_table(shop.topic("transactions").read(spark), TRANSACTIONS), "simple")
    assert text.count("from_json(") == 1 and "Exchange" not in text


def test_order_lines_need_no_shuffle(shop):
    assert "Exchange" not in plan(transaction_items(shop.table("transactions")))


@pytest.mark.parametrize("name", ["journey", "journey_wide", "journey_count"])
def test_journeys_shuffle_each_table_on_its_key(spark, shop, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry.queries()[name](spark, FOLDER), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("SortMergeJoin") == 2 and "CartesianProduct" not in text
    assert "NestedLoop" not in text and "BroadcastHashJoin" not in text
    if name != "journey_count":
        assert text.count("Exchange hashpartitioning") == 4
    if name == "journey":
        assert "ReadSchema: struct<user_id:string,session_id:string,page:string>" in text


def test_no_query_runs_python_in_tasks(spark, shop):
    for name, query in entry.shop_queries().items():
        if not name.startswith(("publish", "stream", "quarantine")):
            text = plan(query(spark, FOLDER), "simple")
            assert "Python" not in text and "Pandas" not in text and "Arrow" not in text, name


def test_copies_of_a_key_are_combined_before_the_shuffle(spark):
    from cartstream.operators.keys import acceptable_rows

    batch = spark.range(100).select(
        F.lit("hot").alias("user_id"), F.col("id").cast("string").alias("name")
    )
    text = plan(acceptable_rows(batch, "user_id", batch.limit(0)), "simple")
    assert "partial_min" in text


def test_a_strict_batch_opens_only_its_buckets(spark, folder, monkeypatch):
    from cartstream.sources import FolderTable, keyed
    from cartstream.streaming.ingest import export_batch

    monkeypatch.setattr(keyed, "FAN_IN", 2)
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 10)
    target = FolderTable("users", f"{folder}/users")
    columns = "user_id string, name string, email string, location string, registered_at timestamp_ntz"
    users = spark.createDataFrame([(f"u{n}", "n", "e", "l", None) for n in range(200)], columns)
    for epoch in range(5):
        part = users.where((F.regexp_extract("user_id", "[0-9]+", 0).cast("int") % 5) == epoch)
        export_batch(part, "users", target, epoch=epoch)
    batch = users.limit(2).withColumn("user_id", F.concat(F.lit("new"), F.monotonically_increasing_id()))
    text = plan(target.stored_keys(batch, "user_id"))
    partitions = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    assert "bucket" in partitions
    assert target.stored_keys(batch, "user_id").count() < 100
    assert target.stored_keys(users, "user_id").count() == 200


def test_a_shared_session_meets_in_no_single_task(spark):
    """Half of the clicks without a session, a quarter in one, many users in each."""
    from cartstream.plans.journey import journey_count

    n = F.col("id")
    session = F.when(n % 4 == 0, "s0").when(n % 4 == 1, F.concat(F.lit("s"), n.cast("string")))
    clicks = spark.range(8000).select(
        n.cast("string").alias("user_id"), session.alias("session_id"), F.lit("/").alias("page")
    )
    users = clicks.select("user_id", F.lit("e").alias("email"))
    paid = spark.createDataFrame([("s0", 1.0), ("s0", 2.0), ("s5", 1.0)], "session_id string, a double")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        frame = journey_count(clicks, users, paid)
        assert frame.first()[0] == 8000 + 2000 + 0
        assert "_i" in plan(frame, "simple")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
