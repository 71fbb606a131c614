"""Topic messages from an order warehouse.

Maps the tables customer, nation, region, events, orders, lineitem and part to
the JSON messages a storefront would send, so that every query can be run from
the message on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartstream.functions import event_time_text, full_location, row_json

# Fixed values.
DEVICES = ["Android", "iOS", "Chrome", "Safari"]
ACTIONS = ["click", "scroll", "hover", "navigate"]
PAYMENT_METHODS = ["UPI", "credit_card", "paypal", "debit_card"]
FIRST_REGISTRATION = "2024-01-01 10:00:00"

# Products of one message, at most.
PRODUCTS = 3


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(values: list[str], number: Column) -> Column:
    place = F.pmod(number, F.lit(len(values))).cast("int") + 1
    return F.element_at(F.array(*map(F.lit, values)), place)


def _session(user: Column, time: Column) -> Column:
    return F.concat(F.lit("SESS"), user, F.lit("_"), F.dayofmonth(time))


def _users(spark: SparkSession, folder: str) -> DataFrame:
    places = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = _table(spark, folder, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    number = F.col("c_custkey")
    registered = F.lit(FIRST_REGISTRATION).cast("timestamp_ntz") + F.make_dt_interval(
        (number % 30).cast("int")
    )
    return people.select(
        number.alias("number"),
        number.cast("string").alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
        .alias("email"),
        full_location(F.col("n_name"), F.when(number % 5 != 0, F.col("r_name"))).alias("location"),
        registered.alias("registered_at"),
    )


def _as_messages(rows: DataFrame, time: str) -> DataFrame:
    rows = rows.drop("number").withColumn(time, event_time_text(F.col(time)))
    return rows.select(row_json(*rows.columns).alias("value"))


def user_messages(spark: SparkSession, folder: str) -> DataFrame:
    """One message per customer; every fifth has a city only."""
    return _as_messages(_users(spark, folder), "registered_at")


def _sent_again(rows: DataFrame, time: str, column: str, late: str, early: str) -> DataFrame:
    """The rows; a third once more as they are; some a day later and some two
    days earlier, with another value of `column`."""

    number, days = F.col("number"), F.col("days")
    sent = F.array(
        F.lit(0),
        F.when(number % 3 == 0, F.lit(0)),
        F.when(number % 7 == 0, F.lit(1)),
        F.when(number % 7 == 1, F.lit(-2)),
    )
    # Each row is made once and copied at the end: nothing is joined again per copy.
    copies = rows.select("*", F.explode(F.array_compact(sent)).alias("days"))
    value = F.when(days > 0, late).when(days < 0, early).otherwise(F.col(column))
    moved = F.col(time).cast("timestamp_ntz") + F.make_dt_interval(days)
    return copies.withColumn(column, value).withColumn(time, moved).drop("days")


def repeated_user_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of users who are there several times."""
    rows = _sent_again(
        _users(spark, folder), "registered_at", "location", "Moved, Late", "Moved, Early"
    )
    return _as_messages(rows, "registered_at")


def click_messages(spark: SparkSession, folder: str) -> DataFrame:
    """One message per event."""
    number = F.col("event_id")
    return _table(spark, folder, "events").select(
        row_json(
            F.col("user_id").cast("string").alias("user_id"),
            _session(F.col("user_id"), F.col("ts")).alias("session_id"),
            event_time_text(F.col("ts")).alias("timestamp"),
            F.concat(F.lit("/"), "event_type").alias("page"),
            _pick(DEVICES, number).alias("device"),
            _pick(ACTIONS, F.floor(number / 4)).alias("action"),
        ).alias("value")
    )


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    # Parts come last: where they are few, their text meets the lines after the shuffle.
    lines, orders = _table(spark, folder, "lineitem"), _table(spark, folder, "orders")
    ordered = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    sold = ordered.join(_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    products = F.array(
        *(
            F.struct(
                F.concat(F.lit("PROD"), F.lpad(F.col("l_partkey").cast("string"), 5, "0"))
                .alias("product_id"),
                (F.col("l_quantity").cast("int") + more).alias("quantity"),
                F.col("p_retailprice").alias("unit_price"),
                F.col("p_type").alias("product_category"),
            )
            for more in range(PRODUCTS)
        )
    )
    listed = (F.col("l_linenumber") % (PRODUCTS + 1)).cast("int")
    number = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    return sold.select(
        F.col("o_orderkey").alias("number"),
        F.concat(F.lit("TXN"), number, F.lit("-"), F.col("l_linenumber").cast("string"))
        .alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        _session(F.col("o_custkey"), F.col("o_orderdate")).alias("session_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("l_extendedprice").alias("transaction_amount"),
        _pick(PAYMENT_METHODS, F.col("o_orderkey")).alias("payment_method"),
        F.when(F.col("o_orderstatus") == "F", "failed")
        .otherwise("successful")
        .alias("payment_status"),
        F.when(listed > 0, F.slice(products, F.lit(1), listed)).alias("products"),
    )


def transaction_messages(spark: SparkSession, folder: str) -> DataFrame:
    """One message per order line.

    The line's number says how many products it lists, none to PRODUCTS: the
    line's part, each time one more of it. Nothing is gathered by order, so an
    order may have any number of lines. Lines that repeat an order's line number
    repeat a transaction id.
    """
    return _as_messages(_transactions(spark, folder), "timestamp")


def repeated_transaction_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of payments that are there several times."""
    rows = _sent_again(
        _transactions(spark, folder), "timestamp", "payment_status", "failed", "failed"
    )
    return _as_messages(rows, "timestamp")


MESSAGES = {
    "users": user_messages,
    "clickstream": click_messages,
    "transactions": transaction_messages,
}

REPEATED_MESSAGES = {
    "users": repeated_user_messages,
    "transactions": repeated_transaction_messages,
}
