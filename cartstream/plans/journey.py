"""Click-to-purchase journeys: clicks LEFT JOIN users LEFT JOIN transactions.

Users join on `user_id`, transactions on `session_id` alone. A click stays when
nothing matches, and appears once per matching user and transaction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.operators.spread import ROW, hot_keys, spread_left_join, with_row
from cartstream.schemas import CLICKSTREAM, USERS


def _joined(clicks: DataFrame, users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Looks for hot keys first, then joins the clicks with both tables."""
    users_clicking, sessions, users_registered, sessions_paid = hot_keys(
        (clicks, "user_id"),
        (clicks, "session_id"),
        (users, "user_id"),
        (transactions, "session_id"),
    )
    with_users = spread_left_join(
        with_row(clicks), with_row(users), "user_id", users_clicking, users_registered
    )
    if users_registered:
        # Users are unique by contract. Where one is there many times, the clicks
        # multiply, and sessions that are common among them become hot by the join.
        multiplied = clicks.where(F.col("user_id").isin([*users_registered]))
        (more,) = hot_keys((multiplied, "session_id"))
        sessions = {key: max(sessions.get(key, 1), more.get(key, 1)) for key in sessions | more}
    return spread_left_join(
        with_users, with_row(transactions), "session_id", sessions, sessions_paid
    ).drop(ROW)


def journey(clicks: DataFrame, users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Who clicked what in which session, and what was paid."""
    return _joined(
        clicks.select("user_id", "session_id", "page"),
        users.select("user_id", "email"),
        transactions.select("session_id", "transaction_amount"),
    ).select("user_id", "session_id", "page", "transaction_amount", "email")


def journey_wide(clicks: DataFrame, users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Every column. Those that clicks and transactions share get a `txn_` name."""
    return _joined(
        clicks.select(*CLICKSTREAM.columns),
        users.select(*USERS.columns),
        transactions.select(
            "session_id",
            F.col("user_id").alias("txn_user_id"),
            "transaction_id",
            F.col("timestamp").alias("txn_timestamp"),
            "transaction_amount",
            "payment_method",
            "payment_status",
            "order_status",
            "products",
        ),
    )


def journey_count(clicks: DataFrame, users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Number of journey rows, without building one.

    Each table is first counted per key, which the map side does most of. The
    joins then see every key once on the right, and the left side is summed
    down to one row per user between them. A session shared by many users is
    still hot on the left of the first join, as are clicks without a session:
    both are dealt into chunks, by a hash of their row.
    """
    (sessions,) = hot_keys((clicks, "session_id"))
    row = F.xxhash64("user_id", "session_id")
    clicks = clicks.groupBy("user_id", "session_id").agg(F.count("*").alias("n"))
    paid = transactions.groupBy("session_id").agg(F.count("*").alias("n_paid"))
    users = users.groupBy("user_id").agg(F.count("*").alias("n_users"))

    with_paid = F.col("n") * F.coalesce("n_paid", F.lit(1))
    matched = spread_left_join(
        clicks.withColumn(ROW, row),
        paid.withColumn(ROW, F.lit(0).cast("bigint")),
        "session_id",
        sessions,
        {},
    )
    per_user = matched.groupBy("user_id").agg(F.sum(with_paid).alias("n"))
    with_users = F.col("n") * F.coalesce("n_users", F.lit(1))
    return per_user.join(users, "user_id", "left").agg(
        F.coalesce(F.sum(with_users), F.lit(0)).alias("total_records")
    )
