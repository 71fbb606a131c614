"""The seven dashboard panels.

A panel is three steps: `counted` keeps one row per key, `totals` aggregates,
`present` turns the totals into the rows shown. A batch run does all at once; a
live panel keeps the totals as streaming state, or the kept rows where there is
a key, and presents them after each micro-batch.

Sorting follows the dashboard's database: NULL comes first in descending order.
Ties are broken by the group's name, so a top five is reproducible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartstream.functions import in_lakhs, period_start, state_of
from cartstream.functions.columns import PERIODS
from cartstream.operators.keys import kept_rows
from cartstream.schemas import ITEMS, PRIMARY_KEYS

TOP = 5
SUCCESSFUL = "successful"


def day_of(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def up_to_day(frame: DataFrame, time_column: str, as_of: dt.date | None) -> Column:
    """Time up to the end of the day: an earlier row of a key takes the place of
    one of that day, a later one does not. Also names the period column of a
    landed table, if there is one, so that the scan opens no later folder."""
    day = day_of(as_of)
    condition = F.col(time_column) < F.date_add(day, 1).cast("timestamp_ntz")
    for period in PERIODS:
        if f"event_{period}" in frame.columns:
            condition &= F.col(f"event_{period}") <= period_start(day, period)
    return condition


def _ordered(totals: DataFrame, value: str, name: str) -> DataFrame:
    return totals.orderBy(F.desc_nulls_first(value), F.asc_nulls_last(name))


def _total_users(users: DataFrame) -> DataFrame:
    return users.agg(F.count("*").alias("total_users"))


def _users_per_day(users: DataFrame) -> DataFrame:
    return users.groupBy(F.col("registered_at").cast("date").alias("day")).agg(
        F.count("*").alias("n")
    )


def _new_users(totals: DataFrame, as_of: dt.date | None) -> DataFrame:
    today = totals.where(F.col("day") == day_of(as_of))
    return today.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("new_users_today"))


def _users_per_state(users: DataFrame) -> DataFrame:
    located = users.where(F.col("location").contains(","))
    return located.groupBy(state_of(F.col("location")).alias("state")).agg(
        F.count("*").alias("users_count")
    )


def _visits_per_page(clickstream: DataFrame) -> DataFrame:
    return clickstream.groupBy("page").agg(F.count("*").alias("visits"))


def _paid_per_day(transactions: DataFrame) -> DataFrame:
    paid = transactions.where(F.col("payment_status") == SUCCESSFUL)
    return paid.groupBy(F.col("timestamp").cast("date").alias("day")).agg(
        F.sum("transaction_amount").alias("amount")
    )


def _revenue_today(totals: DataFrame, as_of: dt.date | None) -> DataFrame:
    today = totals.where(F.col("day") == day_of(as_of))
    amount = F.coalesce(F.sum("amount"), F.lit(0.0))
    return today.agg(in_lakhs(amount).alias("total_revenue_today_lakhs"))


def _sold_per_category(items: DataFrame) -> DataFrame:
    return items.groupBy("product_category").agg(F.sum("quantity").alias("total_sold"))


def _spend_per_category(items: DataFrame) -> DataFrame:
    return items.groupBy("product_category").agg(
        in_lakhs(F.sum("product_spend")).alias("revenue_in_lakhs")
    )


# Totals of rows that are added (`sign` 1) or taken back (-1).


def _signed_users(users: DataFrame) -> DataFrame:
    return users.agg(F.coalesce(F.sum("sign"), F.lit(0).cast("bigint")).alias("total_users"))


def _signed_per_day(users: DataFrame) -> DataFrame:
    return users.groupBy(F.col("registered_at").cast("date").alias("day")).agg(F.sum("sign").alias("n"))


def _signed_per_state(users: DataFrame) -> DataFrame:
    located = users.where(F.col("location").contains(","))
    return located.groupBy(state_of(F.col("location")).alias("state")).agg(
        F.sum("sign").alias("users_count")
    )


def _signed_paid(transactions: DataFrame) -> DataFrame:
    paid = transactions.where(F.col("payment_status") == SUCCESSFUL)
    return paid.groupBy(F.col("timestamp").cast("date").alias("day")).agg(
        F.sum(F.col("sign") * F.col("transaction_amount")).alias("amount"), F.sum("sign").alias("n")
    )


@dataclass(frozen=True)
class Panel:
    title: str
    table: str
    totals: Callable[[DataFrame], DataFrame]
    present: Callable[[DataFrame, dt.date | None], DataFrame]
    day_column: str | None = None
    # Totals' columns that add up, the number of rows last where rows may go again.
    sums: tuple[str, ...] = ()
    signed: Callable[[DataFrame], DataFrame] | None = None
    # What is read of each key's row, where the table has a key.
    columns: tuple[str, ...] = ()
    # Shown in descending order of the first column, then by the second.
    order: tuple[str, str] | None = None

    @property
    def keyed(self) -> bool:
        return self.table in PRIMARY_KEYS

    def counted(self, frame: DataFrame) -> DataFrame:
        """The rows that count: one per key, where the table has a key."""
        return kept_rows(frame, self.table, self.columns) if self.keyed else frame

    def run(self, frame: DataFrame, as_of: dt.date | None = None) -> DataFrame:
        """The panel's rows. `as_of` is the day that "today" stands for."""
        if self.day_column:
            frame = frame.where(up_to_day(frame, self.day_column, as_of))
        return self.present(self.totals(self.counted(frame)), as_of)

    def merged(self, totals: DataFrame) -> DataFrame:
        """Totals of several parts as one; groups that have no row left are gone."""
        groups = [name for name in totals.columns if name not in self.sums]
        whole = totals.groupBy(*groups).agg(*(F.sum(name).alias(name) for name in self.sums))
        return whole.where(F.col(self.sums[-1]) != 0) if groups and self.signed else whole

    def sorted(self, rows: DataFrame) -> DataFrame:
        """Rows that were shown once, in order again."""
        return _ordered(rows, *self.order) if self.order else rows


# Names, titles and output columns are fixed values.
PANELS = {
    "total_users": Panel(
        "Total users",
        "users",
        _total_users,
        lambda totals, _: totals,
        sums=("total_users",),
        signed=_signed_users,
    ),
    "new_users_today": Panel(
        "New users today",
        "users",
        _users_per_day,
        _new_users,
        "registered_at",
        columns=("registered_at",),
        sums=("n",),
        signed=_signed_per_day,
    ),
    "top_locations": Panel(
        "Top locations by user count",
        "users",
        _users_per_state,
        lambda totals, _: _ordered(totals, "users_count", "state").limit(TOP),
        columns=("location",),
        order=("users_count", "state"),
        sums=("users_count",),
        signed=_signed_per_state,
    ),
    "top_pages": Panel(
        "Most visited pages",
        "clickstream",
        _visits_per_page,
        lambda totals, _: _ordered(totals, "visits", "page").limit(TOP),
        order=("visits", "page"),
        sums=("visits",),
    ),
    # Successful payments only; revenue per category counts all of them, since
    # order lines carry no payment status.
    "revenue_today": Panel(
        "Total revenue today (in lakhs)",
        "transactions",
        _paid_per_day,
        _revenue_today,
        "timestamp",
        columns=("timestamp", "transaction_amount", "payment_status"),
        sums=("amount", "n"),
        signed=_signed_paid,
    ),
    "top_categories": Panel(
        "Most selling categories",
        ITEMS,
        _sold_per_category,
        lambda totals, _: _ordered(totals, "total_sold", "product_category").limit(TOP),
        order=("total_sold", "product_category"),
        sums=("total_sold",),
    ),
    "revenue_by_category": Panel(
        "Revenue (in lakhs) per category all-time",
        ITEMS,
        _spend_per_category,
        lambda totals, _: _ordered(totals, "revenue_in_lakhs", "product_category"),
        order=("revenue_in_lakhs", "product_category"),
        sums=("revenue_in_lakhs",),
    ),
}
