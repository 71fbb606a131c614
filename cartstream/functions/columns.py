from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EVENT_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
LAKH = 100000.0
PERIODS = ("day", "month", "year")


def event_time(text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` text as a zone-less time; anything else is NULL.

    The pattern is tested first because a plain cast also takes shorter and
    ISO forms. No zone is involved, so a time inside a daylight-saving gap of
    the session zone is kept as written.
    """
    return F.when(text.rlike(EVENT_TIME_PATTERN), text.try_cast("timestamp_ntz"))


def event_time_text(time: Column) -> Column:
    """A zone-less time as message text, whole seconds.

    A cast, not `date_format`: the latter goes through the session zone.
    """
    return F.substring(time.cast("string"), 1, 19)


def period_start(time: Column, period: str) -> Column:
    """First day of the day, month or year that holds `time`."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {period!r}")
    day = time.cast("date")
    return day if period == "day" else F.trunc(day, period)


def order_total(products: Column) -> Column:
    """Sum of quantity x unit_price over a nested product list, in cents' precision.

    Folds the array in place: no explode, no shuffle. NULL list gives NULL.
    """
    spend = F.aggregate(
        products,
        F.lit(0.0),
        lambda total, product: total + product["quantity"] * product["unit_price"],
    )
    return F.round(spend, 2)


def products_json(products: Column) -> Column:
    return F.to_json(products)


def row_json(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns))


def in_lakhs(amount: Column) -> Column:
    return amount / F.lit(LAKH)


def full_location(city: Column, state: Column) -> Column:
    """`City, State`, or just `City` when there is no state."""
    return F.concat_ws(", ", city, state)


def state_of(location: Column) -> Column:
    """What follows the first comma of `City, State`, up to the next comma."""
    return F.trim(F.split_part(location, F.lit(","), F.lit(2)))
