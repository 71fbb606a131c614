"""Column expressions shared by the operators. All run inside codegen."""

from cartstream.functions.columns import (
    event_time,
    event_time_text,
    full_location,
    in_lakhs,
    order_total,
    period_start,
    products_json,
    row_json,
    state_of,
)

__all__ = [
    "event_time",
    "event_time_text",
    "full_location",
    "in_lakhs",
    "order_total",
    "period_start",
    "products_json",
    "row_json",
    "state_of",
]
