"""Table rows back to topic messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.functions import event_time_text, row_json
from cartstream.schemas import Topic


def to_messages(table: DataFrame, topic: Topic) -> DataFrame:
    """One JSON message per row in `value`; fields that are NULL are left out."""
    columns = [
        event_time_text(F.col(name)).alias(name) if name == topic.time_column else F.col(name)
        for name in topic.columns
    ]
    return table.select(row_json(*columns).alias("value"))
