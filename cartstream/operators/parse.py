"""Message envelope to typed rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.functions import event_time
from cartstream.schemas import STRING, Topic

OK = "ok"
MALFORMED = "malformed"
STATUS = "status"
MESSAGE = "message"
_CORRUPT = "_corrupt"

ON_MALFORMED = ("quarantine", "keep")


def parse_messages(
    messages: DataFrame, topic: Topic, on_malformed: str = "quarantine"
) -> DataFrame:
    """Parse a `value` column into the topic's columns plus `status` and `message`.

    Works on batch and streaming frames, in one pass and without a shuffle.

    * A message that yields nothing (not JSON, `null`, a top-level array, empty)
      becomes one `malformed` row.
    * A message with a field of the wrong type keeps its good fields in an `ok`
      row and is copied to a `malformed` row.
    * `on_malformed="keep"` makes every message one `ok` row, all NULL if need be.

    `message` holds the original text, on malformed rows only.
    """
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}, not {on_malformed!r}")

    schema = topic.message_schema.add(_CORRUPT, STRING)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = messages.select(F.col("value").cast("string").alias("_text")).select(
        "_text", F.from_json("_text", schema, options).alias("_data")
    )

    if on_malformed == "keep":
        statuses = F.array(F.lit(OK))
    else:
        corrupt = F.col(f"_data.{_CORRUPT}").isNotNull()
        nothing = reduce(
            lambda left, right: left & right,
            [F.col(f"_data.{name}").isNull() for name in topic.columns],
        )
        statuses = (
            F.when(F.col("_data").isNull() | (corrupt & nothing), F.array(F.lit(MALFORMED)))
            .when(corrupt, F.array(F.lit(OK), F.lit(MALFORMED)))
            .otherwise(F.array(F.lit(OK)))
        )

    rows = parsed.select("_text", "_data", F.explode(statuses).alias(STATUS)).select(
        STATUS, "_data.*", F.when(F.col(STATUS) == MALFORMED, F.col("_text")).alias(MESSAGE)
    )
    return rows.withColumn(topic.time_column, event_time(F.col(topic.time_column))).select(
        STATUS, *topic.columns, MESSAGE
    )


def parsed_table(messages: DataFrame, topic: Topic, on_malformed: str = "quarantine") -> DataFrame:
    """The good rows of a topic, as its table."""
    rows = parse_messages(messages, topic, on_malformed)
    return rows.where(F.col(STATUS) == OK).select(*topic.columns)
