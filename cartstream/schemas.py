"""Topics, landed tables and relational contracts.

Column names, types, keys and time formats are fixed values: producers, landed
files and relational tables all depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING, DOUBLE, INT, DATE, TIME = (
    StringType(),
    DoubleType(),
    IntegerType(),
    DateType(),
    TimestampNTZType(),
)


def struct(columns: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


PRODUCT = struct(
    {"product_id": STRING, "quantity": INT, "unit_price": DOUBLE, "product_category": STRING}
)


@dataclass(frozen=True)
class Topic:
    """One JSON topic and the table it lands in."""

    name: str
    columns: dict[str, DataType]
    time_column: str
    key: str | None = None

    @property
    def message_schema(self) -> StructType:
        """What a message holds: times travel as text."""
        return struct({**self.columns, self.time_column: STRING})

    @property
    def table_schema(self) -> StructType:
        return struct(self.columns)


USERS = Topic(
    "users",
    {
        "user_id": STRING,
        "name": STRING,
        "email": STRING,
        "location": STRING,
        "registered_at": TIME,
    },
    time_column="registered_at",
    key="user_id",
)

CLICKSTREAM = Topic(
    "clickstream",
    {
        "user_id": STRING,
        "session_id": STRING,
        "timestamp": TIME,
        "page": STRING,
        "device": STRING,
        "action": STRING,
    },
    time_column="timestamp",
)

TRANSACTIONS = Topic(
    "transactions",
    {
        "user_id": STRING,
        "session_id": STRING,
        "transaction_id": STRING,
        "timestamp": TIME,
        "transaction_amount": DOUBLE,
        "payment_method": STRING,
        "payment_status": STRING,
        "order_status": STRING,
        "products": ArrayType(PRODUCT),
    },
    time_column="timestamp",
    key="transaction_id",
)

TOPICS = {topic.name: topic for topic in (USERS, CLICKSTREAM, TRANSACTIONS)}

ITEMS = "transaction_items"

# Landed order lines. (transaction_id, item_pos) identifies a line.
ITEM_COLUMNS = {
    "transaction_id": STRING,
    "item_pos": INT,
    "product_id": STRING,
    "product_category": STRING,
    "quantity": INT,
    "unit_price": DOUBLE,
    "product_spend": DOUBLE,
    "timestamp": TIME,
}

TABLE_SCHEMAS = {
    **{name: topic.table_schema for name, topic in TOPICS.items()},
    ITEMS: struct(ITEM_COLUMNS),
}

# Relational side: products become JSON text, item_pos has no column, and
# transactions carry a product_category that no message fills.
RELATIONAL_SCHEMAS = {
    "users": USERS.table_schema,
    "clickstream": CLICKSTREAM.table_schema,
    "transactions": struct(
        {
            "user_id": STRING,
            "session_id": STRING,
            "transaction_id": STRING,
            "timestamp": TIME,
            "transaction_amount": DOUBLE,
            "payment_method": STRING,
            "payment_status": STRING,
            "order_status": STRING,
            "product_category": STRING,
            "products": STRING,
        }
    ),
    ITEMS: struct({name: kind for name, kind in ITEM_COLUMNS.items() if name != "item_pos"}),
}

PRIMARY_KEYS = {"users": "user_id", "transactions": "transaction_id"}
