"""Order lines and relational shapes of the landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.functions import products_json
from cartstream.schemas import ITEM_COLUMNS, RELATIONAL_SCHEMAS


def transaction_items(transactions: DataFrame) -> DataFrame:
    """One row per product of a transaction; none for an absent or empty list.

    `item_pos` is the product's place in the message, so a line has a key.
    """
    lines = transactions.select(
        "transaction_id", "timestamp", F.posexplode("products").alias("item_pos", "product")
    )
    spend = F.col("product.quantity") * F.col("product.unit_price")
    return lines.select(
        "*", "product.*", spend.alias("product_spend")
    ).select(*ITEM_COLUMNS)


def relational_shape(frame: DataFrame, table: str) -> DataFrame:
    """The frame as the relational table declares it.

    Columns are matched by name: those the frame lacks become NULL, lake-only
    ones are left behind, and nested products turn into JSON text.
    """
    if "products" in frame.columns:
        frame = frame.withColumn("products", products_json(F.col("products")))
    present = set(frame.columns)
    return frame.select(
        *(
            (F.col(field.name) if field.name in present else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in RELATIONAL_SCHEMAS[table]
        )
    )
