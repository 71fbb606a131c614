"""One rule for every order, however many lines it has."""

import pytest
from pyspark.sql import functions as F

import oracles
from cartstream.functions import order_total, products_json
from cartstream.operators.items import transaction_items
from cartstream.operators.parse import parsed_table
from cartstream.schemas import ITEMS, RELATIONAL_SCHEMAS, TRANSACTIONS
from cartstream.sources.warehouse import PRODUCTS, transaction_messages
from compare import assert_same, database
from conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables with a third of the lines in one order."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in ("orders", "part"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").coalesce(1).write.parquet(
            f"{folder}/{name}.parquet"
        )
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    third = F.col("l_linenumber") % 3 == 0
    lines = lines.withColumn("l_orderkey", F.when(third, 7).otherwise(F.col("l_orderkey")))
    lines.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.mark.parametrize("data", ["given", "skewed"])
def test_every_line_is_a_transaction(spark, request, data):
    folder = FOLDER if data == "given" else request.getfixturevalue("skewed")
    connection = database(FOLDER)
    for name in ("orders", "lineitem", "part"):
        path = f"{folder}/{name}.parquet" + ("" if data == "given" else "/*.parquet")
        connection.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    sql = oracles.oracle_sql()

    parsed = parsed_table(transaction_messages(spark, folder), TRANSACTIONS)
    assert parsed.agg(F.max(F.size("products"))).first()[0] == PRODUCTS
    assert not parsed.where("products IS NULL").isEmpty()
    assert parsed.where("transaction_id NOT RLIKE '^TXN[0-9]{12}-[0-9]+$'").isEmpty()
    lines = assert_same(
        parsed.withColumn("products", products_json(F.col("products"))),
        connection,
        sql["parse_transactions"],
    )
    assert lines == spark.read.parquet(f"{folder}/lineitem.parquet").join(
        spark.read.parquet(f"{folder}/orders.parquet"), F.col("l_orderkey") == F.col("o_orderkey")
    ).count()
    items = transaction_items(parsed).select(*RELATIONAL_SCHEMAS[ITEMS].names)
    assert_same(items, connection, sql["transaction_items"])
    assert_same(
        parsed.select("transaction_id", order_total(F.col("products")).alias("order_total")),
        connection,
        sql["order_total"],
    )
