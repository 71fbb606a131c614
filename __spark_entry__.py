"""Queries for the driver, each from the message on.

Every query publishes the warehouse tables as topics, lands them, and works on
what has landed. Topics and landed tables are made once per session and folder.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from functools import cache
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StringType  # noqa: E402

import oracles  # noqa: E402

try:
    import corpus_pipeline
    from cartstream.llm import queries as corpus_queries
except ImportError:  # without the subpackage the other queries stay
    corpus_pipeline = corpus_queries = None
from cartstream.functions import order_total, products_json, row_json  # noqa: E402
from cartstream.operators.items import transaction_items  # noqa: E402
from cartstream.operators.keys import acceptable_rows, key_violations  # noqa: E402
from cartstream.operators.parse import (  # noqa: E402
    MESSAGE,
    STATUS,
    parse_messages,
    parsed_table,
)
from cartstream.plans.journey import journey, journey_count, journey_wide  # noqa: E402
from cartstream.plans.panels import PANELS  # noqa: E402
from cartstream.plans.shop import Shop, shop_for  # noqa: E402
from cartstream.plans.stored import lake_panel  # noqa: E402
from cartstream.schemas import (  # noqa: E402
    ITEMS,
    PRIMARY_KEYS,
    RELATIONAL_SCHEMAS,
    TABLE_SCHEMAS,
    TOPICS,
    TRANSACTIONS,
)
from cartstream.session import new_run_dir  # noqa: E402
from cartstream.sinks import compact, compact_closed, to_messages  # noqa: E402
from cartstream.sources import FolderTable, Lake, TextTopic, read_table  # noqa: E402
from cartstream.sources.warehouse import MESSAGES, REPEATED_MESSAGES  # noqa: E402
from cartstream.streaming import (  # noqa: E402
    AVAILABLE_NOW,
    read_live,
    start_export,
    start_keys,
    start_live,
)

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = {
    "new_users_today": dt.date.fromisoformat(oracles.NEW_USERS_DAY),
    "revenue_today": dt.date.fromisoformat(oracles.REVENUE_DAY),
}
# Panels of tables with a key, in the order of the others.
KEYED = [name for name, panel in PANELS.items() if panel.keyed]
LAKHS = ("total_revenue_today_lakhs", "revenue_in_lakhs")


def _comparable(frame: DataFrame) -> DataFrame:
    """Nested products as JSON, sums in lakhs to six decimals."""
    for name in frame.columns:
        if name in LAKHS:
            frame = frame.withColumn(name, F.round(name, 6))
        elif name == "products" and not isinstance(frame.schema[name].dataType, StringType):
            frame = frame.withColumn(name, products_json(F.col(name)))
    return frame


def _rows(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    return _comparable(read_table(spark, lake, table).select(*TABLE_SCHEMAS[table].names))


def _parse(topic: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        messages = shop_for(spark, folder).topic(topic).read(spark)
        return _comparable(parsed_table(messages, TOPICS[topic]))

    return query


def _items(spark: SparkSession, folder: str) -> DataFrame:
    items = transaction_items(shop_for(spark, folder).table("transactions"))
    return items.select(*RELATIONAL_SCHEMAS[ITEMS].names)


def _products_json(spark: SparkSession, folder: str) -> DataFrame:
    transactions = shop_for(spark, folder).table("transactions")
    return transactions.select(
        "transaction_id", products_json(F.col("products")).alias("products")
    )


def _order_total(spark: SparkSession, folder: str) -> DataFrame:
    transactions = shop_for(spark, folder).table("transactions")
    return transactions.select(
        "transaction_id", order_total(F.col("products")).alias("order_total")
    )


def _publish_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Landed transactions as messages of a new topic, read and parsed again."""
    landed = shop_for(spark, folder).table("transactions")
    topic = TextTopic(new_run_dir(spark, "published"))
    topic.publish(to_messages(landed, TRANSACTIONS))
    return _comparable(parsed_table(topic.read(spark), TRANSACTIONS))


def _journey(build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        shop = shop_for(spark, folder)
        tables = (shop.table(name) for name in ("clickstream", "users", "transactions"))
        return _comparable(build(*tables))

    return query


def _panel(name: str, shop_of: Callable = shop_for) -> Query:
    panel = PANELS[name]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        table = shop_of(spark, folder).table(panel.table)
        return _comparable(panel.run(table, AS_OF.get(name)))

    return query


@cache
def _exported(application: str, shop: Shop, table: str) -> FolderTable:
    """A landed table on the relational side, once per session."""
    shop.ensure(table)
    run = new_run_dir(shop.spark, "relational")
    target = FolderTable(table, f"{run}/{table}")
    start_export(
        shop.spark, shop.lake, table, target, AVAILABLE_NOW, query=f"relational_{run[-32:]}"
    ).awaitTermination()
    return target


def _relational_panel(name: str) -> Query:
    """The panel on the relational table that the streams keep in step."""
    panel = PANELS[name]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        shop = shop_for(spark, folder)
        table = _exported(spark.sparkContext.applicationId, shop, panel.table).read(spark)
        return _comparable(panel.run(table, AS_OF.get(name)))

    return query


def _live(name: str, shop_of: Callable = shop_for, files_per_batch: int = 1000) -> Query:
    """The panel as a stream over the landed table, when it has caught up."""
    panel = PANELS[name]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        shop = shop_of(spark, folder)
        shop.ensure(panel.table)
        start_live(spark, shop.lake, name, AVAILABLE_NOW, files_per_batch).awaitTermination()
        return _comparable(read_live(spark, shop.lake, name, AS_OF.get(name)))

    return query


# Messages that come first, by topic: about half, of all kinds.
FIRST = {
    "users": "value LIKE '%5@example.com%' OR value LIKE '%Early%'",
    "clickstream": """value LIKE '%"device":"iOS"%'""",
    "transactions": """value LIKE '%"payment_status":"failed"%'""",
}


@cache
def _half_stored(application: str, shop: Shop, topic: str) -> Shop:
    """A shop whose first messages are counted, or compacted up to 1997, and whose
    others have landed since; order lines with the transactions."""
    spark = shop.spark
    messages = shop.topic(topic).read(spark)
    half = TextTopic(new_run_dir(spark, "halves"))
    out = Shop(spark, shop.folder, topics={topic: half})
    first = F.expr(FIRST[topic])

    half.publish(messages.where(first))
    out.land(topic, out.lake)
    # Keys are followed, order lines compacted and more messages published side by
    # side; nothing lands before all have ended.
    following = [start_keys(spark, out.lake, topic, AVAILABLE_NOW, 3)] if topic in PRIMARY_KEYS else []
    try:
        if topic == "transactions":
            out.land(ITEMS, out.lake)
        for table in {"transactions": [ITEMS], "clickstream": ["clickstream"]}.get(topic, []):
            compact_closed(spark, out.lake, table, dt.date(1997, 1, 1), settled=dt.datetime.now())
        half.publish(messages.where(~first))
    finally:
        for query in following:
            query.awaitTermination()
    out.land(topic, out.lake)
    if topic == "transactions":
        out.land(ITEMS, out.lake)
    return out


def _stored_panel(name: str, shop_of: Callable = shop_for) -> Query:
    """The panel from stored totals and what has landed since."""
    table = PANELS[name].table
    topic = "transactions" if table == ITEMS else table

    def query(spark: SparkSession, folder: str) -> DataFrame:
        shop = _half_stored(spark.sparkContext.applicationId, shop_of(spark, folder), topic)
        return _comparable(lake_panel(spark, shop.lake, name, AS_OF.get(name)))

    return query


def _stream(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        shop = shop_for(spark, folder)
        lake = shop.new_lake("stream")
        if table == ITEMS:
            shop.land("transactions", lake)
        shop.land(table, lake)
        return _rows(spark, lake, table)

    return query


def _restart(spark: SparkSession, folder: str) -> DataFrame:
    """Streams stopped and started again: between two halves of the messages,
    and once more with nothing new."""
    messages = shop_for(spark, folder).topic("transactions").read(spark)
    failed = F.col("value").contains('"payment_status":"failed"')
    topic = TextTopic(new_run_dir(spark, "halves"))
    shop = Shop(spark, folder, topics={"transactions": topic})
    for half in (messages.where(failed), messages.where(~failed), None):
        if half is not None:
            topic.publish(half)
        shop.land("transactions", shop.lake)
        shop.land(ITEMS, shop.lake)
    return _rows(spark, shop.lake, ITEMS)


def _compact_closed(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the payments land, old periods are compacted, the other half comes
    late, and more periods are compacted; read from both places."""
    messages = shop_for(spark, folder).topic("transactions").read(spark)
    failed = F.col("value").contains('"payment_status":"failed"')
    topic = TextTopic(new_run_dir(spark, "halves"))
    shop = Shop(spark, folder, topics={"transactions": topic})
    for half, before in ((messages.where(failed), 1995), (messages.where(~failed), 1997)):
        topic.publish(half)
        shop.land("transactions", shop.lake)
        compact_closed(
            spark, shop.lake, "transactions", dt.date(before, 1, 1), settled=dt.datetime.now()
        )
    return _rows(spark, shop.lake, "transactions")


def _compact(spark: SparkSession, folder: str) -> DataFrame:
    shop = shop_for(spark, folder)
    shop.ensure("transactions")
    target = Lake(new_run_dir(spark, "compact"), "year")
    compact(spark, shop.lake, "transactions", target)
    return _rows(spark, target, "transactions")


def _export(table: str, shop_of: Callable = shop_for) -> Query:
    """Landed rows in a relational table. Where the table has a key the export
    runs twice, as two feeds cut into different batches: that adds nothing."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        shop = shop_of(spark, folder)
        shop.ensure(table)
        run = new_run_dir(spark, "export")
        target = FolderTable(table, f"{run}/{table}")
        for files in (1000, 8) if table in PRIMARY_KEYS else (1000,):
            name = f"export_{run[-32:]}_{files}"
            start_export(
                spark, shop.lake, table, target, AVAILABLE_NOW, files_per_batch=files, query=name
            ).awaitTermination()
        return target.read(spark)

    return query


class _Twice:
    """A target whose every batch comes a second time, as after a crash between
    writing it and noting that it is done."""

    replaces = True

    def __init__(self, target: FolderTable) -> None:
        self.target = target

    def append(self, rows: DataFrame, feed: str, epoch: int) -> None:
        self.target.append(rows, feed, epoch)
        self.target.append(rows, feed, epoch)


def _replay(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines, which have no key on the relational side, in several batches
    that all come twice."""
    shop = shop_for(spark, folder)
    shop.ensure(ITEMS)
    run = new_run_dir(spark, "replay")
    target = FolderTable(ITEMS, f"{run}/{ITEMS}")
    start_export(
        spark, shop.lake, ITEMS, _Twice(target), AVAILABLE_NOW, files_per_batch=4, query=f"replay_{run[-32:]}"
    ).awaitTermination()
    return target.read(spark)


@cache
def _repeated_shop(application: str, spark: SparkSession, folder: str) -> Shop:
    return Shop(spark, folder, messages={**MESSAGES, **REPEATED_MESSAGES})


def repeated_shop_for(spark: SparkSession, folder: str) -> Shop:
    """A shop whose users and payments are there several times."""
    return _repeated_shop(spark.sparkContext.applicationId, spark, folder.rstrip("/"))


def _registrations(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """One registration per order, without a user while the order is pending;
    the suppliers are users already."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet")
    user = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string"))
    batch = orders.select(user.alias("user_id"), F.col("o_orderpriority").alias("name"))
    return batch, suppliers.select(F.col("s_suppkey").cast("string").alias("user_id"))


def _pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    batch, stored = _registrations(spark, folder)
    return key_violations(batch, "user_id", stored)


def _pk_accepted(spark: SparkSession, folder: str) -> DataFrame:
    batch, stored = _registrations(spark, folder)
    return acceptable_rows(batch, "user_id", stored).select("user_id")


def _quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """One message per order, most of them damaged in one of several ways."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    number = F.concat(F.lit("TXN"), F.col("o_orderkey").cast("string"))
    whole = row_json(number.alias("transaction_id"), F.lit("UPI").alias("payment_method"))
    start = F.regexp_replace(whole, r"\}$", "")
    kind = F.col("o_orderkey") % 8
    value = (
        F.when(kind == 0, number)
        .when(kind == 1, "null")
        .when(kind == 2, F.concat(F.lit("["), whole, F.lit("]")))
        .when(kind == 3, start)
        .when(kind == 4, "")
        .when(kind == 5, F.concat(start, F.lit(',"transaction_amount":"n/a"}')))
        .when(kind == 6, "{}")
        .otherwise(whole)
    )
    topic = TextTopic(new_run_dir(spark, "damaged"))
    topic.publish(orders.select(value.alias("value")))
    return parse_messages(topic.read(spark), TRANSACTIONS).select(
        STATUS, "transaction_id", MESSAGE
    )


def entry(spark: SparkSession) -> DataFrame:
    """Revenue per category, from messages to the panel."""
    return _panel("revenue_by_category")(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return shop_queries() | _corpus_queries()


def _corpus_queries() -> dict[str, Query]:
    if corpus_queries is None:
        return {}
    return corpus_queries.queries() | {"pipeline": corpus_pipeline.run}


def shop_queries() -> dict[str, Query]:
    return {
        **{f"parse_{topic}": _parse(topic) for topic in TOPICS},
        "transaction_items": _items,
        "products_json": _products_json,
        "order_total": _order_total,
        "publish_roundtrip": _publish_roundtrip,
        "journey": _journey(journey),
        "journey_count": _journey(journey_count),
        "journey_wide": _journey(journey_wide),
        **{f"panel_{name}": _panel(name) for name in PANELS},
        **{f"live_{name}": _live(name) for name in PANELS},
        **{f"relational_{name}": _relational_panel(name) for name in PANELS},
        **{f"stored_{name}": _stored_panel(name) for name in PANELS},
        **{f"stream_{topic}": _stream(topic) for topic in TOPICS},
        "stream_items": _stream(ITEMS),
        "stream_restart": _restart,
        "compact_transactions": _compact,
        "compact_closed": _compact_closed,
        **{f"export_{topic}": _export(topic) for topic in TOPICS},
        "export_items": _export(ITEMS),
        "export_replay": _replay,
        **{f"keyed_panel_{name}": _panel(name, repeated_shop_for) for name in KEYED},
        **{f"keyed_live_{name}": _live(name, repeated_shop_for, 3) for name in KEYED},
        **{f"keyed_stored_{name}": _stored_panel(name, repeated_shop_for) for name in KEYED},
        **{f"keyed_export_{table}": _export(table, repeated_shop_for) for table in PRIMARY_KEYS},
        "pk_violations": _pk_violations,
        "pk_accepted": _pk_accepted,
        "quarantine": _quarantine,
    }


def oracle_sql() -> dict[str, str]:
    corpus = corpus_queries.oracle_sql() if corpus_queries else {}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        corpus["pipeline"] = corpus_pipeline.ORACLE_SQL
    return oracles.oracle_sql() | corpus
