"""Jobs for spark-submit.

    spark-submit --py-files … cartstream/jobs.py ingest --lake s3a://shop/lake \\
        --kafka broker:9092 --every "30 seconds" --jdbc-options jdbc.json --live
    spark-submit … cartstream/jobs.py journey --lake s3a://shop/lake
    spark-submit … cartstream/jobs.py panel top_pages --lake s3a://shop/lake

Storage endpoints and credentials are Spark settings (`--conf
spark.hadoop.fs.s3a.…`); those of a database are in the JSON file given.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from cartstream.functions.columns import PERIODS
from cartstream.plans.journey import journey, journey_count, journey_wide
from cartstream.plans.panels import PANELS
from cartstream.plans.stored import lake_panel
from cartstream.schemas import ITEMS, PRIMARY_KEYS, RELATIONAL_SCHEMAS, TABLE_SCHEMAS, TOPICS
from cartstream.sinks import compact, compact_closed
from cartstream.sources import JdbcTable, KafkaTopic, TextTopic, open_lake, read_table
from cartstream.streaming import (
    AVAILABLE_NOW,
    start_export,
    start_items,
    start_keys,
    start_landing,
    start_live,
    supervise,
)

PREVIEW_ROWS = 10


def _topic(args: argparse.Namespace, name: str) -> KafkaTopic | TextTopic:
    if args.kafka:
        return KafkaTopic(args.kafka, name, args.starting, dict(args.kafka_option))
    return TextTopic(f"{args.text}/{name}")


def _relational(args: argparse.Namespace) -> dict[str, JdbcTable]:
    if not args.jdbc_options:
        return {}
    with open(args.jdbc_options) as file:
        options = json.load(file)
    return {table: JdbcTable(table, options) for table in RELATIONAL_SCHEMAS}


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = open_lake(spark, args.lake, args.period)
    trigger = {"processingTime": args.every} if args.every else AVAILABLE_NOW
    landing = {
        f"land_{name}": partial(
            start_landing, spark, topic, _topic(args, name), lake, trigger, args.on_malformed
        )
        for name, topic in TOPICS.items()
    }
    unnesting = {f"land_{ITEMS}": partial(start_items, spark, lake, trigger)}
    following = {
        f"export_{table}": partial(
            start_export, spark, lake, table, target, trigger, args.on_violation
        )
        for table, target in _relational(args).items()
    }
    following |= {
        f"keys_{table}": partial(start_keys, spark, lake, table, trigger) for table in PRIMARY_KEYS
    }
    if args.live:  # those of keyed tables are there already
        following |= {
            f"live_{name}": partial(start_live, spark, lake, name, trigger)
            for name, panel in PANELS.items()
            if not panel.keyed
        }

    if args.every:
        supervise(
            {**landing, **unnesting, **following}, args.restarts, fail_fast=args.fail_fast
        )
    else:
        # One pass: each group reads what the one before has landed.
        for group in (landing, unnesting, following):
            supervise(group, args.restarts, poll_seconds=0.5)


def show_journey(spark: SparkSession, args: argparse.Namespace) -> None:
    """How many journeys there are, what one holds, and the first few."""
    lake = open_lake(spark, args.lake)
    tables = [read_table(spark, lake, name) for name in ("clickstream", "users", "transactions")]
    journey(*tables).show(PREVIEW_ROWS, truncate=False)
    empty = [spark.createDataFrame([], table.schema) for table in tables]
    print(journey_wide(*empty).schema.treeString())  # without a look at the rows
    print(f"{journey_count(*tables).first()['total_records']} journeys")


def show_panel(spark: SparkSession, args: argparse.Namespace) -> None:
    panel = PANELS[args.name]
    print(panel.title)
    if args.jdbc_options:
        rows = panel.run(_relational(args)[panel.table].read(spark), args.as_of)
    else:
        rows = lake_panel(spark, open_lake(spark, args.lake), args.name, args.as_of)
    rows.show(truncate=False)


def show_topic(spark: SparkSession, args: argparse.Namespace) -> None:
    messages: DataFrame = _topic(args, args.name).read(spark)
    messages = messages.select(messages["value"].cast("string"))
    if args.target:
        messages.write.text(args.target)
    else:
        messages.show(args.rows, truncate=False)


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    _topic(args, args.name).publish(spark.read.text(args.lines))


def compact_table(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = open_lake(spark, args.lake)
    if args.before:
        compact_closed(spark, lake, args.table, args.before)
        return
    target = open_lake(spark, args.target, args.target_period or lake.period)
    compact(spark, lake, args.table, target)


def _pair(text: str) -> tuple[str, str]:
    name, _, value = text.partition("=")
    return name, value


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="cartstream")
    jobs = root.add_subparsers(required=True)

    lake = argparse.ArgumentParser(add_help=False)
    lake.add_argument("--lake", required=True)

    topics = argparse.ArgumentParser(add_help=False)
    source = topics.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="SERVERS")
    source.add_argument("--text", metavar="FOLDER", help="one folder of text files per topic")
    topics.add_argument("--starting", default="latest")
    topics.add_argument("--kafka-option", type=_pair, action="append", default=[])

    job = jobs.add_parser("ingest", parents=[lake, topics], help="topics to lake and tables")
    job.add_argument("--period", choices=PERIODS, help="of a new lake; days if not given")
    job.add_argument("--every", metavar="INTERVAL", help="default: what there is now, then stop")
    job.add_argument("--on-malformed", choices=("quarantine", "keep"), default="quarantine")
    job.add_argument("--on-violation", choices=("skip", "fail"), default="skip")
    job.add_argument("--jdbc-options", metavar="FILE")
    job.add_argument("--live", action="store_true", help="keep the panels up to date")
    job.add_argument("--restarts", type=int, default=3, help="of a stream, in a row")
    job.add_argument("--fail-fast", action="store_true", help="one stream given up stops all")
    job.set_defaults(run=ingest)

    job = jobs.add_parser("journey", parents=[lake], help="count, schema and first rows")
    job.set_defaults(run=show_journey)

    job = jobs.add_parser("panel", help="one panel, from the lake or the database")
    job.add_argument("name", choices=PANELS)
    place = job.add_mutually_exclusive_group(required=True)
    place.add_argument("--lake")
    place.add_argument("--jdbc-options", metavar="FILE")
    job.add_argument("--as-of", type=dt.date.fromisoformat)
    job.set_defaults(run=show_panel)

    job = jobs.add_parser("read-topic", parents=[topics], help="messages from the beginning")
    job.add_argument("name", choices=TOPICS)
    place = job.add_mutually_exclusive_group(required=True)
    place.add_argument("--target", metavar="FOLDER", help="write the whole topic as text")
    place.add_argument("--rows", type=int, help="show that many")
    job.set_defaults(run=show_topic)

    job = jobs.add_parser("publish", parents=[topics], help="text lines to a topic")
    job.add_argument("name", choices=TOPICS)
    job.add_argument("lines", help="text files, one message per line")
    job.set_defaults(run=publish)

    job = jobs.add_parser("compact", parents=[lake], help="rewrite a table with larger files")
    job.add_argument("table", choices=TABLE_SCHEMAS)
    place = job.add_mutually_exclusive_group(required=True)
    place.add_argument("--target", help="root of another lake, for a copy")
    place.add_argument(
        "--before", type=dt.date.fromisoformat, help="rewrite older periods within the lake"
    )
    job.add_argument("--target-period", choices=PERIODS)
    job.set_defaults(run=compact_table)
    return root


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or SparkSession.builder.appName("cartstream").getOrCreate(), args)


if __name__ == "__main__":
    main(sys.argv[1:])
