"""A shop set up from a warehouse folder: topics published, tables landed.

Everything is done by Spark, once per session and folder, and only for the
tables asked for. Topics and tables live in the shared folder.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from cartstream.schemas import ITEMS, TOPICS
from cartstream.session import new_run_dir
from cartstream.sources.lake import Lake, read_table
from cartstream.sources.topics import TextTopic
from cartstream.sources.warehouse import MESSAGES
from cartstream.streaming.ingest import AVAILABLE_NOW, start_items, start_landing

# The warehouse's orders span years and are few per day.
PERIOD = "year"


class Shop:
    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        period: str = PERIOD,
        topics: Mapping[str, TextTopic] | None = None,
        messages: Mapping[str, Callable[[SparkSession, str], DataFrame]] = MESSAGES,
    ):
        """`topics` are those that someone else publishes, `messages` what the others
        are made of, each when it is asked for."""
        self.spark = spark
        self.folder = folder
        self.root = new_run_dir(spark, "shop")
        self.lake = Lake(self.root, period)
        self._topics: dict[str, TextTopic] = dict(topics or {})
        self._messages = messages
        self._landed: set[str] = set()
        self._lock = threading.RLock()

    def messages(self, name: str) -> DataFrame:
        return self._messages[name](self.spark, self.folder)

    def topic(self, name: str) -> TextTopic:
        with self._lock:
            if name not in self._topics:
                topic = TextTopic(f"{self.root}/topics/{name}")
                topic.publish(self.messages(name))
                self._topics[name] = topic
            return self._topics[name]

    def new_lake(self, label: str) -> Lake:
        """An empty lake for a run of its own."""
        return Lake(new_run_dir(self.spark, label), self.lake.period)

    def land(self, name: str, lake: Lake) -> None:
        """Run the streams that fill a table up to what its topic holds now."""
        if name == ITEMS:
            start_items(self.spark, lake, AVAILABLE_NOW).awaitTermination()
        else:
            start_landing(
                self.spark, TOPICS[name], self.topic(name), lake, AVAILABLE_NOW
            ).awaitTermination()

    def ensure(self, name: str) -> None:
        with self._lock:
            if name in self._landed:
                return
            if name == ITEMS:
                self.ensure("transactions")
            self.land(name, self.lake)
            self._landed.add(name)

    def table(self, name: str) -> DataFrame:
        self.ensure(name)
        return read_table(self.spark, self.lake, name)


_shops: dict[tuple[str, str], Shop] = {}
_shops_lock = threading.Lock()


def shop_for(spark: SparkSession, folder: str) -> Shop:
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    with _shops_lock:
        if key not in _shops:
            _shops[key] = Shop(spark, key[1])
        return _shops[key]
