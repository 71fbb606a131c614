"""Topics as frames with one `value` column, bounded or streaming."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Messages of one file of a text topic, at most. Files are compressed, so one is read
# by one task.
FILE_MESSAGES = 1 << 18


@dataclass(frozen=True)
class KafkaTopic:
    """A Kafka topic. `options` go to the source as they are.

    Useful at volume: `minPartitions` to read a partition with several tasks,
    `maxOffsetsPerTrigger` to bound a micro-batch.
    """

    servers: str
    name: str
    starting: str = "latest"
    options: Mapping[str, str] = field(default_factory=dict)

    def _load(self, reader, starting: str) -> DataFrame:
        return (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("subscribe", self.name)
            .option("startingOffsets", starting)
            .options(**self.options)
            .load()
            .select("value")
        )

    def read(self, spark: SparkSession) -> DataFrame:
        """Everything the topic holds now."""
        return self._load(spark.read, "earliest")

    def stream(self, spark: SparkSession) -> DataFrame:
        return self._load(spark.readStream, self.starting)

    def publish(self, messages: DataFrame) -> None:
        (
            messages.select(messages["value"].cast("binary"))
            .write.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("topic", self.name)
            .save()
        )


@dataclass(frozen=True)
class TextTopic:
    """A folder of text files, one message per line: a topic without a broker.

    Files may be compressed. What is published is, as messages repeat their field
    names: by gzip, in files of at most FILE_MESSAGES.
    """

    path: str
    files_per_batch: int | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.text(self.path)

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        return reader.text(self.path)

    def publish(self, messages: DataFrame) -> None:
        (
            messages.select(messages["value"].cast("string"))
            .write.mode("append")
            .option("maxRecordsPerFile", FILE_MESSAGES)
            .text(self.path, compression="gzip")
        )
