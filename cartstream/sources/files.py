"""Small text files in whatever store Spark reads, written and listed by the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Appears whole or not at all; takes the place of a file of that name."""
    files, part = _place(spark, f"{path}.part")
    stream = files.create(part, True)
    stream.write(text.encode())
    stream.close()
    _, place = _place(spark, path)
    files.delete(place, False)
    files.rename(part, place)


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    files, place = _place(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


CODEC_SETTING = "spark.sql.parquet.compression.codec"


def codec(spark: SparkSession) -> str:
    """How stored rows are compressed: by zstd, unless the session has chosen."""
    return spark.conf.getAll.get(CODEC_SETTING, "zstd")
