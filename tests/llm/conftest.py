import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from cartstream.llm.ship import ship_package
from conftest import TESTDATA

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # Names that operators use for their own columns.
        StructField("score", StringType()),
        StructField("kept", BooleanType()),
        StructField("digest", StringType()),
        StructField("carried", StringType()),
        StructField("copies", LongType()),
    ]
)


def awkward_rows():
    """Nulls, empty and very long texts, ties, repeated rows and ids."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["Über", "ß", "ÉTÉ", "a_b", "<|endoftext|>", " x"]
    plain = " ".join(rng.choices(words, k=80))
    long_text = " ".join(rng.choices(words, k=9000))
    texts = [
        None, "", " ", "\t\n\x0b\x0c\r ", "one", "one two three", "one  two three ",
        plain, plain, plain + " ", plain.replace(" ", "  "), plain.upper(), plain + " tail",
        long_text, long_text, "x" * 30_000, "a b c\u0085d e　f", "\x00\x01 \x7f z",
        "mixed  \n spaces \n\n here", "it's we'll  I'm 'quoted' 1234 5.6",
        "<|endoftext|>", "before <|endoftext|> after", "🙂 🙂🙂 é ​",
    ]
    rows = [(i, text) for i, text in enumerate(texts)]
    rows += [(7, plain), (7, plain), (None, plain), (None, None), (None, "one"), (4, "other text")]
    rows += [(1000 + i, plain) for i in range(60)]  # a hot group
    rows += [(2000 + i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def llm_spark(spark):
    ship_package(spark)
    return spark


def docs_frame(spark, rows):
    filler = ("en", None, None, "s", True, "d", "c", 5)
    return spark.createDataFrame([(*row, *filler) for row in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def awkward(llm_spark):
    return docs_frame(llm_spark, awkward_rows())


@pytest.fixture(scope="session")
def empty(llm_spark):
    return llm_spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(llm_spark):
    """The driver's smallest table, dealt out."""
    docs = llm_spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    return docs.repartition(4, F.col("doc_id"))


def texts_of(frame):
    return [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]
