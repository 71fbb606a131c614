"""Documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartstream.llm.decontaminate import decontaminate
from cartstream.llm.exact_dedup import exact_dedup
from cartstream.llm.minhash import near_dedup
from cartstream.llm.packing import pack_documents
from cartstream.llm.quality_ranking import accepted, learn
from cartstream.llm.queries import TOKENIZER, fold
from cartstream.llm.ship import ship_package
from cartstream.llm.tables import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking accepts, learnt from the labels outside fold 0.

    Null and empty texts are scored like others, very long ones whole; repeated
    rows and ties of score share one verdict; an empty table stays empty; other
    columns, whatever their names, are carried along. So it is in every stage.
    """
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return accepted(docs, learn(docs, labels, fold(F.col("doc_id"), 5) != 0))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal without white space, the longest; of equally long ones
    the smallest doc_id, of rows alike in both any one. Null is empty."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles:
    the smallest doc_id. Texts without words all stay."""
    ship_package(spark)
    return near_dedup(docs, words=5, percent=80)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten consecutive words of a benchmark item. Texts
    without words stay; an empty benchmark drops nothing."""
    ship_package(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens. Null and empty texts are one end token;
    repeated rows are packed each; an empty table gives no pieces."""
    ship_package(spark)
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", clean_of_benchmarks),
    ("best-fit packing", packed),
]

# Learnt scores, signatures and token ids are beyond SQL; the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from `documents` on, each reading what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
