"""Token counts by way of a cache of content digests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.llm.tables import keep_rows, text_of, written
from cartstream.llm.text import slices
from cartstream.llm.tokens import tokenizer, tokenizer_version

ENTRY = "content string, tokenizer string, n_tokens long"


def cached_counts(docs: DataFrame, cache: str) -> DataFrame:
    """The cache's entries, none if the folder does not exist yet."""
    spark = docs.sparkSession
    try:
        return spark.read.schema(ENTRY).parquet(cache)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY)


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        for batch in batches:
            for part in slices(batch, "text"):
                _, bounds = model.encode(part.column("text"))
                yield pa.record_batch(
                    [part.column("content"), pa.array(np.diff(bounds), pa.int64())],
                    ["content", "n_tokens"],
                )

    return count


def token_counts(docs: DataFrame, path: str, cache: str, limit: int = 1024) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit.

    `cache` is a Parquet folder of (content digest, tokenizer digest, count).
    Contents are looked up in it by digest; of those it lacks, each distinct one
    is encoded once and appended. Content is the text as it is, null being
    empty: any further normalisation could change its tokens. The tokenizer's
    digest is that of its file, so counts of another file are never taken.

    Runs at once up to the append. An append that fails half-way leaves no
    entries, and entries written twice by two runs at a time do no harm.
    Repeated rows are counted like others; an empty table gives no rows; other
    columns are not read. Copies of one text never meet in a task: rows are told
    apart by doc_id, and where few are hits or copies, no text is shuffled.
    """
    version = tokenizer_version(path)
    text = text_of(docs)
    digest = F.sha2(text.cast("binary"), 256)
    keys = written(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            digest.alias("content"),
        ),
        "content-digests",
    )
    stored = cached_counts(docs, cache).where(F.col("tokenizer") == version)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "copies")).alias("first")
    texts_of_id = keys.groupBy("content", "doc_id").agg(F.count("*").alias("copies"))
    misses = written(
        texts_of_id.groupBy("content")
        .agg(first)
        .join(stored, "content", "left_anti")
        .select("first.doc_id", "content", "first.copies"),
        "token-misses",
    )
    same = [texts_of_id[c].eqNullSafe(misses[c]) for c in ("content", "doc_id")]
    others = texts_of_id.select("content", "doc_id").join(misses, same, "left_anti")
    texts = docs.select(docs["doc_id"].alias("doc_id"), text.alias("text"))
    key = {"doc_id": F.col("doc_id"), "content": F.sha2(F.col("text").cast("binary"), 256)}
    (
        keep_rows(texts, key, misses, others)
        .select(F.sha2(F.col("text").cast("binary"), 256).alias("content"), "text")
        .mapInArrow(_counter(path), "content string, n_tokens long")
        .select("content", F.lit(version).alias("tokenizer"), "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )
    # Written, so that the join reads plain rows on both sides: then Spark splits
    # a content that many rows share.
    counts = written(
        cached_counts(docs, cache)
        .where(F.col("tokenizer") == version)
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens")),
        "token-counts",
    )
    return keys.join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
