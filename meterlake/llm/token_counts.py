"""Token counts through a digest cache.

A text's digest (sha256 of its content, null as the empty text) and the tokenizer's digest are the
key of a stored count. Counting joins the documents' digests to the cache, encodes every missing
digest once, appends those counts to the cache and joins the documents to it.

The content is not otherwise normalised: case, white space and Unicode form all change token ids.
Repeated texts are thinned out in each task before the shuffle; the last join holds ids and digests
only, and a digest with many rows is split by adaptive skew joins.

Cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted row by row; an empty
table gives an empty result and leaves the cache as it is; other input columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, shared_dir, text_batches
from .tokenizer_files import TokenizerFile, encoder, public_byte_bpe

CACHE_SCHEMA = "digest binary, n_tokens bigint, tokenizer string"


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of one tokenizer; none if the cache does not exist yet. A key that two
    writers have both appended counts once."""
    try:
        cache = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        cache = spark.createDataFrame([], CACHE_SCHEMA)
    return cache.filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, tokenizer: TokenizerFile, cache_path: str) -> None:
    """Append the counts of those digests of ``docs`` (columns ``digest, text``) that the cache lacks."""
    spark, version = docs.sparkSession, tokenizer.version()
    missing = (docs.dropDuplicates(["digest"])
               .join(read_cache(spark, cache_path, version), "digest", "left_anti"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in text_batches(batches):
            counts = [own.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64()), pa.array([version] * len(counts))],
                names=["digest", "n_tokens", "tokenizer"])

    missing.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").partitionBy("tokenizer").parquet(cache_path)


def token_counts(docs: DataFrame, tokenizer: TokenizerFile, cache_path: str, *, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for every row; the cache at ``cache_path`` (a shared folder)
    gains the counts it lacked."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    fill_cache(docs.select(digest.alias("digest"), text.alias("text")), tokenizer, cache_path)
    counts = read_cache(docs.sparkSession, cache_path, tokenizer.version())
    rows = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("digest"))
    return (rows.join(counts, "digest", "left")
            .select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh cache for each call, so that every distinct text is encoded once."""
    return token_counts(read_table(spark, sf_dir, "documents"), public_byte_bpe(), shared_dir(spark, "token-cache"))
