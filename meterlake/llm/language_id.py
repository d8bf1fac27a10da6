"""Language identification by compression.

Each language is a zstandard raw-content dictionary: training texts of that language, one after the
other. Texts are lower-cased and reduced to their letters, with one blank for all between. A text is cut into parts of a few kilobytes, each part is encoded with every dictionary, and the
language whose encodings are smallest in all is chosen: text that resembles a dictionary compresses
better with it. The margin is the share by which the second smallest is larger; a choice with a
narrower margin than ``reject_margin`` is marked rejected.

Training texts are a bounded sample: for each language the ``sample_docs`` different texts with the
smallest hashes, as many as ``dictionary_bytes`` hold, texts of over an eighth of that after all others;
which texts these are does not depend on partitions. Candidates are thinned by a threshold on the hash before they
are ranked, so no language is gathered in one task. Of the ranked texts only those that a dictionary has room for
reach the driver, and of each no more than the dictionary's size. Every language value is learned: the model that is broadcast
holds ``MODEL_BYTES`` in all, so beyond 128 languages each has a smaller dictionary, of ``LEAST_BYTES`` at least.

Cases: a null text or one without a letter is ``und`` with score 0; with no training language at all
every text is ``und``; equal sizes go to the language with more training rows, then by name; repeated
rows are judged row by row; an empty table gives an empty result; only id, text and language are read.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import crc_mod, read_table, text_batches

DICTIONARY_BYTES = 256 << 10
SAMPLE_DOCS = 400
PART_BYTES = 4096
LEVEL = 3
REJECT_MARGIN = 0.02
UNKNOWN = "und"
MODEL_BYTES = 32 << 20
LEAST_BYTES = 256


def letters(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def train(texts: DataFrame, *, lang_col: str = "lang", text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          dictionary_bytes: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """Languages with their dictionaries, those with most rows first."""
    values = texts.select(F.col(lang_col).alias("lang")).filter("lang IS NOT NULL").distinct().count()
    dictionary_bytes = min(dictionary_bytes, max(MODEL_BYTES // max(values, 1), LEAST_BYTES))
    rows = (texts.select(F.col(lang_col).alias("lang"), letters(F.col(text_col)).alias("text"))
            .filter(F.col("lang").isNotNull() & (F.col("text") != "")).withColumn("place", F.xxhash64("text")))
    counts = (rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("place").alias("different")))
    # the hash is uniform: about four times the texts wanted pass the threshold, or all of a small language
    share = F.least(F.lit(1.0), F.lit(4.0 * sample_docs + 100) / F.col("different"))
    long = F.octet_length("text") > dictionary_bytes // 8
    ranked = (rows.join(F.broadcast(counts), "lang")  # a few bytes for each language value
              .filter(F.pmod("place", F.lit(1 << 30)) < share * F.lit(1 << 30))
              .dropDuplicates(["lang", "place"])
              .select("lang", "n", "place", (F.octet_length("text") + 1).alias("room"), long.alias("long"),
                      F.left("text", F.lit(dictionary_bytes)).alias("text")))
    in_order = W.partitionBy("lang").orderBy("long", "place")
    ranked = ranked.select("*", F.row_number().over(in_order).alias("nth"),
                           (F.sum(F.col("room").cast("long")).over(in_order.rowsBetween(W.unboundedPreceding, 0)) - F.col("room")).alias("before"))
    sample = ranked.filter((F.col("nth") <= sample_docs) & (F.col("before") < dictionary_bytes)).orderBy(F.desc("n"), "lang", "nth")
    found: dict[str, bytes] = {}
    for row in sample.select("lang", "text").toLocalIterator():
        found[row.lang] = (found.get(row.lang, b"") + row.text.encode() + b" ")[:dictionary_bytes]
    return list(found.items())


@functools.lru_cache(maxsize=2)
def _compressors(languages: tuple[tuple[str, bytes], ...]) -> list:
    import zstandard
    out = []
    for _, data in languages:
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_checksum=False,
                                            write_dict_id=False))
    return out


def sizes(text: bytes, languages: tuple[tuple[str, bytes], ...], part_bytes: int = PART_BYTES) -> list[int]:
    """Encoded size of the text with each dictionary."""
    parts = [text[i:i + part_bytes] for i in range(0, len(text), part_bytes)]
    return [sum(len(c.compress(p)) for p in parts) for c in _compressors(languages)]


def predict(docs: DataFrame, languages: list[tuple[str, bytes]], *, reject_margin: float = REJECT_MARGIN,
            id_col: str = "doc_id", text_col: str = "text", keep: list[Column] = ()) -> DataFrame:
    """``id, *keep, lang_pred, score, rejected``; the score is the smallest encoding's weight among all,
    each weighted by 2 to the bits it saves, spread over the text's length."""
    model = docs.sparkSession.sparkContext.broadcast(tuple(languages))
    rows = docs.select(F.col(id_col), *keep, letters(F.col(text_col)).alias("text"))
    kept = rows.schema[:-1]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept),
                        "lang_pred string, score double, rejected boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [name for name, _ in model.value]
        for batch in text_batches(batches):
            found, scores, rejected = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                if not text or not names:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                n = np.array(sizes(text.encode(), model.value), dtype=np.float64)
                best = int(n.argmin())
                others = np.delete(n, best)
                margin = (others.min() - n[best]) / others.min() if len(others) else 1.0
                found.append(names[best])
                scores.append(float(1 / np.exp2(-100 * (n - n[best]) / n[best]).sum()))
                rejected.append(bool(margin < reject_margin))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*(f.name for f in kept), "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    remainder = crc_mod(F.col("doc_id"), 4)
    languages = train(docs.filter(remainder != 2))
    return predict(docs, languages, keep=[(F.coalesce(remainder, F.lit(0)) == 2).alias("held_out")])
