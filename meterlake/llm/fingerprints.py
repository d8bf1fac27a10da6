"""Document fingerprints by SpotSigs.

A signature is a chain of ``chain`` content words that follow a common word, its anchor; a fingerprint
is the set of a text's signatures, as 32-bit hashes in ascending order, base64 of their little-endian
bytes. Two fingerprints are compared by Jaccard similarity, after pruning by set length: sets whose
lengths alone bound the similarity below what is asked are not intersected, and the join meets only
neighbouring length partitions.

Words are runs of letters, digits and non-ASCII characters; ``A-Z`` are lower-cased. A text without a
complete chain takes every word as an anchor, with what follows of its chain; a text without words has
its whole text as one signature. Cases: null and empty texts have the empty fingerprint, and two empty
fingerprints are alike (1.0); an empty table gives an empty result; other input columns are not read.
"""
from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import read_table

# fixed values: common words of English, German, French and Spanish
ANCHORS = """the of and to in is that it was for on are with as be at by this from or an a
der die das und den von zu mit ist im für auf dem ein eine nicht als auch sich des
le la les de des et un une du est que dans pour par sur au avec ne pas ce
el los las y en que por con una del se para es al lo como más su""".split()
CHAIN = 2
_U = np.uint64


def _anchor_hashes(anchors: list[str]) -> np.ndarray:
    return np.unique(np.array([ta.word_hash(a.encode()) for a in anchors], dtype=np.uint64))


def _chains(hashes: np.ndarray, at: np.ndarray, spots: np.ndarray, chained: np.ndarray, chain: int,
            partial: bool) -> tuple[np.ndarray, np.ndarray]:
    """Signature hash and text of each spot: its word and the next ``chain`` words of ``chained``."""
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    after = np.searchsorted(chained, spots, side="right")
    value = hashes[spots]
    complete = np.ones(len(spots), dtype=bool)
    for k in range(chain):
        place = np.minimum(after + k, max(len(chained) - 1, 0))
        follows = (after + k < len(chained)) if len(chained) else np.zeros(len(spots), dtype=bool)
        if len(chained):
            follows &= text_of[chained[place]] == text_of[spots]
            value = np.where(follows, ta.mix(value * _U(31) + hashes[chained[place]]), value)
        complete &= follows
    keep = slice(None) if partial else complete
    return value[keep], text_of[spots][keep]


def signature_sets(texts: pa.Array, anchors: np.ndarray, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of all texts one after the other, ascending in each text, and where each text's begin."""
    texts = ta.utf8(texts)
    values, owners = [], []
    for first, last, hashes, at in ta.words(texts, blank=ta.PUNCTUATION):
        anchor = np.isin(hashes, anchors)
        value, text = _chains(hashes, at, np.flatnonzero(anchor), np.flatnonzero(~anchor), chain, False)
        bare = np.ones(last - first, dtype=bool)
        bare[text] = False
        every = np.flatnonzero(np.repeat(bare, np.diff(at)))
        more, more_text = _chains(hashes, at, every, np.arange(len(hashes)), chain, True)
        wordless = np.flatnonzero(bare & (np.diff(at) == 0))
        whole = [(int.from_bytes(hashlib.sha256(texts[first + int(i)].as_py().encode()).digest()[:8], "little"), i)
                 for i in wordless if len(texts[first + int(i)].as_py())]
        value = np.concatenate([value, more, np.array([w for w, _ in whole], dtype=np.uint64)])
        text = np.concatenate([text, more_text, np.array([i for _, i in whole], dtype=np.int64)])
        value, text = ta.distinct((value >> _U(32)).astype("<u4"), text)
        values.append(value)
        owners.append(text + first)
    value = np.concatenate(values) if values else np.zeros(0, "<u4")
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def encoded(value: np.ndarray, at: np.ndarray) -> list[str]:
    data = value.astype("<u4").tobytes()
    return [base64.b64encode(data[4 * a:4 * b]).decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def decoded(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u4")


def jaccard(one: np.ndarray, one_at: np.ndarray, other: np.ndarray, other_at: np.ndarray, floor: float = 0.0) -> np.ndarray:
    """Similarity of the i-th set on either side; 0 where the set lengths alone bound it below ``floor``."""
    n, m = np.diff(one_at), np.diff(other_at)
    bound = np.where(np.maximum(n, m) > 0, np.minimum(n, m) / np.maximum(np.maximum(n, m), 1), 1.0)
    alive = (bound >= floor) & (np.minimum(n, m) > 0)

    def keys(value, at, size):
        row = np.repeat(np.arange(len(size), dtype=np.uint64), size)
        return ((row << _U(32)) | value.astype(np.uint64))[np.repeat(alive, size)]

    a, b = keys(one, one_at, n), keys(other, other_at, m)
    both = np.intersect1d(a, b, assume_unique=True)
    shared = np.bincount((both >> _U(32)).astype(np.int64), minlength=len(n))
    return np.where((n == 0) & (m == 0), 1.0, shared / np.maximum(n + m - shared, 1))


def fingerprints(docs: DataFrame, *, anchors: list[str] = ANCHORS, chain: int = CHAIN, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, fingerprint, n_signatures`` for every row."""
    spots = _anchor_hashes(anchors)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, at = signature_sets(batch.column(1), spots, chain)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(encoded(value, at), pa.string()), pa.array(np.diff(at), pa.int64())],
                names=[id_col, "fingerprint", "n_signatures"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string, n_signatures bigint")


def similar_pairs(signed: DataFrame, threshold: float = 0.75, *, id_col: str = "doc_id") -> DataFrame:
    """Pairs ``one, other, jaccard`` of different fingerprints at ``threshold`` or more, of what
    :func:`fingerprints` returns; equal fingerprints stand for one another through their smallest id.

    Partitions are ranges of set lengths a factor 1/threshold apart, so a set meets its own partition and
    the next. Inside, two sets that are similar share one of their first signatures in hash order."""
    step = math.log(1 / threshold)
    sets = (signed.filter(F.col("n_signatures") > 0).groupBy("fingerprint")
            .agg(F.min(id_col).alias("id"), F.max("n_signatures").alias("n")))

    @F.pandas_udf("array<bigint>")
    def prefix(fingerprint):
        cut = (decoded(f) for f in fingerprint)
        return fingerprint.__class__([s[:len(s) - math.ceil(threshold * len(s) - 1e-9) + 1].astype(np.int64) for s in cut])

    @F.pandas_udf("double")
    def similarity(a, b):
        rows = [(decoded(x), decoded(y)) for x, y in zip(a, b)]
        shared = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in rows]
        return a.__class__([s / (len(x) + len(y) - s) for s, (x, y) in zip(shared, rows)], dtype="float64")

    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(step))
    heads = sets.select("id", "n", part.alias("part"), F.explode(prefix("fingerprint")).alias("head"))
    ahead = heads.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    found = (ahead.toDF("one", "n_one", "part", "head").join(heads.toDF("other", "n_other", "part", "head"), ["part", "head"])
             .filter((F.struct("n_one", "one") < F.struct("n_other", "other")) & (F.col("n_one") >= threshold * F.col("n_other") - 1e-9))
             .select("one", "other").distinct())
    return (found.join(sets.select(F.col("id").alias("one"), F.col("fingerprint").alias("f1")), "one")
            .join(sets.select(F.col("id").alias("other"), F.col("fingerprint").alias("f2")), "other")
            .select("one", "other", similarity("f1", "f2").alias("jaccard")).filter(F.col("jaccard") >= threshold - 1e-12))


def in_id_order(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bucket, ghost, id, text`` with the rows of a bucket together and in ascending id order, and behind them,
    as a ghost, the row that follows the bucket's last: the first of the next bucket, and of the first bucket
    for the last. Null ids come first; rows with one id follow each other by text.

    Buckets are quantile ranges of the ids, some for each shuffle partition; the driver sees one id for each."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.col(id_col).cast("double")
    cuts = docs.select(number.alias("n")).stat.approxQuantile("n", [i / buckets for i in range(1, buckets)], 1 / (8 * buckets))
    bucketizer = Bucketizer(splits=[-math.inf, *(sorted(set(cuts)) or [0.0]), math.inf], inputCol="_n", outputCol="_b", handleInvalid="keep")

    def dealt(df):
        df = bucketizer.transform(df.withColumn("_n", F.coalesce(number, F.lit(-math.inf))))
        return df.withColumn("bucket", F.when(F.col(id_col).isNull(), -1).otherwise(F.col("_b").cast("int"))).drop("_n", "_b")

    firsts = dealt(docs.select(id_col)).groupBy("bucket").agg(F.min(id_col).alias("first_id")).orderBy("bucket").collect()
    before = [(r.bucket, r.first_id, firsts[i - 1].bucket) for i, r in enumerate(firsts)]  # i - 1 = -1: the last
    listed = spark.createDataFrame(before, f"bucket int, first_id {docs.schema[id_col].dataType.simpleString()}, previous int")
    here = F.struct(F.col("bucket"), F.lit(0).alias("ghost"))
    there = F.struct(F.col("previous").alias("bucket"), F.lit(1).alias("ghost"))
    rows = dealt(docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    return (rows.join(F.broadcast(listed), "bucket")
            .withColumn("at", F.explode(F.when(F.col(id_col).eqNullSafe(F.col("first_id")), F.array(here, there)).otherwise(F.array(here))))
            .select("at.bucket", "at.ghost", id_col, "text")
            .repartition("bucket").sortWithinPartitions("bucket", "ghost", id_col, "text"))


def _with_next(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of consecutive documents of a bucket, with one text more than ids: the last one's successor."""
    ids, texts, bucket, closed, size = [], [], None, False, 0
    for batch in batches:
        for b, ghost, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            if b != bucket:
                ids, texts, bucket, closed, size = [], [], b, False, 0
            if closed:  # a further ghost
                continue
            texts.append(text)
            size += len(text)
            if ghost:
                yield ids, texts
                closed = True
                continue
            if size >= limit and ids:
                yield ids, texts
                ids, texts, size = [], [text], len(text)
            ids.append(doc_id)


def edit_report(docs: DataFrame, *, anchors: list[str] = ANCHORS, chain: int = CHAIN, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """For every document the fingerprint of its text and of its edited text, whose last quarter is replaced by the
    beginning of the next document, and the likeness of its fingerprint to the edited text's and the next document's."""
    spots = _anchor_hashes(anchors)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, n_signatures bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _with_next(batches, 1 << 20):
            own = texts[:-1]
            edited = [t[:len(t) - len(t) // 4] + following[:len(t) // 4] for t, following in zip(own, texts[1:])]
            value, at = signature_sets(pa.array(texts, pa.large_string()), spots, chain)
            e_value, e_at = signature_sets(pa.array(edited, pa.large_string()), spots, chain)
            first, rest = at[:-1], at[1:]
            near_edited = jaccard(value[:first[-1]], first, e_value, e_at)
            near_next = jaccard(value[:first[-1]], first, value[rest[0]:], rest - rest[0])
            columns = [pa.array(ids, pa.int64()) if kind == "bigint" else pa.array(ids), pa.array([len(t) for t in own], pa.int64()),
                       pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(encoded(value, at)[:-1], pa.string()),
                       pa.array(encoded(e_value, e_at), pa.string()), pa.array(near_edited), pa.array(near_next), pa.array(np.diff(first), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                                             "near_edited", "near_next", "n_signatures"])

    return in_id_order(docs, id_col=id_col, text_col=text_col).mapInArrow(run, schema)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(read_table(spark, sf_dir, "documents"))
