"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct 5-word shingles; two documents link at a Jaccard similarity of
``THRESHOLD`` or more. All shingles have one order, the rarest first, and a set of n whose partners share
at least r = ceil(0.75 n) of them is indexed by its first n - r + l: two sets that link share at least as
many of their first shingles as the smaller of their two l. Each document chooses its own l: the estimated
cost of looking up a longer prefix is set against that of verifying the candidates, whose number is at
most the prefix's total frequency / l, since each must be met l times.

1. One scan gives each document's set size and the digest of its set; documents with equal sets are one
   class from then on. It also gathers the frequent shingles; the ``HOT`` most frequent are broadcast as
   the tail of the order, the others precede them in hash order. The order steers cost, not results.
2. A second scan indexes the prefix of each class. Shingles with a single class go at once.
3. In each shingle's bucket every class is paired with one centre, the class with most copies, and those
   pairs are verified, which joins most of a large group of near copies without pairing its members.
4. Then the pairs of a bucket whose classes are still in different components and fit in size. Buckets of up
   to ``LARGE`` such classes are joined, and pairs must fit in position and meet in as many buckets as asked.
   Larger buckets are taken together by their centre, and what is outside of the centre's component is
   compared with everything else in blocks of about ``SIDE`` by ``SIDE`` classes, by signatures inside a task:
   no pairs of a group are written out but those that can be similar.
5. Of these pairs each class first verifies its ``FIRST`` most alike ones; when those have been linked, all
   pairs whose classes are still in different components are verified. No such pair is left out, so these
   components are those of all links.
6. Every link lies inside a component. In components of three classes and more the whole sets of all pairs are
   compared, in cells of two blocks of at most ``CELL`` classes; cells give the number of links of each class, or
   the pairs themselves where they are asked for.

A signature has a bit for the parity of the shingles in each of about n ranges of hashes: where two differ,
the sets differ, so pairs whose signatures differ in more places than sets of the asked similarity can are
dropped. Verification then intersects the whole sets, which a scan computes for the documents that are left
only. Sets and shingles are known by 64-bit hashes: of a set its bytes' BLAKE2, of words and shingles those of
``textarrays``.

Cases: a document with fewer than five words has its whole sequence as one shingle; one without words, or
a null text, has n_shingles 0, no links and itself as component; repeated rows and ties are one class; an
empty table gives an empty result; other input columns are not read by the join.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import textarrays as ta
from .common import read_table, stored, text_batches
from .components import connected_components

SHINGLE = 5
NUMERATOR, DENOMINATOR = 3, 4  # the similarity asked for, 0.75
THRESHOLD = NUMERATOR / DENOMINATOR
HOT = 100_000
LOCAL_COUNT = 3
COPIED = 50_000
MAX_MATCHES = 8
LARGE = 64
SIDE = 256
CELL = 1024
CELL_SHINGLES = 1 << 20
COLUMNS = 2048
FIRST = 3
FILTER_BITS = 24


def least_shared(n):
    """ceil(0.75 n), in whole numbers."""
    return -(-NUMERATOR * n // DENOMINATOR)


def digest_of(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def signature_of(values: np.ndarray) -> bytes:
    """Parities of the number of shingles in equal ranges of hashes, at least as many ranges as shingles."""
    bits = max(6, (len(values) - 1).bit_length())
    ranges = np.bincount((values >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.packbits(ranges & 1).tobytes()


def signature_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles that only one of two sets has."""
    x, y = (np.unpackbits(np.frombuffer(v, np.uint8)) for v in (a, b))
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(len(y), -1), axis=1)
    return int((x ^ y).sum())


def _sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for first, last, value, at in ta.shingle_sets(texts, SHINGLE):
        for i in range(last - first):
            yield first + i, value[at[i]:at[i + 1]]


class _Counter:
    """Frequencies within a task: shingles are sorted out in blocks and only those that a block repeats stay."""

    def __init__(self, block: int = 1 << 20):
        self.block, self.parts, self.size = block, [], 0

    def add(self, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.parts.append(values)
        self.size += len(values)
        if self.size >= self.block:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.parts:
            values, counts = np.unique(np.concatenate(self.parts), return_counts=True)
            self.parts, self.size = [], 0
            often = counts >= LOCAL_COUNT
            if often.any():
                yield values[often].view(np.int64), counts[often]


def described(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``id, n_shingles, class, signature`` of every document, and ``shingle, n`` of shingles that tasks met
    repeatedly. Copies within a task count once for the frequencies, and have one signature among them."""
    kind = docs.schema[id_col].dataType.simpleString()
    fields = [id_col, "n_shingles", "class", "signature", "shingle", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = _Counter(), set()

        def frequent(found):
            for values, counts in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(values), id_type), pa.nulls(len(values), pa.int64()), pa.nulls(len(values), pa.int64()),
                     pa.nulls(len(values), pa.binary()), pa.array(values), pa.array(counts, pa.int64())], names=fields)

        id_type = pa.null()
        for batch in text_batches(batches):
            id_type, sizes, classes, signatures = batch.column(0).type, [], [], []
            for _, values in _sets(ta.utf8(batch.column(1))):
                sizes.append(len(values))
                classes.append(digest_of(values) if len(values) else None)
                signatures.append(None)
                if len(values) and classes[-1] not in seen:
                    seen.add(classes[-1])
                    signatures[-1] = signature_of(values)
                    yield from frequent(counter.add(values))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(signatures, pa.binary()),
                 pa.nulls(len(sizes), pa.int64()), pa.nulls(len(sizes), pa.int64())], names=fields)
        yield from frequent(counter.flush())

    schema = f"`{id_col}` {kind}, n_shingles bigint, class bigint, signature binary, shingle bigint, n bigint"
    both = stored(docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, schema), "shingle-sets")
    return (both.filter(F.col("n_shingles").isNotNull()).select(id_col, "n_shingles", "class", "signature"),
            both.filter(F.col("n").isNotNull()).select("shingle", "n"))


@dataclass(frozen=True)
class Order:
    """The frequent shingles by hash with their frequencies, and classes with many copies; both bounded."""

    hot: np.ndarray
    count: np.ndarray
    copied: dict[int, int]

    def counts(self, values: np.ndarray) -> np.ndarray:
        """Estimated frequency of each shingle; 1 if it is not known to be frequent."""
        if not len(self.hot):
            return np.ones(len(values), dtype=np.int64)
        place = np.minimum(np.searchsorted(self.hot, values), len(self.hot) - 1)
        return np.where(self.hot[place] == values, self.count[place], 1)

    def prefix(self, values: np.ndarray) -> tuple[np.ndarray, int]:
        """The indexed shingles of a set in order, and its number of matches asked for."""
        counts = self.counts(values)
        order = np.lexsort((values, counts))
        n, most = len(values), min(MAX_MATCHES, int(least_shared(len(values))))
        met = np.cumsum(counts[order] - 1)  # classes met by a prefix, at most
        matches = np.arange(1, most + 1)
        ends = n - least_shared(n) + matches
        cost = ends + met[ends - 1] + met[ends - 1] / matches * (1 + n / 64)
        best = int(cost.argmin())
        return values[order[:ends[best]]], int(matches[best])


def shingle_order(documents: DataFrame, frequent: DataFrame) -> Order:
    hot = (frequent.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(HOT).toPandas())
    values = hot["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    copied = (documents.groupBy("class").count().filter("class IS NOT NULL AND count > 1")
              .orderBy(F.desc("count"), "class").limit(COPIED).collect())
    return Order(values[order], hot["n"].to_numpy(np.int64)[order], {r[0]: r[1] for r in copied})


def prefix_index(docs: DataFrame, order: Order, id_col: str, text_col: str) -> DataFrame:
    """``shingle, class, n, place, matches, copies, members, centre`` of all shingles that two classes or
    more are indexed by; ``place`` counts from 0 in the class's order."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        known = shared.value
        for batch in text_batches(batches):
            columns: list[list[np.ndarray]] = [[] for _ in range(6)]
            for _, values in _sets(ta.utf8(batch.column(0))):
                if not len(values):
                    continue
                own = digest_of(values)
                if own in seen:
                    continue
                seen.add(own)
                head, matches = known.prefix(values)
                row = (head.view(np.int64), own, len(values), np.arange(len(head)), matches, known.copied.get(own, 1))
                for column, x in zip(columns, row):
                    column.append(np.full(len(head), x) if np.isscalar(x) else x)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(columns, types)], names=names)

    names = ["shingle", "class", "n", "place", "matches", "copies"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
    entries = docs.select(F.col(text_col).alias("text")).mapInArrow(
        run, "shingle bigint, class bigint, n int, place int, matches int, copies int")
    entries = (entries.repartition("shingle").groupBy("shingle", "class")
               .agg(*(F.max(c).alias(c) for c in names[2:])))  # a class comes from every task that has a copy
    bucket = W.partitionBy("shingle")
    centre = F.max(F.struct("copies", "class", "n", "matches")).over(bucket)
    return (entries.withColumn("members", F.count("*").over(bucket)).withColumn("centre", centre)
            .filter("members > 1"))


def _near_in_size(a: str, b: str):
    return F.expr(f"{DENOMINATOR} * least({a}, {b}) >= {NUMERATOR} * greatest({a}, {b})")


def centre_pairs(index: DataFrame) -> DataFrame:
    """``a, b``: classes and the centres of their buckets, where they meet often enough."""
    return (index.filter("class <> centre.class").filter(_near_in_size("n", "centre.n"))
            .groupBy(F.col("class").alias("a"), F.col("centre.class").alias("b"))
            .agg(F.count("*").alias("met"), F.first(F.least("matches", "centre.matches")).alias("asked"))
            .filter("met >= asked").select("a", "b"))


def open_buckets(index: DataFrame, components: DataFrame) -> DataFrame:
    """The index entries of buckets that still hold classes of different components, with ``component`` and the
    bucket's size ``open``."""
    named = components.select(F.col("node").alias("class"), "component")
    rows = index.join(named, "class", "left").withColumn("component", F.coalesce("component", "class"))
    bucket = W.partitionBy("shingle")
    rows = (rows.withColumn("low", F.min("component").over(bucket)).withColumn("high", F.max("component").over(bucket))
            .filter("low <> high"))
    return rows.select("shingle", "class", "n", "place", "matches", "component", F.col("centre.class").alias("centre"),
                       F.col("members").alias("open"))


def small_bucket_pairs(rows: DataFrame) -> DataFrame:
    """``a, b``: pairs of different components that share as many indexed shingles as asked in small buckets, and that can
    still reach the similarity, given their sizes and where in their orders they meet.

    A pair that also meets in a large bucket is found there, whatever it meets here."""
    a, b = (rows.filter(F.col("open") <= LARGE).select("shingle", *(F.col(c).alias(c + side) for c in ("class", "n", "place", "matches", "component")))
            for side in ("_a", "_b"))
    # at most what precedes in both orders, and the rest of the shorter tail, can be shared
    reach = F.least("place_a", "place_b") + F.least(F.expr("n_a - place_a"), F.expr("n_b - place_b"))
    met = (a.join(b, "shingle")
           .filter(F.expr("class_a < class_b AND component_a <> component_b") & _near_in_size("n_a", "n_b")
                   & (reach * (NUMERATOR + DENOMINATOR) >= F.expr(f"{NUMERATOR} * (n_a + n_b)")))
           .groupBy(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
           .agg(F.count("*").alias("met"), F.first(F.least("matches_a", "matches_b")).alias("asked")))
    return met.filter("met >= asked").select("a", "b")


def large_bucket_pairs(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """``a, b``: pairs of different components in the large buckets of one centre that fit in size and whose signatures
    allow the similarity."""
    groups = (rows.filter(F.col("open") > LARGE).groupBy("centre", "class")
              .agg(F.max("n").alias("n"), F.max("component").alias("component")))
    homes = rows.filter("class = centre").select("centre", F.col("component").alias("home")).distinct()
    groups = groups.join(homes, "centre", "left").withColumn("outside", ~F.col("component").eqNullSafe(F.col("home"))).drop("home")
    counts = groups.groupBy("centre").agg(*(F.ceil(F.count_if(side) / SIDE).cast("int").alias(name) for name, side in
                                            (("blocks_out", F.col("outside")), ("blocks_in", ~F.col("outside")))))
    known = documents.filter("signature IS NOT NULL").select("class", "signature").dropDuplicates(["class"])
    rows = groups.join(counts, "centre").join(known, "class").withColumn(
        "block", F.pmod(F.xxhash64("class", F.lit(7)), F.when(F.col("outside"), F.col("blocks_out")).otherwise(F.col("blocks_in"))).cast("int"))
    # an outside class meets all blocks: those inside, and those outside once for each pair of blocks
    many = F.greatest(F.col("blocks_out"), F.lit(1))
    inner = F.when(F.col("blocks_in") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("blocks_in"), F.lit(1)) - 1),
                                                       lambda j: F.struct(F.col("block").alias("i"), (-j - 1).alias("j"))))
    outer = F.transform(F.sequence(F.lit(0), many - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    inside = F.when(F.col("blocks_out") > 0, F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.struct(i.alias("i"), (-F.col("block") - 1).alias("j"))))
    none = F.array().cast("array<struct<i:int,j:int>>")
    cells = F.when(F.col("outside"), F.concat(outer, F.coalesce(inner, none))).otherwise(F.coalesce(inside, none))
    return (rows.withColumn("cell", F.explode(cells)).select("centre", "cell.i", "cell.j", "class", "n", "component", "outside", "block", "signature")
            .groupBy("centre", "i", "j").applyInArrow(_block_pairs, "a bigint, b bigint"))


def _block_pairs(cell: pa.Table) -> pa.Table:
    """The pairs of one cell that fit in size, in signature, and are of different components: of a block outside with
    itself, with another block outside, or (j below 0) with a block inside."""
    i, j = cell.column("i")[0].as_py(), cell.column("j")[0].as_py()
    own = cell.column("class").to_numpy()
    n, component, outside, block = (cell.column(c).to_numpy() for c in ("n", "component", "outside", "block"))
    bits = [np.frombuffer(s, np.uint8) for s in cell.column("signature").to_pylist()]
    sizes = np.array([len(b) for b in bits])
    stacks = {}  # of all signatures of a size, folded to a smaller one where asked

    def folded(size: int, to: int) -> np.ndarray:
        if (size, to) not in stacks:
            whole = np.stack([np.unpackbits(bits[r]) for r in np.flatnonzero(sizes == size)])
            stacks[size, to] = np.packbits(np.bitwise_xor.reduce(whole.reshape(len(whole), 8 * to, -1), axis=2), axis=1)
        return stacks[size, to]

    place = np.zeros(len(own), dtype=np.int64)
    for size in np.unique(sizes):
        place[sizes == size] = np.arange((sizes == size).sum())
    a, b = [], []
    for r in np.flatnonzero(outside & (block == i)):
        other_side = ~outside if j < 0 else outside & (block == j)
        for size in np.unique(sizes):
            others = np.flatnonzero(sizes == size)
            to = min(size, sizes[r])
            difference = np.bitwise_count(folded(size, to) ^ folded(sizes[r], to)[place[r]]).sum(axis=1)
            fit = ((component[others] != component[r]) & (DENOMINATOR * np.minimum(n[others], n[r]) >= NUMERATOR * np.maximum(n[others], n[r]))
                   & ((NUMERATOR + DENOMINATOR) * difference <= (DENOMINATOR - NUMERATOR) * (n[others] + n[r])))
            hits = others[fit & other_side[others]]
            a.extend(np.minimum(own[hits], own[r]).tolist())
            b.extend(np.maximum(own[hits], own[r]).tolist())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def without(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.distinct().join(done, ["a", "b"], "left_anti")


def first_tries(pairs: DataFrame) -> DataFrame:
    """Of ``a, b, difference``, the most alike ones of either class."""
    both = pairs.select("a", "b", "difference", F.explode(F.array("a", "b")).alias("class"))
    rank = F.row_number().over(W.partitionBy("class").orderBy("difference", "a", "b"))
    return both.withColumn("rank", rank).filter(F.col("rank") <= FIRST).select("a", "b").distinct()


def still_apart(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """The pairs whose classes are in different components."""
    of = components.select("node", "component")
    a, b = (of.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}")) for side in "ab")
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"))


def _bitmap(ids: DataFrame) -> bytes:
    """A filter of a fixed size (2 MB) that passes all rows of ``ids`` (column ``place``, a hash), and few others while
    they are few."""
    words = (ids.select(F.pmod("place", F.lit(1 << FILTER_BITS)).alias("bit"))
             .groupBy(F.shiftright("bit", 5).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits")).toPandas())
    out = np.zeros(1 << (FILTER_BITS - 5), dtype="<u4")
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype("<u4")
    return out.tobytes()


def class_sets(docs: DataFrame, documents: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``class, shingles`` (sorted 64-bit integers) of the given classes, from the text of one document of each."""
    chosen = (documents.join(classes, "class", "left_semi").groupBy("class")
              .agg(F.min(id_col).alias("id")).select(F.xxhash64("id").alias("place")))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype="<u4")
        seen: set[int] = set()
        for batch in batches:
            place = batch.column(0).to_numpy().astype(np.int64) & ((1 << FILTER_BITS) - 1)
            passed = batch.filter(pa.array((bits[place >> 5] >> (place & 31).astype("<u4")) & 1 == 1))
            for part in text_batches(iter([passed])):
                found = [(digest_of(v), v.tobytes()) for _, v in _sets(ta.utf8(part.column(1))) if len(v)]
                found = [f for f in dict(found).items() if f[0] not in seen]
                seen.update(f[0] for f in found)
                if found:
                    own, sets = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(sets, pa.binary())], names=["class", "shingles"])

    sets = (docs.select(F.xxhash64(id_col).alias("place"), F.col(text_col).alias("text"))
            .mapInArrow(run, "class bigint, shingles binary"))
    return sets.join(classes, "class", "left_semi").dropDuplicates(["class"])


def alike(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a, b, difference`` of the pairs whose signatures allow the similarity."""
    known = (documents.filter("signature IS NOT NULL").select("class", "n_shingles", "signature").dropDuplicates(["class"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x, y = (c.to_pylist() for c in batch.columns[2:])
            difference = [signature_difference(*xy) for xy in zip(x, y)]
            keep = [(NUMERATOR + DENOMINATOR) * d <= (DENOMINATOR - NUMERATOR) * m for d, m in zip(difference, n)]
            out = pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(difference, pa.int64())], names=["a", "b", "difference"])
            yield out.filter(pa.array(keep, pa.bool_()))

    a, b = (known.select(F.col("class").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("signature").alias(f"sign_{side}"))
            for side in "ab")
    return (pairs.join(a, "a").join(b, "b").select("a", "b", F.expr("n_a + n_b"), "sign_a", "sign_b")
            .mapInArrow(run, "a bigint, b bigint, difference bigint"))


def linked(docs: DataFrame, documents: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The pairs ``a, b`` whose whole sets reach the similarity, and ``class, shingles, n``: the sets that were compared."""
    classes = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = class_sets(docs, documents, classes, id_col, text_col).withColumn("n", F.expr("octet_length(shingles) div 8"))
    sets = stored(sets, "class-sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(DENOMINATOR * shared >= NUMERATOR * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    a, b = (sets.select(F.col("class").alias(side), F.col("shingles").alias(f"set_{side}")) for side in "ab")
    return (pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")
            .mapInArrow(run, "a bigint, b bigint")), sets


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets share, above the diagonal: frequent values by a matrix product, the others
    pair by pair."""
    rows = len(sets)
    out = np.zeros((rows, rows), dtype=np.int64)
    owner = np.repeat(np.arange(rows), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    frequent = count > max(8, rows // 16)
    often = np.flatnonzero(frequent)
    place = np.full(len(count), -1)
    for first in range(0, len(often), COLUMNS):
        part = often[first:first + COLUMNS]
        place[part] = np.arange(len(part))
        hit = np.flatnonzero(place[column] >= 0)
        has = np.zeros((rows, len(part)), dtype=np.float32)
        has[owner[hit], place[column[hit]]] = 1
        out += (has @ has.T).astype(np.int64)  # a product's whole numbers stay below 2 ** 24
        place[part] = -1
    rest = np.flatnonzero((count > 1)[column] & ~frequent[column])
    rest = rest[np.argsort(column[rest], kind="stable")]
    column, owner = column[rest], owner[rest]
    for ahead in range(1, len(column)):
        same = column[ahead:] == column[:-ahead]
        if not same.any():
            break
        np.add.at(out, (owner[:-ahead][same], owner[ahead:][same]), 1)
    return np.triu(out, 1)


def _cell_pairs(cell: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classes of a cell, and the places of those two that link: of a block with itself, or of two blocks."""
    i, j = cell.column("i")[0].as_py(), cell.column("j")[0].as_py()
    sets = {c: (b, s) for c, b, s in zip(*(cell.column(x).to_pylist() for x in ("class", "block", "shingles")))}
    block = np.array([b for b, _ in sets.values()])
    values = [np.frombuffer(s, np.uint64) for _, s in sets.values()]
    n = np.array([len(v) for v in values])
    shared = shared_counts(values)
    links = (shared > 0) & (DENOMINATOR * shared >= NUMERATOR * (n[:, None] + n - shared))
    if i != j:
        links &= block[:, None] != block
    return np.array(list(sets), dtype=np.int64), *np.nonzero(links)


def _cell_links(cell: pa.Table) -> pa.Table:
    own, a, b = _cell_pairs(cell)
    return pa.table({"class": own, "links": np.bincount(np.concatenate([a, b]), minlength=len(own)).astype(np.int64)})


def _cell_list(cell: pa.Table) -> pa.Table:
    own, a, b = _cell_pairs(cell)
    return pa.table({"a": np.minimum(own[a], own[b]), "b": np.maximum(own[a], own[b])})


def cells(components: DataFrame, sets: DataFrame):
    """The sets of all classes in components of three and more, grouped so that each two of a component meet in one
    cell. A class may have several rows in ``sets``."""
    sizes = (components.join(sets.select("class", "n").distinct(), F.col("node") == F.col("class")).groupBy("component")
             .agg(F.count("*").alias("classes"), F.sum("n").alias("shingles")).filter("classes > 2")
             .select("component", F.greatest(F.ceil(F.col("classes") / CELL), F.ceil(F.col("shingles") / CELL_SHINGLES)).cast("int").alias("blocks")))
    members = (components.join(sizes, "component").select(F.col("node").alias("class"), "component", "blocks")
               .withColumn("block", F.pmod(F.xxhash64("class", F.lit(7)), "blocks").cast("int")))
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                      lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    return (sets.join(members, "class").withColumn("cell", F.explode(met))
            .select("component", "cell.i", "cell.j", "class", "block", "shingles").groupBy("component", "i", "j"))


def _joined(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The described documents, ``node, component`` of all classes with links, links that join each component, and the
    sets of these classes."""
    documents, frequent = described(docs, id_col, text_col)
    order = shingle_order(documents, frequent)
    index = stored(prefix_index(docs, order, id_col, text_col), "prefix-index")
    tried = stored(centre_pairs(index), "centre-pairs")
    links_of = lambda pairs: linked(docs, documents, pairs, id_col, text_col)
    found, sets = links_of(stored(alike(documents, tried).select("a", "b"), "alike-pairs"))
    edges = stored(found, "links")
    rows = stored(open_buckets(index, connected_components(edges)), "open-buckets")
    pairs = without(small_bucket_pairs(rows).unionByName(large_bucket_pairs(rows, documents)), tried)
    pairs = stored(alike(documents, pairs), "alike-pairs")
    first = stored(first_tries(pairs), "first-tries")
    found, more = links_of(first)
    edges, sets = stored(edges.unionByName(found), "links"), sets.unionByName(more)
    rest = stored(still_apart(without(pairs.select("a", "b"), first), connected_components(edges)), "last-pairs")
    found, more = links_of(rest)
    edges, sets = stored(edges.unionByName(found), "links"), sets.unionByName(more)
    return documents, connected_components(edges), edges, sets


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, links`` for every row: the smallest id of its component, and how many other
    classes its class links to."""
    documents, components, edges, sets = _joined(docs, id_col, text_col)
    in_cells = (cells(components, sets).applyInArrow(_cell_links, "class bigint, links bigint")
                .groupBy("class").agg(F.sum("links").alias("many")))
    links = (edges.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
             .join(in_cells, "class", "left").select("class", F.coalesce("many", "links").alias("links")))
    return _named(documents, components.join(links, F.col("node") == F.col("class")).drop("class"), id_col)


def _named(documents: DataFrame, components: DataFrame, id_col: str) -> DataFrame:
    """``id, n_shingles, component_id, links`` of every document; ``components`` has a column ``links`` too."""
    classes = (documents.filter("class IS NOT NULL").groupBy("class").agg(F.min(id_col).alias("least"))
               .join(components.withColumnRenamed("node", "class"), "class", "left")
               .withColumn("component", F.coalesce("component", "class")))
    roots = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(roots, "component").select("class", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    return (documents.drop("signature").join(named, "class", "left")
            .select(id_col, "n_shingles", F.coalesce("component_id", id_col).alias("component_id"),
                    F.coalesce("links", F.lit(0)).alias("links")))


def class_links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a, b, id_a, id_b``: every link between two classes once, with the smallest id of either. A group of k classes has
    up to k (k - 1) / 2 of them."""
    documents, components, edges, sets = _joined(docs, id_col, text_col)
    pair = components.groupBy("component").agg(F.count("*").alias("classes")).filter("classes = 2")
    pair = components.join(pair, "component").select(F.col("node").alias("a"))
    links = (edges.join(pair, "a", "left_semi").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .unionByName(cells(components, sets).applyInArrow(_cell_list, "a bigint, b bigint")))
    least = documents.filter("class IS NOT NULL").groupBy("class").agg(F.min(id_col).alias("id"))
    a, b = (least.select(F.col("class").alias(side), F.col("id").alias(f"id_{side}")) for side in "ab")
    return links.join(a, "a").join(b, "b").select("a", "b", "id_a", "id_b")


def _unused(columns: list[str], name: str) -> str:
    """A column name that none of ``columns`` has, in any case."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, less those that have one of smaller id in their component. Rows with one
    id stay or go together, and equal rows among them are one. Only documents that a filter of the ids concerned
    passes are shuffled. Rows that differ in any column both stay (columns of maps are not compared)."""
    documents, components, _, _ = _joined(docs, id_col, text_col)
    found = _named(documents, components.withColumn("links", F.lit(None).cast("bigint")), id_col)  # links are not counted here
    ids = found.groupBy(id_col).agg(F.max("component_id").alias("component_id"), F.count("*").alias("n"))
    gone = ~F.col("component_id").eqNullSafe(F.col(id_col))
    concerned = stored(ids.filter(gone | (F.col("n") > 1)).select(F.col(id_col).alias("_id"), gone.alias("_gone")), "concerned-ids")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(concerned.select(F.xxhash64("_id").alias("place"))))
    columns = docs.columns
    place_col, key_col, gone_col = (_unused(columns, name) for name in ("place", "key", "gone"))
    schema = docs.withColumn(place_col, F.lit(0).cast("bigint")).schema

    def filtered(passed: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.frombuffer(shared.value, dtype="<u4")
            for batch in batches:
                place = batch.column(len(columns)).to_numpy().astype(np.int64) & ((1 << FILTER_BITS) - 1)
                hit = ((bits[place >> 5] >> (place & 31).astype("<u4")) & 1 == 1)
                yield batch.filter(pa.array(hit == passed))

        return docs.withColumn(place_col, F.xxhash64(id_col)).mapInArrow(run, schema).drop(place_col)

    named = concerned.select(F.col("_id").alias(key_col), F.col("_gone").alias(gone_col))
    unsure = filtered(True).join(named, F.col(id_col).eqNullSafe(F.col(key_col)), "left")
    compared = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    repeated = unsure.filter(~F.col(gone_col)).drop(key_col, gone_col).dropDuplicates(compared)
    return (filtered(False).unionByName(unsure.filter(F.col(key_col).isNull() & F.col(gone_col).isNull()).drop(key_col, gone_col))
            .unionByName(repeated))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
