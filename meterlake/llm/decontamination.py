"""Benchmark decontamination: MinHash containment search partitioned by size, verified exactly.

A test item leaks into a document that contains at least ``threshold`` of the item's distinct 5-word
shingles. MinHash estimates Jaccard similarity, which a short item and a long document hardly have; so
the search works on parts of like size. Items are partitioned by the power of two above their shingle
count, w; a document of at most 2w shingles is one window, a longer one is covered by windows of 2w
consecutive shingles that overlap by half, so that a passage of the item's length lies whole in one.
An item of four shingles or more and its window then have a Jaccard similarity of at least 0.17 (at threshold
0.75), and with 64 hash functions, each a band of its own, a pair escapes with probability below 1e-5. Items of
fewer shingles are much smaller than the least window; they are looked up by their shingles themselves, and none
escapes. Every candidate pair is then verified by counting the item's shingles in the whole document's set.

The minima of the windows of all widths come from one pass: those of width 2w are minima of two of
width w. Item signatures and shingles travel to the tasks in chunks of ``chunk_items`` items, each of a
bounded size, and the documents are scanned once for each chunk; no document leaves its task.

Cases: null and empty texts and items have no shingles and never match; an item or document of fewer
than five words is one shingle, its whole sequence; repeated rows are searched row by row, and give
equal pairs that often; empty tables give an empty result; other input columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import read_table, stored, text_batches

SHINGLE = 5
THRESHOLD = 0.75
HASHES = 64
LEAST_WIDTH = 8
TINY = 3  # shingles
CHUNK_ITEMS = 20_000
CHUNK_SHINGLES = 4_000_000
_U = np.uint64
_SEEDS = np.random.default_rng(11).integers(0, 2**63, (2, HASHES), dtype=np.uint64) | _U(1)
_FILTER_BITS = 16


def _hashed(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash function: the high half of a product, as 32 bits."""
    return ((values * _SEEDS[0, k] + _SEEDS[1, k]) >> _U(32)).astype(np.uint32)


def width_of(n_shingles: int) -> int:
    """The size partition of an item: the power of two that holds its shingles."""
    return max(LEAST_WIDTH, 1 << max(0, n_shingles - 1).bit_length())


class ItemIndex:
    """A chunk of items: their shingle sets, for each width and hash function their sorted minima, and the tiny items
    by shingle."""

    def __init__(self, ids: list, sets: list[np.ndarray]):
        self.ids, self.sets = ids, sets
        self.shingles = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        self.minima: dict[int, list] = {}
        of_width: dict[int, list[int]] = {}
        tiny: list[int] = []
        for i, s in enumerate(sets):
            (tiny if len(s) <= TINY else of_width.setdefault(width_of(len(s)), [])).append(i)
        value = np.concatenate([np.zeros(0, _U), *(sets[i] for i in tiny)])
        order = np.argsort(value, kind="stable")
        self.tiny, self.tiny_items = value[order], np.repeat(np.array(tiny, dtype=np.int64), [len(sets[i]) for i in tiny])[order]
        self.tiny_seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.tiny_seen[value >> _U(64 - _FILTER_BITS)] = True
        for width, members in of_width.items():
            tables = []
            for k in range(HASHES):
                least = np.array([_hashed(sets[i], k).min() for i in members], dtype=np.uint32)
                order = np.argsort(least, kind="stable")
                seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
                seen[least >> (32 - _FILTER_BITS)] = True
                tables.append((least[order], np.array(members)[order], seen))
            self.minima[width] = tables

    def candidates(self, hashes: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
        """Pairs of text and item whose minima agree in a window, and of text and tiny item that share a shingle."""
        found: set[tuple[int, int]] = set()
        if len(self.tiny):
            self._tiny_matches(hashes, at, found)
        starts, text = _blocks(at, LEAST_WIDTH)
        if not len(starts) or not self.minima:
            return found
        levels, width = [], LEAST_WIDTH
        while width <= max(self.minima):
            levels.append((self.minima.get(width), text, text[1:] == text[:-1], *_halves(text)))
            text = text[levels[-1][3]]
            width *= 2
        for k in range(HASHES):
            least = np.minimum.reduceat(_hashed(hashes, k), starts)
            for tables, text, joined, even, left in levels:
                if tables:
                    window = least.copy()
                    np.minimum(least[:-1], least[1:], out=window[:-1], where=joined)
                    self._matches(tables[k], window, text, found)
                least[left] = np.minimum(least[left], least[left + 1])
                least = least[even]
        return found

    def _tiny_matches(self, hashes: np.ndarray, at: np.ndarray, found: set) -> None:
        likely = np.flatnonzero(self.tiny_seen[hashes >> _U(64 - _FILTER_BITS)])
        low = np.searchsorted(self.tiny, hashes[likely], side="left")
        high = np.searchsorted(self.tiny, hashes[likely], side="right")
        text = np.searchsorted(at, likely, side="right") - 1
        for j in np.flatnonzero(high > low):
            for i in self.tiny_items[low[j]:high[j]].tolist():
                found.add((int(text[j]), i))

    @staticmethod
    def _matches(table, window: np.ndarray, text: np.ndarray, found: set) -> None:
        least, members, seen = table
        likely = np.flatnonzero(seen[window >> (32 - _FILTER_BITS)])
        if not len(likely):
            return
        low = np.searchsorted(least, window[likely], side="left")
        high = np.searchsorted(least, window[likely], side="right")
        for j in np.flatnonzero(high > low):
            for i in members[low[j]:high[j]].tolist():
                found.add((int(text[likely[j]]), i))


def _blocks(at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First entry and text of each block of ``width`` entries; no block spans two texts."""
    sizes = np.diff(at)
    count = -(-sizes // width)
    text = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return at[text] + nth * width, text


def _halves(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which blocks begin a block of twice the width, and the places of those that have a second half."""
    even = (np.arange(len(text)) - np.searchsorted(text, text, side="left")) % 2 == 0
    left = np.flatnonzero(even[:-1] & (text[1:] == text[:-1]))
    return even, left


def item_chunks(items: DataFrame, id_col: str, text_col: str, chunk_items: int) -> Iterator[ItemIndex]:
    """The items in chunks of bounded size; the driver holds one chunk at a time."""
    ids, sets, size = [], [], 0
    for row in items.select(id_col, text_col).toLocalIterator():
        for _, _, value, _ in ta.shingle_sets(pa.array([row[1] or ""], pa.large_string()), SHINGLE):
            if len(value):
                ids.append(row[0])
                sets.append(value)
                size += len(value)
        if len(ids) >= chunk_items or size >= CHUNK_SHINGLES:
            yield ItemIndex(ids, sets)
            ids, sets, size = [], [], 0
    if ids:
        yield ItemIndex(ids, sets)


def leaks(docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """``id, item id, item_shingles, shared_shingles, containment`` of every leak."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"`{id_col}` {kind}, `{item_id}` {item_kind}, item_shingles bigint, shared_shingles bigint, containment double"
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text"))

    def search(chunk: ItemIndex) -> DataFrame:
        shared = spark.sparkContext.broadcast(chunk)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in text_batches(batches):
                rows = list(_verified(ta.utf8(batch.column(1)), index, threshold))
                if rows:
                    text, item, size, common = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(text)), pa.array([index.ids[i] for i in item]), pa.array(size, pa.int64()),
                         pa.array(common, pa.int64()), pa.array([c / s for c, s in zip(common, size)])],
                        names=[id_col, item_id, "item_shingles", "shared_shingles", "containment"])

        return texts.mapInArrow(run, schema)

    found = [search(chunk) for chunk in item_chunks(items, item_id, item_text, chunk_items)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def _verified(texts: pa.Array, index: ItemIndex, threshold: float) -> Iterator[tuple[int, int, int, int]]:
    """Text, item, the item's set size and how many of its shingles the whole text has."""
    for first, last, hashes, at in ta.words(texts):
        value, text = ta.shingles(hashes, at, SHINGLE)
        pairs = index.candidates(value, np.searchsorted(text, np.arange(last - first + 1)))
        if not pairs:
            continue
        known = np.isin(value, index.shingles)  # what is left can only be an item's
        value, text = value[known], text[known]
        own = np.searchsorted(text, np.arange(last - first + 1))
        for t, i in sorted(pairs):
            common = len(np.intersect1d(index.sets[i], value[own[t]:own[t + 1]]))
            size = len(index.sets[i])
            if common >= math.ceil(threshold * size - 1e-9):
                yield first + t, i, size, common


def decontaminated(docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text", chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """The documents without a leak, with all their columns; nothing is shuffled. After every fourth chunk of
    items the rest is written out, so that few chunks are in memory at once."""
    spark, place = docs.sparkSession, docs.columns.index(text_col)

    def without(docs: DataFrame, chunk: ItemIndex) -> DataFrame:
        shared = spark.sparkContext.broadcast(chunk)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_batches(batches, text_col):
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[t for t, *_ in _verified(ta.utf8(batch.column(place)), shared.value, threshold)]] = False
                yield batch.filter(pa.array(clean))

        return docs.mapInArrow(run, docs.schema)

    for n, chunk in enumerate(item_chunks(items, item_id, item_text, chunk_items), 1):
        docs = without(docs, chunk)
        if n % 4 == 0:
            docs = stored(docs, "decontaminated")
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
