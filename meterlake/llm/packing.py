"""Packing by Karmarkar-Karp multiway differencing.

Each document becomes its token ids and an end id. Full windows are cut off its front; the rest is cut
into pieces of at most ``piece`` tokens. Pieces are gathered into blocks of bounded size inside each
task, and a block is packed into k windows: the partial partitions with the largest differences between
their slots are merged, the fullest slot of one with the emptiest of the other, until one partition with
near-equal sums is left. k starts at the least possible count and rises by one whenever the fullest
window exceeds the capacity. Nothing is shuffled and a block is all that a task holds, however long its
texts or its partition; only the last window of a block carries noticeable padding.

Cases: a null or empty text is the end id alone; repeated rows are packed row by row; an empty table
gives an empty result; other input columns are not read. Sequence ids join the number of the task's
partition and a counter, so the input's partitions must not change when a task is run again, as holds
for scans and shuffles by key.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_batches
from .tokenizer_files import TokenizerFile, encoder, public_byte_bpe

CAPACITY = 2048
PIECE = 512
BLOCK_PIECES = 1000
BLOCK_TOKENS = 1 << 21


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Slot of each item and the largest slot sum after multiway differencing into ``k`` slots."""
    n = len(sizes)
    if k == 1 or n <= k:
        slots = np.arange(n) % k
        return slots, int(np.bincount(slots, weights=sizes, minlength=k).max())
    left, right = np.full(n, -1), np.full(n, -1)
    left, right = list(left), list(right)  # of merged slots; items are the first n nodes
    heap = []
    for i, size in enumerate(sizes.tolist()):
        sums, nodes = np.zeros(k, dtype=np.int64), np.full(k, -1, dtype=np.int64)
        sums[0], nodes[0] = size, i
        heap.append((-size, i, sums, nodes))
    heapq.heapify(heap)
    order = n
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other, more = heapq.heappop(heap)
        sums = sums + other[::-1]  # slots stand in falling order
        more = more[::-1]
        both = np.flatnonzero((nodes >= 0) & (more >= 0))
        merged = np.maximum(nodes, more)
        if len(both):
            first = len(left)
            left.extend(nodes[both].tolist())
            right.extend(more[both].tolist())
            merged[both] = np.arange(first, first + len(both))
        fall = np.argsort(-sums, kind="stable")
        sums, merged = sums[fall], merged[fall]
        order += 1
        heapq.heappush(heap, (int(sums[-1] - sums[0]), order, sums, merged))
    _, _, sums, nodes = heap[0]
    slot = np.full(len(left), -1)
    slot[nodes[nodes >= 0]] = np.flatnonzero(nodes >= 0)
    slot = slot.tolist()
    for node in range(len(left) - 1, n - 1, -1):
        slot[left[node]] = slot[right[node]] = slot[node]
    return np.array(slot[:n]), int(sums[0])


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each piece; no window holds more than ``capacity``."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        slots, fullest = differencing(sizes, k)
        if fullest <= capacity:
            return slots
        k += 1


class _Block:
    """Pieces of a bounded number of tokens; full windows are not differenced."""

    def __init__(self, capacity: int):
        self.capacity, self.pieces, self.loose, self.tokens = capacity, [], [], 0

    def add(self, doc_id, ids: np.ndarray, start: int, length: int, total: int) -> None:
        if length < self.capacity:
            self.loose.append(len(self.pieces))
        self.pieces.append((doc_id, start, length, total, ids[start:start + length].tobytes()))
        self.tokens += length

    def packed(self, first: int) -> tuple[list, int]:
        """Rows with sequence numbers from ``first`` and offsets; the next free number."""
        sequence = np.full(len(self.pieces), -1, dtype=np.int64)
        loose = np.array(self.loose, dtype=np.int64)
        if len(loose):
            sequence[loose] = windows_of(np.array([self.pieces[i][2] for i in self.loose]), self.capacity)
            _, sequence[loose] = np.unique(sequence[loose], return_inverse=True)
            sequence[loose] += first
            first = int(sequence[loose].max()) + 1
        full = np.flatnonzero(sequence < 0)
        sequence[full] = np.arange(first, first + len(full))
        fill: dict[int, int] = {}
        rows = []
        for (doc_id, start, length, total, ids), seq in zip(self.pieces, sequence.tolist()):
            at = fill.get(seq, 0)
            fill[seq] = at + length
            rows.append((doc_id, start, length, total, ids, seq, at))
        return rows, first + len(full)


def pack(docs: DataFrame, tokenizer: TokenizerFile, *, capacity: int = CAPACITY, end_id: int = 1, piece: int = PIECE,
         block_pieces: int = BLOCK_PIECES, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``id, start, length, ids, doc_tokens, sequence_id, offset`` for every piece; ``ids`` are unsigned
    little-endian 32-bit integers."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start bigint, length bigint, doc_tokens bigint, ids binary, sequence_id bigint, offset bigint"

    def out(block: _Block, first: int, id_type: pa.DataType) -> tuple[pa.RecordBatch, int]:
        rows, following = block.packed(first)
        columns = list(zip(*rows))
        types = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        names = [id_col, "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names), following

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block, following = encoder(tokenizer), _Block(capacity), TaskContext.get().partitionId() << 40
        id_type = None
        for batch in text_batches(batches, "text"):
            id_type = batch.column(0).type
            known: dict[str, np.ndarray] = {}  # copies inside a batch are encoded once
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                ids = known.get(text)
                if ids is None:
                    ids = known[text] = np.append(own.ids(text), end_id).astype("<u4")
                total = len(ids)
                rest = total - total % capacity
                cuts = [*range(0, rest, capacity), *range(rest, total, piece), total]
                for start, end in zip(cuts, cuts[1:]):
                    block.add(doc_id, ids, start, end - start, total)
                    if len(block.loose) >= block_pieces or block.tokens >= block_tokens:
                        table, following = out(block, following, id_type)
                        yield table
                        block = _Block(capacity)
        if block.pieces:
            yield out(block, following, id_type)[0]

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, schema)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read_table(spark, sf_dir, "documents"), public_byte_bpe())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
