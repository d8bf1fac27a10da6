"""Language-model scoring with a hidden Markov model.

A text's tokens are its words (``A-Z`` lower-cased) and one end. Every token of the training texts has an emission
probability in each state. The ``FREQUENT`` most frequent tokens are symbols and held by every task. Each other one
belongs to one of ``CLASSES`` classes by length and last byte, which are symbols too: a state emits the class, and
in it the token by its own expected count in that state. All tokens, and an unseen one of each class, have the same prior:
``SMOOTHING`` counts, shared out to the states. What a task holds of rare tokens are those of
one group of about ``GROUP`` tokens of text. In each round a group keeps the counts of tokens that no other group trains,
and sends those of the others, as their mean states in half precision and in packed arrays, to buckets of about
``BUCKET`` by hash, which sum them up and send them back. They grow with the corpus; what tasks hold does not.

Baum-Welch: each group sums up the expected counts of its training sequences by the scaled forward-backward
recursion, Spark adds them up by symbol and by rare token, and the driver turns the bounded totals of the symbols
into the next model. A group's texts lie in at most ``LANES`` lanes, one after the other, and all lanes take a step at a
time; of the forward messages one a window is kept, the others are computed again on the way back. Training reads whole texts:
those of over ``WHOLE`` symbols go through the recursion in blocks of ``BLOCK``, side by side, once the blocks' transfer
matrices have carried the forward and backward messages to their ends, which gives the same counts as the uncut recursion.
Scoring runs the scaled forward recursion over whole texts; those of over ``LONG`` symbols are scored in chunks whose transfer
matrices are multiplied, which is the same recursion with bounded steps.

Cases: a null or empty text is its end alone; a token that training never saw counts 0; with no training
texts N and V are 0; repeated rows are scored row by row (rows are told apart by a number of their own, not
by id); an empty table gives an empty result; other input columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path
from . import textarrays as ta
from .common import crc_mod, read_table, shared_dir, text_batches

FREQUENT = 65_000
CLASSES = 128
STATES = 8
ROUNDS = 8
BLOCK = 2048
WHOLE = 12_288  # symbols; longer texts are trained in blocks
LANES = 512
PORTION = 1 << 22  # symbols that go through the recursion together
WINDOW = 1 << 14  # symbols whose emissions are looked up together
SUMMED = 1 << 18  # symbols whose probabilities are summed up together
LONG = 1 << 15  # symbols; the matrices of chunks cost more steps of work than a sequence's own steps
CHUNK = 2048
SMOOTHING = 0.1
COUNT_BLOCK = 1 << 22
GROUP = 1 << 22  # tokens
BUCKET = 1 << 18  # rare tokens of groups
SLOT_BITS = 18
END = ta.word_hash(b" ")  # no word holds a blank
_U = np.uint64


def _tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of texts: first and end text, hash and class of each token, ends included, and each text's first."""
    offsets, data = ta.buffers(texts)
    for first, last in ta.slices(offsets):
        own = offsets[first:last + 1] - offsets[first]
        part = data[offsets[first]:offsets[last]]
        starts, stops, text = ta.word_bounds(part, own)
        hashes = ta.word_hashes(part, starts, stops)
        lasts = part[stops - 1] if len(stops) else np.zeros(0, np.uint8)
        kind = np.minimum(stops - starts, 16) - 1 + 16 * (lasts.astype(np.int64) % 8)
        at = np.searchsorted(text, np.arange(last - first + 1))
        yield (first, last, np.insert(hashes, at[1:], _U(END)), np.insert(kind, at[1:], 0),
               at + np.arange(last - first + 1))


def token_counts(texts: DataFrame) -> DataFrame:
    """``token, n, class`` over all texts: tasks sum up blocks of tokens first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed():
            tokens, kinds = (np.concatenate(x) for x in zip(*held))
            token, where, n = np.unique(tokens, return_index=True, return_counts=True)
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n, pa.int64()), pa.array(kinds[where], pa.int32())],
                                             names=["token", "n", "class"])

        size = 0
        for batch in text_batches(batches):
            for _, _, tokens, kinds, _ in _tokens(ta.utf8(batch.column(0))):
                held.append((tokens, kinds))
                size += len(tokens)
                if size >= COUNT_BLOCK:
                    yield from summed()
                    size = 0
        if held:
            yield from summed()

    parts = texts.mapInArrow(run, "token bigint, n bigint, class int")
    return parts.groupBy("token").agg(F.sum("n").alias("n"), F.max("class").alias("class"))


@dataclass(frozen=True)
class Vocabulary:
    """The frequent tokens in hash order with their counts, and totals of all training tokens and of each rare class."""

    tokens: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    class_total: np.ndarray
    class_distinct: np.ndarray

    @property
    def symbols(self) -> int:
        return len(self.tokens) + CLASSES

    @property
    def mass(self) -> float:
        """All training tokens, and ``SMOOTHING`` for each distinct one and for an unseen one of each class."""
        return float(self._room().sum())

    def _room(self) -> np.ndarray:
        return np.concatenate([self.counts + SMOOTHING, self.class_total + SMOOTHING * (self.class_distinct + 1)])

    def unigram(self) -> np.ndarray:
        return self._room() / self.mass

    def log_base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1)))

    @cached_property
    def _slots(self) -> np.ndarray:
        """For each value of a hash's leading bits, the first token from there on."""
        return np.searchsorted(self.tokens >> _U(64 - SLOT_BITS), np.arange(1 << SLOT_BITS, dtype=_U)).astype(np.int32)

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = len(self.tokens) - 1
        place = np.minimum(self._slots[tokens >> _U(64 - SLOT_BITS)], last)
        found = self.tokens[place]
        behind = np.flatnonzero(found < tokens)
        while len(behind):  # the next in the slot
            place[behind] += 1
            behind = behind[place[behind] <= last]
            found[behind] = self.tokens[place[behind]]
            behind = behind[found[behind] < tokens[behind]]
        return np.minimum(place, last), found == tokens


def vocabulary(counts: DataFrame, frequent: int) -> Vocabulary:
    per = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    total, distinct = int(per["n"].sum()), int(per["v"].sum())
    end = int(np.uint64(END).view(np.int64))
    top = (counts.orderBy(F.col("token") != end, F.desc("n"), "token").limit(frequent).select("token", "n", "class").toPandas())
    tokens, n, kinds = top["token"].to_numpy(np.int64).view(_U), top["n"].to_numpy(np.int64), top["class"].to_numpy(np.int64)
    # what the classes hold in all, less their frequent members
    rest = [np.bincount(per["class"].to_numpy(np.int64), weights=per[c], minlength=CLASSES) - np.bincount(kinds, weights=own, minlength=CLASSES)
            for c, own in (("n", n), ("v", np.ones(len(n))))]
    if END not in tokens.tolist():
        tokens, n = np.append(tokens, _U(END)), np.append(n, 0)
    order = np.argsort(tokens)
    return Vocabulary(tokens[order], n[order], total, distinct, *rest)


CODED = ("part bigint, held_out boolean, ids array<{kind}>, lengths binary, symbols binary, known binary, base binary, rare binary, "
         "token binary, class binary, here binary")


def sequences(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """A row for each portion of a group's texts, training texts and others apart: their ids and lengths, their symbols as
    unsigned 16-bit integers (at most 65,535 by ``vocabulary``), the numbers of their known tokens among the frequent ones, what
    their frequent tokens give to the base score, and the places of their rare tokens in the group's list. Texts of at most
    ``WHOLE`` symbols lie in lanes (``_Lanes``), longer ones one after the other. And a row for each group, without
    ``lengths``: the list of its rare tokens in order, their classes, and their numbers in its training texts."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    kind = docs.schema["id"].dataType.simpleString()
    names = [f.split()[0] for f in CODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, part, size = shared.value, TaskContext.get().partitionId() << 36, 0
        base = vocabulary.log_base(vocabulary.counts)
        seen = vocabulary.counts > 0
        held: list[tuple] = []

        def row(given: dict) -> pa.RecordBatch:
            columns = [given.get(f.name) for f in schema]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array([c], f.type) for c, f in zip(columns, schema)], schema=schema)

        def group() -> Iterator[pa.RecordBatch]:
            ids = pa.concat_arrays([h[0] for h in held])
            out, lengths, symbol, known, gained, tokens, classes = (np.concatenate([h[i] for h in held]) for i in range(1, 8))
            held.clear()
            rare = symbol >= len(vocabulary.tokens)
            learned = np.repeat(~out, lengths)[rare]
            token, where, place = np.unique(tokens, return_index=True, return_inverse=True)
            yield row({"part": part, "token": token.astype("<u8").tobytes(), "class": classes[where].astype("u1").tobytes(),
                       "here": np.bincount(place[learned], minlength=len(token)).astype("<i4").tobytes()})
            places = np.zeros(len(symbol), dtype="<u4")
            places[rare] = place
            del tokens, classes, learned, place, rare
            at = np.concatenate([[0], np.cumsum(lengths)])
            for aside in (False, True):
                for long in (False, True):
                    for own in _portions(np.flatnonzero((out == aside) & ((lengths > WHOLE) == long)), lengths):
                        flat, of = (np.concatenate([x[at[i]:at[i + 1]] for i in own.tolist()]) for x in (symbol, places))
                        if not long:
                            to = _Lanes(lengths[own]).places()
                            flat, of = _moved(flat, to), _moved(of, to)
                        yield row({"part": part, "held_out": aside, "ids": pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), ids.take(pa.array(own))),
                                   "lengths": lengths[own].astype("<i8").tobytes(), "symbols": flat.tobytes(), "known": known[own].astype("<i8").tobytes(),
                                   "base": gained[own].astype("<f8").tobytes(), "rare": of[flat >= len(vocabulary.tokens)].tobytes()})

        for batch in text_batches(batches):
            if not size and not held:
                schema = pa.schema([(n, t) for n, t in zip(names, [pa.int64(), pa.bool_(), pa.list_(batch.schema.field("id").type), *[pa.binary()] * 8])])
            out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for first, last, tokens, classes, at in _tokens(ta.utf8(batch.column("text"))):
                place, often = vocabulary.find(tokens)
                symbol = np.where(often, place, len(vocabulary.tokens) + classes).astype("<u2")
                held.append((batch.column("id").slice(first, last - first), out[first:last], np.diff(at), symbol,
                             np.add.reduceat(often & seen[place], at[:-1], dtype=np.int64), np.add.reduceat(np.where(often, base[place], 0.0), at[:-1]),
                             tokens[~often], classes[~often].astype(np.uint8)))
                size += len(tokens)
                if size >= GROUP:
                    yield from group()
                    part, size = part + 1, 0
        if held:
            yield from group()

    return docs.select("id", "held_out", "text").mapInArrow(run, CODED.format(kind=kind))


def _moved(values: np.ndarray, to: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[to] = values
    return out


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray  # symbols x states
    rooms: np.ndarray | None = None  # classes x states: what the counts and priors of rare tokens are divided by

    @staticmethod
    def first(unigram: np.ndarray, states: int) -> "Model":
        rng = np.random.default_rng(5)
        emits = unigram[:, None] * rng.uniform(0.2, 1.8, (len(unigram), states))
        moves = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(moves, 0.9 if states > 1 else 1.0)
        return Model(np.full(states, 1 / states), moves, emits / emits.sum(axis=0))


def expected(model: Model, symbols: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of texts, by the scaled forward-backward recursion."""
    blocks = _Lanes(lengths)
    symbol = _moved(np.concatenate(symbols), blocks.places())
    start, moves, gamma = _all_posteriors(model, blocks, symbol)
    return start, moves, _summed(symbol, gamma, len(model.emits))


def _summed(item: np.ndarray, gamma: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(item, weights=gamma[:, j], minlength=n) for j in range(gamma.shape[1])], axis=1)


class _Lanes:
    """Sequences in at most ``LANES`` lanes side by side, in a lane one after the other, the lanes by falling length. The symbols
    of one step of all lanes lie together, those of the next step after them. Where they lie follows from the lengths alone."""

    def __init__(self, lengths: np.ndarray, most: int | None = None):
        self.lengths = lengths.astype(np.int64)
        self.lanes = min(most or LANES, len(lengths))
        lane, begin = np.empty((2, len(lengths)), dtype=np.int64)
        total = np.zeros(self.lanes, dtype=np.int64)
        order, few = np.argsort(-self.lengths, kind="stable"), self.lanes if self.lanes == len(lengths) else -(-self.lanes // 8)
        for at in range(0, len(order), few):  # the longest to the lanes that hold least
            own = order[at:at + few]
            to = np.argsort(total, kind="stable")[:len(own)]
            lane[own], begin[own] = to, total[to]
            total[to] += self.lengths[own]
        by = np.argsort(-total, kind="stable")
        rank = np.empty_like(by)
        rank[by] = np.arange(self.lanes)
        self.lane, self.begin, self.end, total = rank[lane], begin, begin + self.lengths - 1, total[by]
        self.steps = int(total[0])
        self.live = np.searchsorted(-total, -np.arange(1, self.steps + 1), side="right")
        self.first = np.concatenate([[0], np.cumsum(self.live)])

    def places(self) -> np.ndarray:
        """Where the symbols of the sequences, one sequence after the other, lie."""
        out = self.first[np.repeat(self.begin - (np.cumsum(self.lengths) - self.lengths), self.lengths) + np.arange(self.lengths.sum())]
        out += np.repeat(self.lane, self.lengths)
        return out

    def firsts(self) -> np.ndarray:
        return self.first[self.begin] + self.lane

    def lasts(self) -> np.ndarray:
        return self.first[self.end] + self.lane

    def at_steps(self, step: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
        """The sequences by rising ``step``, how many there are before each step, and their lanes."""
        by = np.argsort(step, kind="stable")
        return by, np.searchsorted(step[by], np.arange(self.steps + 1)).tolist(), self.lane[by]

    def windows(self) -> list[tuple[int, int]]:
        """Ranges of steps of about ``WINDOW`` symbols."""
        cuts = np.unique(np.searchsorted(self.first, np.arange(0, self.first[-1] + WINDOW, WINDOW)).clip(max=self.steps))
        return list(zip(cuts.tolist(), cuts[1:].tolist()))


class _Forward:
    """The scaled forward recursion. ``table`` has how likely each state emits each symbol, ``begins`` what goes into the first
    step of each sequence."""

    def __init__(self, model: Model, table: np.ndarray, blocks: _Lanes, symbol: np.ndarray, begins: np.ndarray):
        self.moves, self.table, self.blocks, self.symbol = model.moves, table, blocks, symbol
        by, self.events, self.lanes = blocks.at_steps(blocks.begin)
        self.begins, self.first, self.live = begins[by], blocks.first.tolist(), blocks.live.tolist()
        k, kind = table.shape[1], table.dtype
        self.ones, self.room = np.ones((k, k), dtype=kind), np.empty((WINDOW + blocks.lanes, k), dtype=kind)
        self.moved, self.sums, self.state = np.zeros((3, blocks.lanes, k), dtype=kind)

    def run(self, a: np.ndarray, low: int, high: int, each: int, kept: np.ndarray | None = None, come: np.ndarray | None = None,
            scale: np.ndarray | None = None) -> np.ndarray:
        """The message after the steps from ``low`` to ``high``, scaled in each ``each``-th of them, from that before them. The
        messages of all places go to ``kept``, what came into them to ``come``, the scales to ``scale``."""
        first, live, events, begun = self.first, self.live, self.events, self.first[low]
        likely = np.take(self.table, self.symbol[begun:first[high]], axis=0, out=self.room[:first[high] - begun], mode="clip")
        for t in range(low, high):
            here, then, n = first[t] - begun, first[t + 1] - begun, live[t]
            now = np.matmul(a[:n], self.moves, out=self.moved[:n] if come is None else come[here:then])
            if events[t] < events[t + 1]:
                now[self.lanes[events[t]:events[t + 1]]] = self.begins[events[t]:events[t + 1]]
            a = np.multiply(now, likely[here:then], out=self.state[:n] if kept is None else kept[here:then])
            if t % each == 0:
                a /= np.matmul(a, self.ones, out=self.sums[:n])  # each state divided by the sum of all
                if scale is not None:
                    scale[here:then] = self.sums[:n, 0]
        return a


def _posteriors(model: Model, blocks: _Lanes, symbol: np.ndarray, take: Callable[[int, int, np.ndarray], None], before: np.ndarray | None = None,
                after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Expected starts and moves; ``take`` gets, for each range of places, the states' probabilities there. ``before`` and
    ``after`` are the messages from the rest of each block's text: the states' probabilities at the symbol before it (all 0
    where the text begins), and the likelihood of all that follows by the block's last state, to any scale. The arithmetic has
    the precision of the model's emissions, of which only the proportions between the states matter here. Of the forward
    messages one a window is kept; those of a window are computed again when the way back comes to it."""
    k, kind, number = len(model.start), model.emits.dtype, len(blocks.lengths)
    starts = np.ones(number, dtype=bool) if before is None else before.sum(axis=1) == 0
    begins = np.broadcast_to(model.start, (number, k)) if before is None else np.where(starts[:, None], model.start, before @ model.moves).astype(kind)
    forward = _Forward(model, model.emits / model.emits.max(axis=1, keepdims=True), blocks, symbol, begins)
    windows, kept, a = blocks.windows(), [], forward.state
    for low, high in windows:
        kept.append(a.copy())
        a = forward.run(a, low, high, 2)
    by, events, lanes = blocks.at_steps(blocks.begin)
    by_end, ends, end_lanes = blocks.at_steps(blocks.end)
    at, at_end = blocks.first[blocks.begin[by]] + lanes, blocks.first[blocks.end[by_end]] + end_lanes
    after, starts, begins = np.ones((number, k), dtype=kind) if after is None else after[by_end], starts[by], begins[by]
    first, live = forward.first, forward.live
    start, moves, backward = np.zeros(k), np.zeros((k, k)), np.ascontiguousarray(model.moves.T)
    b = np.zeros((blocks.lanes, k), dtype=kind)
    messages, states, came = np.empty((3, WINDOW + blocks.lanes, k), dtype=kind)
    for (low, high), past in zip(windows[::-1], kept[::-1]):
        begun, size = first[low], first[high] - first[low]
        message, gamma, ahead = messages[:size], states[:size], came[:size]
        forward.run(past, low, high, 2, message, ahead)
        own = slice(ends[low], ends[high])
        last = (after[own] / (message[at_end[own] - begun] * after[own]).sum(axis=1, keepdims=True)).astype(kind)
        for t in range(high - 1, low - 1, -1):
            here, then, n = first[t] - begun, first[t + 1] - begun, live[t]
            if ends[t] < ends[t + 1]:
                b[end_lanes[ends[t]:ends[t + 1]]] = last[ends[t] - ends[low]:ends[t + 1] - ends[low]]
            now = np.multiply(message[here:then], b[:n], out=gamma[here:then])
            now = np.divide(now, ahead[here:then], out=ahead[here:then])
            np.matmul(now, backward, out=b[:n])
        own = slice(events[low], events[high])
        ahead[at[own] - begun] = 0  # nothing moves from one sequence to the next
        moves += past[:live[low]].T @ ahead[:live[low]]
        if live[low] == live[high - 1]:
            moves += message[:size - live[low]].T @ ahead[live[low]:]
        else:
            for t in range(low + 1, high):
                here = first[t - 1] - begun
                moves += message[here:here + live[t]].T @ ahead[first[t] - begun:first[t + 1] - begun]
        found, new = gamma[at[own] - begun], starts[own]
        if before is not None:
            moves += before[by[own][~new]].T @ (found[~new] / begins[own][~new])
        start += found[new].sum(axis=0, dtype=np.float64)
        gamma /= gamma @ forward.ones
        take(begun, first[high], gamma)
    return start, moves * model.moves


def _all_posteriors(model: Model, blocks: _Lanes, symbol: np.ndarray, *messages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gamma = np.empty((len(symbol), len(model.start)), dtype=model.emits.dtype)
    return (*_posteriors(model, blocks, symbol, lambda i, j, own: np.copyto(gamma[i:j], own), *messages), gamma)


class _Sums:
    """Expected counts of a group's symbols and rare tokens. ``symbol`` has the symbol of each row of the emissions; the rows
    after the symbols' are the rare tokens'."""

    def __init__(self, symbol: np.ndarray, symbols: int, k: int):
        self.symbol, self.counts, self.own, self.size = symbol, np.zeros((k, symbols)), [], 0
        self.states = np.empty((k, SUMMED + WINDOW + LANES), dtype=np.float32)
        self.rare: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, item: np.ndarray, gamma: np.ndarray) -> None:
        """Of at most ``WINDOW`` + ``LANES`` places."""
        of = np.flatnonzero(item >= self.counts.shape[1])
        self.rare.append((item[of] - self.counts.shape[1], gamma[of]))
        self.own.append(self.symbol[item])
        self.states[:, self.size:self.size + len(item)] = gamma.T
        self.size += len(item)
        if self.size >= SUMMED:
            self.flush()

    def flush(self) -> None:
        if self.own:
            own = np.concatenate(self.own)
            for total, states in zip(self.counts, self.states):
                total += np.bincount(own, weights=states[:self.size], minlength=len(total))
        self.own, self.size = [], 0

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        self.flush()
        row, gamma = (np.concatenate([r[i] for r in self.rare]) for i in range(2)) if self.rare else (np.zeros(0, np.intp), np.zeros((0, len(self.counts))))
        members = _summed(row, gamma, len(self.symbol) - self.counts.shape[1])
        return self.counts.T, members


def _transfers(model: Model, symbols: list[np.ndarray], begins: np.ndarray) -> np.ndarray:
    """Of each block, to a scale, the matrix that takes the states' weights before it to those at its last symbol; of a
    text's first block, the start to those at its last symbol."""
    k = len(model.start)
    out = np.empty((len(symbols), k, k))
    onward, table = np.ascontiguousarray(model.moves.T), np.ascontiguousarray(model.emits.T)
    lengths = np.array([len(s) for s in symbols])
    for own in _portions(np.argsort(-lengths, kind="stable"), lengths):
        blocks = _Lanes(lengths[own], len(own))
        symbol = _moved(np.concatenate([symbols[i] for i in own]), blocks.places()).astype(np.intp)
        own, first, live = own[np.argsort(blocks.lane)], blocks.first.tolist(), blocks.live.tolist()
        # state after x state before x lane
        m = np.where(begins[own], np.eye(k, dtype=table.dtype)[:, :, None], onward[:, :, None])
        for t in range(blocks.steps):
            n = live[t]
            if n < m.shape[2]:
                out[own[n:m.shape[2]]] = m[:, :, n:].transpose(2, 1, 0)
                m = np.ascontiguousarray(m[:, :, :n])
            likely = np.take(table, symbol[first[t]:first[t + 1]], axis=1, mode="clip")
            likely /= likely.max(axis=0)
            if t:
                m = (onward @ m.reshape(k, -1)).reshape(k, k, n)
            m *= likely[:, None]
            if t % 4 == 0:
                m /= m.sum(axis=(0, 1))
        out[own[:m.shape[2]]] = m.transpose(2, 1, 0)
    return out / out.sum(axis=(1, 2), keepdims=True)


def _portions(chosen: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The chosen ones in their order, in portions of about ``PORTION`` symbols."""
    if not len(chosen):
        return []
    number = (np.cumsum(lengths[chosen]) - 1) // PORTION
    return np.split(chosen, np.flatnonzero(np.diff(number)) + 1)


def whole_texts(model: Model, symbols: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, _Lanes]]:
    """What ``_all_posteriors`` gives for whole texts of any length, in portions of bounded size, with the places' symbols."""
    k = len(model.start)
    text = np.repeat(np.arange(len(symbols)), [-(-len(s) // BLOCK) for s in symbols])
    cut = [s[i:i + BLOCK] for s in symbols for i in range(0, len(s), BLOCK)]
    begins, ends = np.append(True, text[1:] != text[:-1]), np.append(text[1:] != text[:-1], True)
    before, after = np.zeros((len(cut), k)), np.ones((len(cut), k))
    several = np.flatnonzero(~(begins & ends))
    if len(several):
        matrices = dict(zip(several.tolist(), _transfers(model, [cut[i] for i in several], begins[several])))
        for i in several.tolist():
            if not begins[i]:
                state = (model.start if begins[i - 1] else before[i - 1]) @ matrices[i - 1]
                before[i] = state / state.sum()
        for i in several[::-1].tolist():
            if not ends[i]:
                state = matrices[i + 1] @ after[i + 1]
                after[i] = state / state.sum()
    lengths = np.array([len(s) for s in cut], dtype=np.int64)
    for own in _portions(np.arange(len(cut)), lengths):
        blocks = _Lanes(lengths[own])
        symbol = _moved(np.concatenate([cut[j] for j in own]), blocks.places()).astype(np.intp)
        yield (*_all_posteriors(model, blocks, symbol, before[own], after[own]), symbol, blocks)


# what a row that goes to a group holds
LISTED, NUMBERS, OWN, SHARED, SYMBOL = range(5)
GIVEN = "part bigint, what int, bucket int, token binary, class binary, here binary, data binary"
SYMBOL_BLOCK = 4096
START = -1  # the bucket of the start and the moves


class RareTokens:
    """The list of a group's rare tokens with their classes, their numbers in the group's training texts and in all, and
    their expected counts by state, as the rows that go to the group give them.

    A token with training texts in one group only is the group's ``own``; the others are ``shared``, and their counts come
    by bucket of their hash, each bucket in the list's order. After the last round every token comes so."""

    def __init__(self, rows: pa.Table, buckets: int, k: int, final: bool = False):
        what, bucket = rows.column("what").to_numpy(), rows.column("bucket").to_numpy()
        data, listed = rows.column("data").to_pylist(), rows.slice(int(np.flatnonzero(what == LISTED)[0]), 1)
        self.token, self.classes, self.here = (np.frombuffer(listed.column(c)[0].as_py(), t) for c, t in (("token", "<u8"), ("class", "u1"), ("here", "<i4")))
        self.buckets = buckets
        self.n = np.zeros(len(self.token), dtype=np.int64)
        places = dict(self.by_bucket(np.arange(len(self.token))))
        for i in np.flatnonzero(what == NUMBERS):
            self.n[places[bucket[i]]] = np.frombuffer(data[i], "<i8")
        self.counts = np.repeat(self.n[:, None] / k, k, axis=1)  # before the first round
        if not final:
            places = dict(self.by_bucket(self.shared()))
        for i in np.flatnonzero((what == OWN) | (what == SHARED)):
            at = self.own() if what[i] == OWN else places[bucket[i]]
            self.counts[at] = np.frombuffer(data[i], "<f2").reshape(-1, k) * self.n[at, None]

    def own(self) -> np.ndarray:
        return np.flatnonzero((self.here > 0) & (self.here == self.n))

    def shared(self) -> np.ndarray:
        return np.flatnonzero((self.here > 0) & (self.here < self.n))

    def by_bucket(self, chosen: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        return _by_bucket(self.token, chosen, self.buckets)

    def table(self, model: Model) -> np.ndarray:
        """Emissions by state of the symbols, and after them of the group's rare tokens."""
        k = self.counts.shape[1]
        own = (self.counts + SMOOTHING / k) / model.rooms[self.classes] * model.emits[len(model.emits) - CLASSES + self.classes.astype(np.intp)]
        return np.concatenate([model.emits, own])


def _items(symbols: bytes, rare: bytes, known: int) -> np.ndarray:
    """The rows of ``RareTokens.table`` for the symbols of a portion."""
    symbol = np.frombuffer(symbols, "<u2")
    out = symbol.astype(np.int32)
    out[symbol >= known] = np.frombuffer(rare, "<u4") + np.uint32(known + CLASSES)
    return out


def _cut(flat: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(lengths)[:-1])


def _by_bucket(token: np.ndarray, chosen: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    key = token[chosen] % _U(buckets)
    order = np.argsort(key, kind="stable")
    found, at = np.unique(key[order], return_index=True)
    for b, places in zip(found.tolist(), np.split(chosen[order], at[1:])):
        yield b, places


def _numbers(listed: DataFrame, buckets: int) -> DataFrame:
    """``part, what, bucket, data``: the numbers in training of each group's rare tokens, summed up over the groups."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, token, here in zip(*(batch.column(i).to_pylist() for i in range(3))):
                token, here = np.frombuffer(token, "<u8"), np.frombuffer(here, "<i4")
                for b, places in _by_bucket(token, np.arange(len(token)), buckets):
                    yield pa.RecordBatch.from_pydict({"part": [part], "bucket": pa.array([b], pa.int32()), "token": [token[places].tobytes()],
                                                      "here": [here[places].tobytes()]})

    def summed(rows: pa.Table) -> pa.Table:
        tokens = [np.frombuffer(t, "<u8") for t in rows.column("token").to_pylist()]
        _, place = np.unique(np.concatenate(tokens), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([np.frombuffer(h, "<i4") for h in rows.column("here").to_pylist()])).astype("<i8")[place]
        return _given(rows, NUMBERS, n, tokens)

    return (listed.select("part", "token", "here").mapInArrow(spread, "part bigint, bucket int, token binary, here binary")
            .groupBy("bucket").applyInArrow(summed, "part bigint, what int, bucket int, data binary"))


def _given(rows: pa.Table, what: int, values: np.ndarray, tokens: list[np.ndarray]) -> pa.Table:
    """A bucket's values for the groups that asked for them."""
    parts = np.split(values, np.cumsum([len(t) for t in tokens])[:-1])
    return pa.table({"part": rows.column("part"), "what": pa.array(np.full(len(rows), what), pa.int32()), "bucket": rows.column("bucket"),
                     "data": pa.array([v.tobytes() for v in parts], pa.binary())})


def _shared_counts(rows: DataFrame, k: int) -> DataFrame:
    """``part, what, bucket, data``: for each group, the mean states of its shared tokens over all groups."""
    def summed(rows: pa.Table) -> pa.Table:
        tokens = [np.frombuffer(t, "<u8") for t in rows.column("token").to_pylist()]
        here = np.concatenate([np.frombuffer(h, "<i4") for h in rows.column("here").to_pylist()]).astype(np.float64)
        means = np.concatenate([np.frombuffer(d, "<f2") for d in rows.column("data").to_pylist()]).reshape(-1, k)
        _, place = np.unique(np.concatenate(tokens), return_inverse=True)
        n = np.maximum(np.bincount(place, weights=here), 1)
        total = np.stack([np.bincount(place, weights=means[:, j] * here) for j in range(k)], axis=1)
        return _given(rows, SHARED, (total / n[:, None])[place].astype("<f2"), tokens)

    return (rows.filter(F.col("what") == SHARED).select("part", "bucket", "token", "here", "data")
            .groupBy("bucket").applyInArrow(summed, "part bigint, what int, bucket int, data binary"))


def _symbol_counts(rows: DataFrame, symbols: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, moves and emissions of symbols, summed up in the tasks that read them and then by block of symbols."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, item, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bucket not in sums:
                    sums[bucket] = np.zeros((k + 1 if bucket == START else SYMBOL_BLOCK, k))
                if item is None:
                    sums[bucket] += np.frombuffer(data, "<f8").reshape(-1, k)
                else:
                    sums[bucket][np.frombuffer(item, "<i4")] += np.frombuffer(data, "<f4").reshape(-1, k)
        for bucket, total in sums.items():
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "token": pa.array([None], pa.binary()), "data": [total.tobytes()]})

    schema = "bucket int, token binary, data binary"
    sums = (rows.filter(F.col("what") == SYMBOL).select("bucket", "token", "data").mapInArrow(summed, schema)
            .repartition("bucket").mapInArrow(summed, schema).collect())  # at most the model's size
    first, emits = np.zeros((k + 1, k)), np.zeros((-(-symbols // SYMBOL_BLOCK) * SYMBOL_BLOCK, k))
    for r in sums:
        total = np.frombuffer(r["data"], "<f8").reshape(-1, k)
        if r["bucket"] == START:
            first += total
        else:
            emits[r["bucket"] * SYMBOL_BLOCK:(r["bucket"] + 1) * SYMBOL_BLOCK] += total
    return first[0], first[1:], emits[:symbols]


def _expected_counts(training: DataFrame, given: DataFrame, model: Model, words: Vocabulary, buckets: int, last: bool) -> DataFrame:
    """``part, what, bucket, token, here, data``: what the training texts of each group give to the counts: of symbols
    in blocks, of the group's own rare tokens, and of its shared ones by bucket, as mean states in half precision."""
    k = len(model.start)
    shared = training.sparkSession.sparkContext.broadcast((model, words))

    def run(rows: pa.Table, rare_rows: pa.Table) -> pa.Table:
        own, vocabulary = shared.value
        rare, known = RareTokens(rare_rows, buckets, k), len(vocabulary.tokens)
        own = Model(*(x.astype(np.float32) for x in (own.start, own.moves, rare.table(own))))
        first = np.zeros((k + 1, k))
        sums = _Sums(np.concatenate([np.arange(known + CLASSES), known + rare.classes.astype(np.intp)]), known + CLASSES, k)
        for i in range(len(rows)):
            lengths, item = np.frombuffer(rows.column("lengths")[i].as_py(), "<i8"), _items(*(rows.column(c)[i].as_py() for c in ("symbols", "rare")), known)
            if lengths.max() > WHOLE:
                for start, moves, gamma, at, _ in whole_texts(own, _cut(item, lengths)):
                    first += np.vstack([start, moves])
                    for j in range(0, len(at), WINDOW):
                        sums.add(at[j:j + WINDOW], gamma[j:j + WINDOW])
            else:
                start, moves = _posteriors(own, _Lanes(lengths), item, lambda i, j, gamma, item=item: sums.add(item[i:j], gamma))
                first += np.vstack([start, moves])
        emits, members = sums.totals()
        out: list[tuple] = []
        if len(rows):
            out.append((SYMBOL, START, np.arange(k + 1, dtype="<i4").tobytes(), None, first.astype("<f4").tobytes()))
        used = np.flatnonzero(emits.sum(axis=1))
        for block in np.unique(used // SYMBOL_BLOCK).tolist():
            items = used[used // SYMBOL_BLOCK == block]
            out.append((SYMBOL, block, (items % SYMBOL_BLOCK).astype("<i4").tobytes(), None, emits[items].astype("<f4").tobytes()))
        means = (members / np.maximum(rare.here, 1)[:, None]).astype("<f2")
        if not last and len(rare.own()):
            out.append((OWN, 0, None, None, means[rare.own()].tobytes()))
        for b, at in rare.by_bucket(np.arange(len(rare.token)) if last else rare.shared()):
            out.append((SHARED, b, rare.token[at].tobytes(), rare.here[at].tobytes(), means[at].tobytes()))
        part = rare_rows.column("part")[0].as_py()
        what, bucket, token, here, data = zip(*out) if out else ((),) * 5
        return pa.table({"part": pa.array([part] * len(out), pa.int64()), "what": pa.array(what, pa.int32()), "bucket": pa.array(bucket, pa.int32()),
                         "token": pa.array(token, pa.binary()), "here": pa.array(here, pa.binary()), "data": pa.array(data, pa.binary())})

    return (training.select("part", "lengths", "symbols", "rare").groupBy("part").cogroup(given.groupBy("part"))
            .applyInArrow(run, "part bigint, what int, bucket int, token binary, here binary, data binary"))


def _written(df: DataFrame, what: str, *apart: str) -> tuple[DataFrame, str]:
    """``df`` as a table of the shared folder, and its path. Its rows may hold megabytes: the writer looks at its memory
    after each. Rows that differ in ``apart`` go to files of their own, so that a reader of some leaves out the others."""
    path = shared_dir(df.sparkSession, what)
    (df.write.partitionBy(*apart).option("parquet.block.size", str(32 << 20)).option("parquet.block.size.row.check.min", "1")
     .option("parquet.page.size.row.check.min", "1").parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _all_given(*tables: DataFrame | None) -> DataFrame:
    """The rows that go to the groups, with the columns of ``GIVEN``."""
    fields = [f.split() for f in GIVEN.split(", ")]
    made = [t.select(*(F.col(n) if n in t.columns else F.lit(None).cast(kind).alias(n) for n, kind in fields)) for t in tables if t is not None]
    out = made[0]
    for t in made[1:]:
        out = out.unionByName(t)
    return out


class _ShufflesFreed:
    """Spark gives back a query's shuffle files when it ends, instead of whenever the driver collects its garbage."""

    KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self) -> None:
        self.before = self.conf.get(self.KEY, None)
        self.conf.set(self.KEY, "true")

    def __exit__(self, *error) -> None:
        if self.before is None:
            self.conf.unset(self.KEY)
        else:
            self.conf.set(self.KEY, self.before)


def baum_welch(training: DataFrame, listed: DataFrame, words: Vocabulary, states: int, rounds: int, buckets: int) -> tuple[Model, DataFrame]:
    """The model, and the rows that give each group its rare tokens with their expected counts by state."""
    spark, unigram = training.sparkSession, words.unigram()
    rare_prior = SMOOTHING / states * (words.class_distinct[:, None] + 1)
    prior = np.concatenate([np.full((len(words.tokens), 1), SMOOTHING / states), rare_prior])
    model = replace(Model.first(unigram, states), rooms=np.repeat(words.class_total[:, None] / states + rare_prior, states, axis=1))
    numbers, _ = _written(_numbers(listed, buckets), "rare-token-numbers")
    counts, path = None, None
    for i in range(rounds):
        found, found_path = _written(_expected_counts(training, _all_given(listed, numbers, counts), model, words, buckets, i == rounds - 1),
                                     "expected-counts", "what")
        start, moves, emits = _symbol_counts(found, words.symbols, states)
        own = found.filter(F.col("what") == OWN).select("part", "what", "bucket", "data")
        counts, last = _written(_shared_counts(found, states).unionByName(own), "rare-token-counts"), path
        counts, path = counts
        for done in (found_path, last):
            if done:
                delete_path(spark, done)
        start, moves, rooms, emits = start + 0.1, moves + 0.1, emits[len(words.tokens):] + rare_prior, emits + prior
        model = Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0), rooms)
    return model, _all_given(listed, numbers, counts)


def log_likelihoods(model: Model, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log10 probability of each sequence, by the scaled forward recursion over its whole length."""
    lengths = np.diff(at)
    out = np.zeros(len(lengths))
    for own in _portions(np.flatnonzero((lengths > 0) & (lengths <= LONG)), lengths):
        blocks = _Lanes(lengths[own])
        out[own] = _in_lanes(model, blocks, _moved(np.concatenate([flat[at[i]:at[i + 1]] for i in own.tolist()]), blocks.places()))
    for i in np.flatnonzero(lengths > LONG):
        out[i] = _in_chunks(model, flat[at[i]:at[i + 1]])
    return out


def _in_lanes(model: Model, blocks: _Lanes, symbol: np.ndarray) -> np.ndarray:
    forward = _Forward(model, model.emits, blocks, symbol, np.broadcast_to(model.start, (len(blocks.lengths), len(model.start))))
    by, ends, lanes = blocks.at_steps(blocks.end)
    first, found, total, a = forward.first, np.empty(len(by)), np.zeros(blocks.lanes), forward.state
    scale = np.empty(WINDOW + blocks.lanes)
    for low, high in blocks.windows():
        begun = first[low]
        a = forward.run(a, low, high, 1, scale=scale)
        log = np.log10(scale[:first[high] - begun])
        for t in range(low, high):
            total[:first[t + 1] - first[t]] += log[first[t] - begun:first[t + 1] - begun]
            if ends[t] < ends[t + 1]:
                own = slice(ends[t], ends[t + 1])
                found[own] = total[lanes[own]]
                total[lanes[own]] = 0
    return _moved(found, by)


def _in_chunks(model: Model, symbols: np.ndarray) -> float:
    """One long sequence: the transfer matrices of its chunks, computed side by side, applied in turn."""
    state = model.start * model.emits[symbols[0]]
    total, state = math.log10(state.sum()), state / state.sum()
    rest = symbols[1:]
    whole = len(rest) // CHUNK
    for group in range(0, whole, 64):
        span = slice(group * CHUNK, min(group + 64, whole) * CHUNK)
        chunks = rest[span].reshape(-1, CHUNK)
        matrices = np.tile(np.eye(len(state)), (len(chunks), 1, 1))
        logs = np.zeros(len(chunks))
        for t in range(CHUNK):
            matrices = (matrices @ model.moves) * model.emits[chunks[:, t]][:, None, :]
            scale = matrices.sum(axis=(1, 2))
            matrices /= scale[:, None, None]
            logs += np.log10(scale)
        for matrix, log in zip(matrices, logs):
            state = state @ matrix
            total += log + math.log10(state.sum())
            state /= state.sum()
    for s in rest[whole * CHUNK:]:
        state = (state @ model.moves) * model.emits[s]
        total += math.log10(state.sum())
        state /= state.sum()
    return total


def likelihoods(coded: DataFrame, given: DataFrame, model: Model, words: Vocabulary, buckets: int) -> DataFrame:
    """``id, held_out, n_tokens, known, base, log`` of every row, its rare tokens included."""
    shared = coded.sparkSession.sparkContext.broadcast((model, words))
    base_room = math.log10(words.total + SMOOTHING * (words.distinct + 1))
    kind = coded.schema["ids"].dataType.elementType.simpleString()

    def run(rows: pa.Table, rare_rows: pa.Table) -> pa.Table:
        own, vocabulary = shared.value
        rare, frequent = RareTokens(rare_rows, buckets, len(own.start), final=True), len(vocabulary.tokens)
        own = Model(own.start, own.moves, rare.table(own))
        out = []
        for i in range(len(rows)):
            lengths, known, base = (np.frombuffer(rows.column(c)[i].as_py(), t) for c, t in (("lengths", "<i8"), ("known", "<i8"), ("base", "<f8")))
            item = _items(*(rows.column(c)[i].as_py() for c in ("symbols", "rare")), frequent)
            text = np.repeat(np.arange(len(lengths)), lengths)
            if lengths.max() > WHOLE:
                log = log_likelihoods(own, item, np.concatenate([[0], np.cumsum(lengths)]))
            else:
                blocks = _Lanes(lengths)
                log, text = _in_lanes(own, blocks, item), _moved(text, blocks.places())
            of = item >= frequent + CLASSES
            text, number = text[of], rare.n[item[of] - frequent - CLASSES]
            known = known + np.bincount(text, weights=number > 0, minlength=len(lengths)).astype(np.int64)
            base = base + np.bincount(text, weights=np.log10(number + SMOOTHING) - base_room, minlength=len(lengths))
            out.append(pa.table([rows.column("ids")[i].values, pa.array(np.full(len(lengths), rows.column("held_out")[i].as_py())), pa.array(lengths, pa.int64()),
                                 pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(log, pa.float64())],
                                names=["id", "held_out", "n_tokens", "known", "base", "log"]))
        return pa.concat_tables(out)

    return (coded.select("part", "held_out", "ids", "lengths", "symbols", "known", "base", "rare").groupBy("part").cogroup(given.groupBy("part"))
            .applyInArrow(run, f"id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, log double"))


def scores(docs: DataFrame, held_out, *, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS,
           frequent: int = FREQUENT) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row; texts with ``held_out`` (a
    condition) are scored but not learned from."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    with _ShufflesFreed(docs.sparkSession):
        counts, path = _written(token_counts(rows.filter("NOT held_out").select("text")), "token-counts")
        words = vocabulary(counts, frequent)
        delete_path(docs.sparkSession, path)
        table, _ = _written(sequences(rows, words), "symbol-sequences")
        coded = table.filter("lengths IS NOT NULL")
        listed = table.filter("lengths IS NULL").select("part", F.lit(LISTED).alias("what"), "token", "class", "here")
        pairs = listed.agg(F.sum(F.length("here") / 4)).first()[0] or 0
        buckets = max(1, math.ceil(pairs / BUCKET))
        model, given = baum_welch(coded.filter("NOT held_out"), listed, words, states, rounds, buckets)
    return (likelihoods(coded, given, model, words, buckets)
            .select(F.col("id").alias(id_col), "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
                    F.col("base").alias("base_score"), F.col("log").alias("score")))


def op10_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(read_table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 10) == 0)
