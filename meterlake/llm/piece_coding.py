"""SentencePiece encoding and decoding by vectorised merge rounds.

The model file names pieces and scores. A text is normalised as the model says (a leading space symbol,
blanks as that symbol) and split into words at the places that no piece crosses. The different words of a
batch lie in one flat array of symbols: in each round, every word's adjacent pair with the best rank (the
smallest, of equal ones the leftmost) is merged, in all words at once; then the array is compacted, and
words in which no pair is a piece drop out, until none remains. Within a word, all non-overlapping
occurrences of the best pair are merged in one round, from the left, unless a longer piece around the
merged one has a rank as good: the order of merges then matters, and the leftmost alone is merged. Symbols
that are no piece become the bytes of their characters.

A task keeps the ids of words it has met, ``WORDS_KEPT`` at most, and starts anew beyond; results do not
depend on it. A word of over ``LONG`` symbols whose merges must go one by one (a long run of blanks) merges
through a heap, with the same result. Texts are coded in batches of bounded size, or one text.

Only byte-pair models with byte fallback and identity normalisation are accepted.

Cases: a null or empty text has no ids, and decodes to the empty text; repeated rows are coded row by row;
a null id stays null; null ids decode to the empty text; an empty table gives an empty result; other input
columns are not read.
"""
from __future__ import annotations

import codecs
import functools
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_batches

SPACE = "▁"
WORDS_KEPT = 400_000
LONG = 512
_NONE = np.int64(1) << 40
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of every field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 2: -1, 5: 4}[kind]
            n = varint() if n < 0 else n
            yield key >> 3, data[at:at + n]
            at += n


class Pieces:
    """Pieces of a model file, their merges, and the places where words may be cut."""

    # fixed values of the file format: kinds of pieces, and the byte-pair model
    NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
    BYTE_PAIR = 2

    def __init__(self, model: bytes):
        names: list[str] = []
        score: list[float] = []
        kind: list[int] = []
        self.dummy_prefix, self.trims, self.escapes = True, True, True
        model_type, fallback, charsmap = 1, False, b""
        for field, value in _fields(model):
            if field == 1:
                own = dict(_fields(value))
                names.append(own.get(1, b"").decode())
                score.append(float(np.frombuffer(own.get(2, b"\0\0\0\0"), "<f4")[0]))
                kind.append(own.get(3, self.NORMAL))
            elif field == 2:
                own = dict(_fields(value))
                model_type, fallback = own.get(3, 1), bool(own.get(35, 0))
            elif field == 3:
                own = dict(_fields(value))
                charsmap = own.get(2, b"")
                self.dummy_prefix, self.trims, self.escapes = (bool(own.get(f, 1)) for f in (3, 4, 5))
        if model_type != self.BYTE_PAIR or not fallback or charsmap or self.trims or not self.escapes or {self.USER, self.UNUSED} & set(kind):
            raise ValueError("not a plain byte-pair model with byte fallback and identity normalisation")
        self.size = len(names)
        self.byte_id = np.zeros(256, dtype=np.int64)
        surface: list[bytes] = []
        for i, (name, k) in enumerate(zip(names, kind)):
            if k == self.BYTE:
                self.byte_id[int(name[3:5], 16)] = i
                surface.append(bytes([int(name[3:5], 16)]))
            else:
                surface.append(b"" if k == self.CONTROL else b" \xe2\x81\x87 " if k == self.UNKNOWN else name.replace(SPACE, " ").encode())
        self.is_byte = np.array([k == self.BYTE for k in kind])
        self.leads = np.array([k == self.NORMAL and n.startswith(SPACE) for n, k in zip(names, kind)])
        self.length = np.array([len(s) for s in surface], dtype=np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(surface), dtype=np.uint8)

        self.id_of = {n: i for i, (n, k) in enumerate(zip(names, kind)) if k == self.NORMAL}
        order = {s: r for r, s in enumerate(sorted({score[i] for i in self.id_of.values()}, reverse=True))}
        self.rank = np.full(self.size, _NONE, dtype=np.int64)
        for i in self.id_of.values():
            self.rank[i] = order[score[i]]
        self._merges()
        pairs = sorted({n[j:j + 2] for n in self.id_of for j in range(len(n) - 1)})
        self.inside = np.array([ord(p[0]) << 21 | ord(p[1]) for p in pairs], dtype=np.int64)
        self.inside.sort()
        #: words may be cut before every run of space symbols
        self.parted = not any(p[0] != SPACE and p[1] == SPACE for p in pairs)
        self.plain = self.parted and self.dummy_prefix
        letters = sorted(n for n in self.id_of if len(n) == 1)
        self.letter = np.array([ord(c) for c in letters], dtype=np.int64)
        self.letter_id = np.array([self.id_of[c] for c in letters], dtype=np.int64)

    def _merges(self) -> None:
        """All pairs of pieces that are a piece together; ``order_matters`` where one with another neighbour ranks as well.
        A symbol that is no piece joins pieces too, as its character: it is number ``size + code point``."""
        known: dict[str, int] = dict(self.id_of)
        for name in self.id_of:
            for c in name:
                known.setdefault(c, self.size + ord(c))
        left, right, made = [], [], []
        self.order_matters = np.zeros(self.size, dtype=bool)
        for name, i in self.id_of.items():
            for j in range(1, len(name)):
                a, b = known.get(name[:j]), known.get(name[j:])
                if a is None or b is None:
                    continue
                left.append(a)
                right.append(b)
                made.append(i)
                for part in (a, b):
                    if part < self.size and self.rank[part] >= self.rank[i]:
                        self.order_matters[part] = True
        self.base = np.int64(self.size + 0x110000)
        key = np.array(left, dtype=np.int64) * self.base + np.array(right, dtype=np.int64)
        # an open table, an eighth full: a key lies at its own place or right after those it met there
        bits = max(int(8 * len(key)).bit_length(), 4)
        self.shift = np.uint64(64 - bits)
        places = ((key.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64).tolist()
        table, result = [-1] * ((1 << bits) + len(key)), [-1] * ((1 << bits) + len(key))
        self.reach = 1
        for k, m, at in zip(key.tolist(), made, places):
            own = at
            while table[at] not in (-1, k):
                at += 1
            table[at], result[at] = k, m
            self.reach = max(self.reach, at - own + 1)
        self.pair, self.made = np.array(table, dtype=np.int64), np.array(result, dtype=np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece of each adjacent pair; -1 where there is none."""
        key = a * self.base + b
        at = ((key.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)
        out = np.where(self.pair[at] == key, self.made[at], -1)
        open_ = np.flatnonzero((out < 0) & (self.pair[at] >= 0))
        for _ in range(1, self.reach):
            if not len(open_):
                break
            at[open_] += 1
            there = self.pair[at[open_]]
            met = there == key[open_]
            out[open_[met]] = self.made[at[open_[met]]]
            open_ = open_[~met & (there >= 0)]
        return out

    # --- encoding ---------------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The normalised text, cut where no piece reaches across. A word's space symbol is left out if it has just one,
        in front (see :meth:`whole`)."""
        if not text:
            return []
        if not self.plain:
            text = text.replace(" ", SPACE)
            text = SPACE + text if self.dummy_prefix else text
            return _WORD.findall(text) if self.parted else [text]
        if SPACE not in text:
            words = text.split(" ")
            if "" not in words:  # one blank before each word but the first, which gets its symbol too
                return words
        return [w if w[1:2] in ("", SPACE) else w[1:] for w in _WORD.findall(SPACE + text.replace(" ", SPACE))]

    def whole(self, word: str) -> str:
        """A word of :meth:`words` with its space symbol."""
        return SPACE + word if self.plain and word[0] != SPACE else word

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and each word's first (one more entry than words)."""
        text = "".join(words)
        code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        n = len(code)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        at = np.minimum(np.searchsorted(self.letter, code), len(self.letter) - 1)
        symbol = np.where(self.letter[at] == code, self.letter_id[at], self.size + code)
        # segments: words cut further where two characters stand side by side in no piece
        key = code[:-1] << 21 | code[1:]
        near = np.minimum(np.searchsorted(self.inside, key), len(self.inside) - 1)
        joined = (self.inside[near] == key) & (word[1:] == word[:-1])
        segment = np.concatenate(([0], np.cumsum(~joined))) if n else np.zeros(0, np.int64)
        symbol, kept = self._rounds(symbol, segment)
        return self._with_bytes(symbol, word[kept], len(words))

    def _rounds(self, symbol: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, and the place where each began."""
        n = len(symbol)
        out, last = symbol.copy(), np.ones(n, dtype=bool)
        place = np.arange(n)
        made = self._pairs(symbol, segment)
        while n:
            rank = np.where(made >= 0, self.rank[made], _NONE)
            begins = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            size = np.diff(np.append(begins, len(segment)))
            best = np.minimum.reduceat(rank, begins)
            best_here = np.repeat(best, size)
            # words without a pair are done
            done = best_here == _NONE
            if done.any():
                out[place[done]] = symbol[done]
                go = ~done
                if not go.any():
                    break
                symbol, segment, place, made, rank, best_here = (x[go] for x in (symbol, segment, place, made, rank, best_here))
                live = best != _NONE
                size = size[live]
                begins = np.cumsum(size) - size
            hit = rank == best_here
            spot = np.flatnonzero(hit)
            # of pairs that overlap, every other one counted from the left
            run = np.concatenate(([True], (spot[1:] != spot[:-1] + 1) | (segment[spot[1:]] != segment[spot[:-1]])))
            nth = np.arange(len(spot)) - np.maximum.accumulate(np.where(run, np.arange(len(spot)), 0))
            first = np.concatenate(([True], segment[spot[1:]] != segment[spot[:-1]]))
            risky = self.order_matters[made[spot]]
            # one risky pair makes its whole word go one by one
            of_word = np.cumsum(first) - 1
            careful = np.maximum.reduceat(risky.astype(np.int8), np.flatnonzero(first)).astype(bool)[of_word]
            take = np.where(careful, first, nth % 2 == 0)
            slow = careful & first & (np.repeat(size, 1)[of_word] > LONG)
            if slow.any():
                gone = np.zeros(len(symbol), dtype=bool)
                for w in of_word[slow].tolist():
                    a, z = int(begins[w]), int(begins[w] + size[w])
                    ends, own = self._one_by_one(symbol[a:z].tolist())
                    last[place[a:z]] = False
                    last[place[a:z][ends]] = True
                    out[place[a:z][ends]] = own
                    gone[a:z] = True
                take &= ~gone[spot]
            spot = spot[take]
            symbol[spot] = made[spot]
            lost = np.zeros(len(symbol), dtype=bool)
            lost[spot + 1] = True
            last[place[lost]] = False
            if slow.any():
                lost |= gone
            stay = ~lost
            changed = np.zeros(len(symbol), dtype=bool)
            changed[spot] = True
            symbol, segment, place, made, changed = (x[stay] for x in (symbol, segment, place, made, changed))
            if not len(symbol):
                break
            # only pairs with a new symbol are looked up again
            again = changed.copy()
            again[:-1] |= changed[1:]
            again = np.flatnonzero(again)
            right = np.minimum(again + 1, len(symbol) - 1)
            pair = self.merged(symbol[again], symbol[right])
            made[again] = np.where((again + 1 < len(symbol)) & (segment[again] == segment[right]), pair, -1)
        kept = np.flatnonzero(last)
        return out[kept], kept

    def _pairs(self, symbol: np.ndarray, segment: np.ndarray) -> np.ndarray:
        made = np.full(len(symbol), -1, dtype=np.int64)
        if len(symbol) > 1:
            made[:-1] = np.where(segment[1:] == segment[:-1], self.merged(symbol[:-1], symbol[1:]), -1)
        return made

    def _one_by_one(self, symbol: list[int]) -> tuple[list[int], list[int]]:
        """Places and symbols of one word after merges in order of rank and place, through a heap."""
        n = len(symbol)
        right, left = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int]] = []
        pieces: dict[tuple[int, int], int] = {}

        def offer(i: int) -> None:
            j = right[i]
            if j < n:
                pair = symbol[i], symbol[j]
                if pair not in pieces:
                    pieces[pair] = int(self.merged(np.array([pair[0]]), np.array([pair[1]]))[0])
                if pieces[pair] >= 0:
                    heapq.heappush(heap, (int(self.rank[pieces[pair]]), i, *pair))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i] if symbol[i] == a else n
            if j >= n or symbol[j] != b:
                continue
            symbol[i], symbol[j] = pieces[a, b], -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        ends = [i for i in range(n) if symbol[i] >= 0]
        return ends, [symbol[i] for i in ends]

    def _with_bytes(self, symbol: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols as ids, those that are no piece as the ids of their bytes; and each word's first id."""
        strange = np.flatnonzero(symbol >= self.size)
        if len(strange):
            count = np.ones(len(symbol), dtype=np.int64)
            code = symbol[strange] - self.size
            count[strange] = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
            raw = np.frombuffer("".join(map(chr, code.tolist())).encode(), dtype=np.uint8)
            start = np.cumsum(count) - count
            out = np.repeat(symbol, count)
            of = np.repeat(start[strange], count[strange])
            nth = np.arange(len(raw)) - np.repeat(np.cumsum(count[strange]) - count[strange], count[strange])
            out[of + nth] = self.byte_id[raw]
            word = np.repeat(word, count)
        else:
            out = symbol
        return out.astype(np.int32), np.searchsorted(word, np.arange(n_words + 1))

    # --- decoding ---------------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """Texts of flat ids; ``at`` has each text's first id and the end."""
        length = self.length[ids]
        end = np.concatenate(([0], np.cumsum(length)))
        inner = np.arange(end[-1]) - np.repeat(end[:-1], length)
        raw = self.bytes[np.repeat(self.first[ids], length) + inner].tobytes()
        out = []
        for first, last in zip(at[:-1].tolist(), at[1:].tolist()):
            skip = 0
            if first < last and self.dummy_prefix:
                # control pieces in front have no text; the leading space symbol goes
                k = first
                while k < last and not self.is_byte[ids[k]] and not length[k]:
                    k += 1
                skip = int(k < last and self.leads[ids[k]])
            own = raw[end[first] + skip:end[last]]
            try:
                out.append(own.decode())
            except UnicodeDecodeError:
                out.append(own.decode(errors=_BYTEWISE))
        return out


_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_BYTEWISE = "replace-each-byte"
codecs.register_error(_BYTEWISE, lambda e: ("�", e.start + 1))


@functools.lru_cache(maxsize=2)
def pieces_of(model: bytes) -> Pieces:
    """One set of tables for each model and Python worker."""
    return Pieces(model)


_KEPT: dict[int, dict[str, bytes]] = {}


def encode_texts(model: bytes, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all texts, and each text's first (one more entry than texts)."""
    pieces = pieces_of(model)
    kept = _KEPT.setdefault(id(pieces), {})
    if len(kept) > WORDS_KEPT:
        kept.clear()
    words: list[str] = []
    ends = [0]
    for text in texts:
        words += pieces.words(text or "")
        ends.append(len(words))
    coded = list(map(kept.get, words))
    if None in coded:
        lacking = [k for k, c in enumerate(coded) if c is None]
        new = list(dict.fromkeys([words[k] for k in lacking]))
        ids, at = pieces.encode_words([pieces.whole(w) for w in new])
        raw, step = ids.tobytes(), (at * 4).tolist()
        kept.update((w, raw[a:z]) for w, a, z in zip(new, step, step[1:]))
        for k in lacking:
            coded[k] = kept[words[k]]
    raw = [b"".join(coded[a:z]) for a, z in zip(ends, ends[1:])]
    return np.frombuffer(b"".join(raw), dtype=np.int32), np.cumsum([0, *(len(r) // 4 for r in raw)])


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))


def encoded(docs: DataFrame, model: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` for every row: the text's piece ids, without begin or end ids. ``model``: the model file's bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(*encode_texts(model, batch.column("text").to_pylist()))], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decoded(rows: DataFrame, model: bytes, *, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the text of their ids."""
    names = rows.columns
    if "decoded" in names:
        raise ValueError("the rows already have a column decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            lists = batch.column(names.index(ids_col))
            length = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            texts = pieces.decode(ids, np.concatenate(([0], np.cumsum(length))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, decoded string")


def public_model() -> bytes:
    """The public model's file (under a megabyte); it travels with the tasks that use it."""
    import public_tokenizers as public
    with open(public.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def op13_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_model()
    rows = decoded(encoded(read_table(spark, sf_dir, "documents"), model), model)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
