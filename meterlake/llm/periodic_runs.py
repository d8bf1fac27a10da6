"""Periodic runs of words, found by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period ``q`` and a length of at least
``max(min_length, min_exponent * q)`` that neither neighbour extends. Words are runs of bytes other than
space and ``\\x09-\\x0D``, compared exactly.

Every appended word adds a state to the suffix automaton of the words so far. The suffix-link path from
that state to the root is cut into segments of states that last occurred at the same earlier place; a
link-cut tree holds each segment as one splay tree with that place. Access to the new state walks the
segments and recolours the whole path. A segment whose longest string has ``length`` words and last
occurred ``q`` words before repeats them at distance ``q``: with ``length >= q`` it is a square, and with the
``q`` words before it a stretch of ``length + q`` words of smallest period ``q`` (a nearer occurrence would have
given the segment its colour). It is a run where the next word does not go on.

Where a run ends, every word after its first ``q`` has occurred at most ``q`` words before, for at least
``(min_exponent - 1) * q`` words. Stretches that meet this for some power of two above ``q`` are found by
array operations over a whole batch; each of them, with the words before it that a run can hold, is then
read by the automaton, and no run lies elsewhere. Memory grows with the longest text, about 150 bytes a word,
and some 500 bytes for each word of such a stretch.

Cases: a null, empty or blank text has no words, no runs and an empty collapsed text; repeated rows are
handled row by row; a null id stays null (and is never edited); an empty table gives an empty result;
other input columns are not read.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_batches

MIN_LENGTH, MIN_EXPONENT = 6, 4
_FAR = np.int64(1) << 40


def squares(words: list[int], first: int, last: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """``end, q, length`` of every segment met while ``words[first:last]`` are appended one by one, whose longest string
    of ``length >= (min_exponent - 1) * q`` words ends at ``end`` and last ended ``q`` words before."""
    # state 1 is the empty string; 0 stands for none
    step: list[dict[int, int]] = [{}, {}]
    link, size = [0, 0], [0, 0]
    # link-cut tree: children in a segment's splay tree (the shorter strings are left), parent, and at a
    # splay tree's root the end of the segment's last occurrence
    left, right, above, seen = [0, 0], [0, 0], [0, 0], [-1, -1]
    times = min_exponent - 1

    def splay(x: int) -> None:
        y = above[x]
        if not y or (left[y] != x and right[y] != x):
            return
        while y and (left[y] == x or right[y] == x):
            z = above[y]
            if z and (left[z] == y or right[z] == y):
                if (left[z] == y) == (left[y] == x):  # y goes up first
                    g = above[z]
                    if left[z] == y:
                        left[z] = c = right[y]
                        right[y] = z
                    else:
                        right[z] = c = left[y]
                        left[y] = z
                    if c:
                        above[c] = z
                    above[z], above[y] = y, g
                    if left[g] == z and g:
                        left[g] = y
                    elif right[g] == z and g:
                        right[g] = y
                    else:
                        seen[y] = seen[z]
                else:
                    _turn(x, y)
            y = above[x]
            _turn(x, y)
            y = above[x]

    def _turn(x: int, y: int) -> None:
        """x, a child of y in one splay tree, takes y's place."""
        g = above[y]
        if left[y] == x:
            left[y] = c = right[x]
            right[x] = y
        else:
            right[y] = c = left[x]
            left[x] = y
        if c:
            above[c] = y
        above[y], above[x] = x, g
        if g and left[g] == y:
            left[g] = x
        elif g and right[g] == y:
            right[g] = x
        else:
            seen[x] = seen[y]

    tail = 1
    for i in range(first, last):
        word = words[i]
        new = len(step)
        step.append({})
        link.append(1)
        size.append(size[tail] + 1)
        left.append(0)
        right.append(0)
        above.append(1)
        seen.append(-1)
        p = tail
        while p and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p:
            q = step[p][word]
            if size[q] == size[p] + 1:
                link[new] = above[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                splay(q)
                # the copy has occurred wherever q has: it goes into q's segment, just above q
                left.append(left[q])
                right.append(0)
                above.append(q)
                seen.append(-1)
                if left[q]:
                    above[left[q]] = copy
                left[q] = copy
                while p and step[p].get(word) == q:
                    step[p][word] = copy
                    p = link[p]
                link[q] = copy
                link[new] = above[new] = copy
        tail = new
        # access: from the new state to the root, segment by segment
        below, x = 0, new
        while x:
            splay(x)
            end = seen[x]
            if end >= 0 and size[x] >= times * (i - end):
                yield i, i - end, size[x]
            cut = right[x]
            if cut:
                seen[cut] = end
            right[x] = below
            below, x = x, above[x]
        seen[below] = i


def earlier(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Distance of every word to its last occurrence before in the same text; ``_FAR`` without one."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    out = np.full(n, _FAR, dtype=np.int64)
    out[order[1:][same]] = (order[1:] - order[:-1])[same]
    place = np.arange(n)
    count = np.diff(np.append(starts, n))
    return np.where(place - out >= np.repeat(starts, count), out, _FAR)


def stretches(distance: np.ndarray, starts: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Disjoint ranges of places, none over two texts, that together hold every run."""
    found, n, reach = [], len(distance), 1
    while reach <= max(n, 1):
        near = np.concatenate(([False], distance <= reach, [False]))
        edge = np.flatnonzero(near[1:] != near[:-1])
        a, z = edge[::2], edge[1::2]
        least = max((min_exponent - 1) * (reach // 2 + 1), min_length - reach)  # periods above reach / 2
        enough = z - a >= least
        a, z = a[enough], z[enough]
        if len(a):
            text = starts[np.searchsorted(starts, a, side="right") - 1]
            found.append(np.stack([np.maximum(a - reach, text), z], axis=1))
        reach *= 2
    if not found:
        return []
    ranges = np.concatenate(found)
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    out: list[list[int]] = []
    for a, z in ranges.tolist():
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def runs_of(ids: np.ndarray, starts: np.ndarray, min_length: int = MIN_LENGTH,
            min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs of texts laid end to end, by start and period. ``starts`` has the first
    place of each text that has words."""
    out: list[tuple[int, int, int]] = []
    begins = set(starts.tolist())
    for first, last in stretches(earlier(ids, starts), starts, min_length, min_exponent):
        words = ids[first:last].tolist()
        n = last - first
        following = int(ids[last]) if last < len(ids) and last not in begins else -1
        for end, q, length in squares(words, 0, n, min_exponent):
            if length + q < min_length:
                continue
            after = words[end + 1] if end + 1 < n else following
            if after != words[end + 1 - q]:
                out.append((first + end + 1 - length - q, length + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of ``n`` words stays: none does that a run holds after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None


def planted(n: int, doc_id) -> np.ndarray | None:
    """Order of the words of a document that gets a periodic tail; None if it stays as it is."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, *, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
                  edit: Callable[[int, object], np.ndarray | None] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, runs, best, collapsed`` for every row: all runs by start and period, the strongest one (null without runs),
    and the text without the repetitions, its words joined by one space. ``edit`` gives a new order of a text's words
    by their number and the row's id."""
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 or more")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            keys = batch.column("id").to_pylist()
            words, count = [], []
            for key, text in zip(keys, texts):
                own = (text or b"").split()
                order = edit(len(own), key) if edit else None
                words += own if order is None else [own[j] for j in order.tolist()]
                count.append(len(own))
            number = {w: k for k, w in enumerate(dict.fromkeys(words))}
            ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
            ends = np.cumsum(count)
            starts = ends - count
            found = runs_of(ids, starts[np.array(count) > 0], min_length, min_exponent)
            at = np.searchsorted([r[0] for r in found], starts)
            runs, best, short = [], [], []
            for k, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
                own = [(s - start, n, q) for s, n, q in found[at[k]:(at[k + 1] if k + 1 < len(at) else len(found))]]
                kept = words[start:end]
                if own:
                    stays = collapsed(end - start, own)
                    kept = [w for w, stay in zip(kept, stays.tolist()) if stay]
                top = strongest(own)
                runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                best.append(dict(zip(("start", "length", "period"), top)) if top else None)
                short.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(runs, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(short, pa.binary()).cast(pa.string())],
                names=[id_col, "runs", "best", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(find, f"`{id_col}` {kind}, runs {RUNS}, best {RUNS[6:-1]}, collapsed string")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(read_table(spark, sf_dir, "documents"), edit=planted)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                  r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
