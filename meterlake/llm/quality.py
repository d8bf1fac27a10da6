"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or not at all on every document. Expectation-maximisation
over the counts of all vote patterns (at most 3 to the number of labellers, whatever the number of
documents) estimates for each labeller how often it votes, and how often it is right, on good and on bad
documents, without any given label. The posterior of a document's pattern is its soft label. Soft labels
of a bounded sample train a linear scorer over hashed words and binned statistics by logistic regression,
whose gradients the partitions sum up; the scorer then judges every whole document.

The sample is the different texts whose hash falls below ``train_docs`` / all different texts: about that many, the
same ones whatever the partitions, and a text with many copies counts once. A document is rejected when its score is below ``threshold``.

Cases: a null text, or one without words, has score 0 and is rejected; repeated rows are judged row by
row, and alike; an empty table gives an empty result; other input columns are not read by the scorer and
are returned unchanged by the filter.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import read_table, stored, text_batches
from .fingerprints import ANCHORS

TRAIN_DOCS = 8_000
HASH_BITS = 14
EPOCHS = 25
THRESHOLD = 0.5
ABSTAIN, BAD, GOOD = 0, 1, 2

#: (statistic, bad from, good up to, kind of fault); between the two the labeller abstains. Labellers of
#: one kind overlap, so that one that errs alone is outvoted.
LABELLERS = (
    ("symbols", 0.05, 0.02, 0),
    ("unlettered", 0.25, 0.22, 0),
    ("marked", 0.10, 0.02, 0),
    ("capitals", 0.20, 0.08, 1),
    ("shouted", 0.15, 0.02, 1),
    ("repeated", 0.60, 0.45, 2),
    ("stuttered", 0.15, 0.03, 2),
    ("cycling", 0.40, 0.20, 2),
    ("same_lines", 0.35, 0.25, 2),
    ("uncommon", 0.94, 0.88, 3),
    ("unended", 0.97, 0.95, 3),
    ("barred", 0.08, 0.01, 3),
)
KINDS = 1 + max(kind for *_, kind in LABELLERS)
STATISTICS = tuple(name for name, *_ in LABELLERS)
_STOP = np.unique(np.array([ta.word_hash(a.encode()) for a in ANCHORS], dtype=np.uint64))
_SYMBOL = np.array([33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"-()" for b in range(256)])
_CAPITAL = np.array([65 <= b <= 90 for b in range(256)])
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_ENDING = np.array([chr(b) in ".,;:?" for b in range(256)])
_BAR = np.array([chr(b) in "|\t" for b in range(256)])
_LINE_END = np.array([b in (10, 13) for b in range(256)])


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _doubled(flags: np.ndarray) -> np.ndarray:
    """Bytes that have the flag and follow one that has it."""
    out = flags.copy()
    out[1:] &= flags[:-1]
    out[:1] = False
    return out


def _repeats(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Share of entries of each text that equal an earlier one."""
    count = np.diff(at)
    _, text = ta.distinct(values, np.repeat(np.arange(len(count)), count))
    return 1 - np.bincount(text, minlength=len(count)) / np.maximum(count, 1)


def described(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of texts: first and end text, statistics (texts x labellers), word hashes, and each
    text's first word."""
    offsets, data = ta.buffers(texts)
    for first, last in ta.slices(offsets):
        own = offsets[first:last + 1] - offsets[first]
        part = data[offsets[first]:offsets[last]]
        starts, stops, text = ta.word_bounds(part, own, ta.PUNCTUATION)
        hashes = ta.word_hashes(part, starts, stops)
        at = np.searchsorted(text, np.arange(last - first + 1))
        count, size = np.maximum(np.diff(at), 1), np.maximum(np.diff(own), 1)
        l_starts, l_stops, l_text = ta.word_bounds(part, own, _LINE_END)
        l_at = np.searchsorted(l_text, np.arange(last - first + 1))
        same = np.zeros(len(hashes), dtype=bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
        symbol, capital = _SYMBOL[part], _CAPITAL[part]
        pairs = ta.mix(hashes[:-1] * np.uint64(31) + hashes[1:])[text[1:] == text[:-1]] if len(hashes) else hashes
        pair_text = text[1:][text[1:] == text[:-1]]
        pair_at = np.searchsorted(pair_text, np.arange(last - first + 1))
        stats = np.stack([
            _per_text(symbol, own) / size,
            1 - _per_text(_LETTER[part], own) / size,
            _per_text(_doubled(symbol), own) / count,
            _per_text(capital, own) / size,
            _per_text(_doubled(capital), own) / size,
            _repeats(hashes, at),
            np.bincount(text[same], minlength=last - first) / count,
            _repeats(pairs, pair_at),
            _repeats(ta.word_hashes(part, l_starts, l_stops), l_at),
            1 - np.bincount(text[np.isin(hashes, _STOP)], minlength=last - first) / count,
            np.maximum(1 - _per_text(_ENDING[part], own) / count, 0),
            _per_text(_BAR[part], own) / count,
        ], axis=1)
        yield first, last, stats, hashes, at


def votes(stats: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Votes of all labellers as one number, in base 3. Texts of under ten words get no vote."""
    code = np.zeros(len(stats), dtype=np.int64)
    for i, (_, bad, good, _) in enumerate(LABELLERS):
        vote = np.where(stats[:, i] >= bad, BAD, np.where(stats[:, i] <= good, GOOD, ABSTAIN))
        code = code * 3 + np.where(n_words < 10, ABSTAIN, vote)
    return code


def _unpacked(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes // 3 ** (len(LABELLERS) - 1 - i) % 3 for i in range(len(LABELLERS))], axis=1)


@dataclass(frozen=True)
class LabelModel:
    """``prior[c]`` of each class, good and then one for each kind of fault; ``rates[c, l, v]``: probability
    that labeller l votes v on a document of class c."""

    prior: np.ndarray
    rates: np.ndarray

    def classes(self, codes: np.ndarray) -> np.ndarray:
        v = _unpacked(np.asarray(codes))
        log = np.stack([np.log(p) + np.log(r)[np.arange(v.shape[1]), v].sum(axis=1) for p, r in zip(self.prior, self.rates)])
        weight = np.exp(log - log.max(axis=0))
        return np.where((v == ABSTAIN).all(axis=1), self.prior[:, None], weight / weight.sum(axis=0))

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is good."""
        return self.classes(codes)[0]


def estimate(codes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> LabelModel:
    """Expectation-maximisation. At first a document has the fault of which more than half the labellers speak,
    or else is good. Rates are smoothed by one vote."""
    codes, counts = codes[codes > 0], counts[codes > 0].astype(np.float64)  # 0: nobody votes
    v = _unpacked(codes)
    kinds = np.array([kind for *_, kind in LABELLERS])
    said = np.stack([(v[:, kinds == k] == BAD).mean(axis=1) for k in range(KINDS)])
    start = np.where(said.max(axis=0) > 0.5, said.argmax(axis=0) + 1, 0)
    share = (np.arange(KINDS + 1)[:, None] == start) * 0.9 + 0.1 / (KINDS + 1)
    for _ in range(rounds):
        weight = share * counts
        rates = np.stack([[np.bincount(v[:, i], weights=w, minlength=3) + 1 for i in range(v.shape[1])] for w in weight])
        prior = weight.sum(axis=1) + 1
        model = LabelModel(prior / prior.sum(), rates / rates.sum(axis=2, keepdims=True))
        share = model.classes(codes)
    return model


def features(stats: np.ndarray, hashes: np.ndarray, at: np.ndarray, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, weights and text of each feature: words by hash, weighted to one in all, and one bucket
    for each statistic's bin, which counts for less in a text of under twenty words."""
    n, count = len(stats), np.diff(at)
    text = np.repeat(np.arange(n), count)
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    weight = 1 / np.maximum(count, 1)[text]
    bins = np.minimum((stats * 25).astype(np.int64), 24)
    binned = ta.mix((np.arange(stats.shape[1]) * 25 + bins).astype(np.uint64) + np.uint64(1 << 40)) >> np.uint64(64 - bits)
    return (np.concatenate([bucket, binned.astype(np.int64).ravel()]), np.concatenate([weight, np.repeat(0.5 * np.minimum(count / 20, 1), stats.shape[1])]),
            np.concatenate([text, np.repeat(np.arange(n), stats.shape[1])]))


def vote_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``votes, n`` over all documents: each task sums up its own patterns first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in text_batches(batches, text_col):
            for _, _, stats, _, at in described(ta.utf8(batch.column(0))):
                for code, n in zip(*np.unique(votes(stats, np.diff(at)), return_counts=True)):
                    total[int(code)] = total.get(int(code), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
                                         names=["votes", "n"])

    return docs.select(text_col).mapInArrow(run, "votes bigint, n bigint").groupBy("votes").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, *, text_col: str = "text", train_docs: int = TRAIN_DOCS, epochs: int = EPOCHS,
          bits: int = HASH_BITS) -> tuple[LabelModel, np.ndarray]:
    """The label model of all documents, and the scorer's weights; the last weight is its intercept."""
    patterns = vote_counts(docs, text_col).collect()
    codes, counts = np.array([r.votes for r in patterns], dtype=np.int64), np.array([r.n for r in patterns], dtype=np.int64)
    dims = (1 << bits) + 1
    if not len(codes):
        return LabelModel(np.full(KINDS + 1, 1 / (KINDS + 1)), np.full((KINDS + 1, len(LABELLERS), 3), 1 / 3)), np.zeros(dims)
    model = estimate(codes, counts)
    texts = docs.select(text_col, F.xxhash64(text_col, F.length(text_col)).alias("digest"))
    share = min(1.0, train_docs / max(texts.agg(F.approx_count_distinct("digest", 0.02)).first()[0], 1))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()  # of the sample, which is bounded
        for batch in text_batches(batches, text_col):
            batch = batch.take(pa.array([i for i, d in enumerate(batch.column(1).to_pylist()) if d not in met and not met.add(d)], pa.int64()))
            if not batch.num_rows:
                continue
            digests = batch.column(1).to_numpy()
            for first, last, stats, hashes, at in described(ta.utf8(batch.column(0))):
                code = votes(stats, np.diff(at))
                voted = (code > 0) & (np.diff(at) > 0)
                bucket, weight, text = features(stats, hashes, at, bits)
                order = np.argsort(text, kind="stable")
                cuts = np.searchsorted(text[order], np.arange(len(stats) + 1))
                bucket, weight = bucket[order].astype("<i4"), weight[order].astype("<f4")
                rows = np.flatnonzero(voted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket[cuts[i]:cuts[i + 1]].tobytes() for i in rows], pa.binary()),
                     pa.array([weight[cuts[i]:cuts[i + 1]].tobytes() for i in rows], pa.binary()),
                     pa.array(model.posterior(code)[rows], pa.float64()), pa.array(digests[first:last][rows])],
                    names=["bucket", "weight", "good", "digest"])

    chosen = F.pmod("digest", F.lit(1 << 30)) < share * (1 << 30)
    sample = stored(texts.filter(chosen).mapInArrow(featured, "bucket binary, weight binary, good double, digest bigint")
                    .dropDuplicates(["digest"]).drop("digest").repartition(8), "quality-sample")
    weights, squares = np.zeros(dims), np.full(dims, 1e-6)
    for _ in range(epochs):
        gradient, n = _gradient(sample, weights)
        if not n:
            break
        gradient = gradient / n + 1e-5 * np.append(weights[:-1], 0)
        squares += gradient ** 2
        weights = weights - gradient / np.sqrt(squares)
    return model, weights


def _gradient(sample: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, int]:
    """The logistic loss's gradient over the sample, summed up in each partition first."""
    dims = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [[np.frombuffer(b, t) for b in batch.column(c).to_pylist()] for c, t in ((0, "<i4"), (1, "<f4"))]
            text = np.repeat(np.arange(batch.num_rows), [len(p) for p in parts[0]])
            bucket, weight = (np.concatenate(p) for p in parts)
            error = _logistic(weights, bucket, weight, text, batch.num_rows) - batch.column(2).to_numpy()
            total[:-1] += np.bincount(bucket, weights=weight * error[text], minlength=dims - 1)
            total[-1] += error.sum()
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["g", "n"])

    parts = sample.mapInArrow(run, "g binary, n bigint").collect()  # one row of a fixed size for each of a few partitions
    return sum((np.frombuffer(p.g) for p in parts), np.zeros(dims)), sum(p.n for p in parts)


def _logistic(weights: np.ndarray, bucket: np.ndarray, weight: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.bincount(text, weights=weights[bucket] * weight, minlength=n) + weights[-1], -500, 500)))


def _scores(texts: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score and votes of each text."""
    scores, codes = [np.zeros(0)], [np.zeros(0, np.int64)]
    bits = (len(weights) - 1).bit_length() - 1
    for _, _, stats, hashes, at in described(texts):
        score = _logistic(weights, *features(stats, hashes, at, bits), len(stats))
        scores.append(np.where(np.diff(at) > 0, score, 0.0))
        codes.append(votes(stats, np.diff(at)))
    return np.concatenate(scores), np.concatenate(codes)


def scored(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """``id, score, weak_label, keep`` for every row; ``weak_label`` is the label model's own posterior."""
    model, weights = train(docs, text_col=text_col, **options)
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, scorer = shared.value
        for batch in text_batches(batches, text_col):
            score, code = _scores(ta.utf8(batch.column(1)), scorer)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(labels.posterior(code)), pa.array(score >= threshold)],
                names=[id_col, "score", "weak_label", "keep"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double, weak_label double, keep boolean")


def kept(docs: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that the scorer accepts, with all their columns."""
    _, weights = train(docs, text_col=text_col, **options)
    shared, place = docs.sparkSession.sparkContext.broadcast(weights), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, text_col):
            score, _ = _scores(ta.utf8(batch.column(place)), shared.value)
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read_table(spark, sf_dir, "documents"))
