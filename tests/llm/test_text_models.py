"""Quality, language and language-model scoring."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from meterlake.llm import hmm_scoring, language_id, quality
from tests.conftest import SF_MID, SF_SMALL

from .helpers import words


# ---- quality ----

def test_label_model_recovers_planted_reliabilities():
    rng = np.random.default_rng(0)
    n, labellers = 40_000, len(quality.LABELLERS)
    kinds = np.array([k for *_, k in quality.LABELLERS])
    truth = rng.choice(quality.KINDS + 1, n, p=[0.8] + [0.2 / quality.KINDS] * quality.KINDS)
    bad = (truth[:, None] == kinds + 1) & (rng.random((n, labellers)) < 0.9) | (rng.random((n, labellers)) < 0.02)
    vote = np.where(rng.random((n, labellers)) < 0.1, quality.ABSTAIN, np.where(bad, quality.BAD, quality.GOOD))
    codes = (vote * 3 ** np.arange(labellers)[::-1]).sum(axis=1)
    patterns, counts = np.unique(codes, return_counts=True)
    model = quality.estimate(patterns, counts)
    assert abs(model.prior[0] - 0.8) < 0.03
    assert ((model.posterior(codes) >= 0.5) == (truth == 0)).mean() > 0.97
    assert abs(model.rates[0, 0, quality.BAD] - 0.018) < 0.01


def test_scores_agree_with_labels_never_seen(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scored(docs).join(labels, "doc_id").collect()
    assert sum(r.keep == (r.quality == 1) for r in rows) / len(rows) > 0.98
    assert sum(r.keep for r in rows if r.quality == 1) / sum(r.quality for r in rows) > 0.99


def test_quality_of_awkward_tables(spark, awkward, empty):
    rows = quality.scored(awkward).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and not r.keep for r in rows if r.doc_id in (1, 2, 3))
    same = [r.score for r in rows if r.doc_id == 10]
    assert len(same) == 2 and same[0] == same[1]
    kept = quality.kept(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r.keep for r in rows)
    assert quality.scored(empty).count() == 0 and quality.kept(empty).count() == 0


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    one, many = ({r.doc_id: r.score for r in quality.scored(d, epochs=3).collect()} for d in (docs, docs.repartition(7)))
    assert max(abs(one[k] - many[k]) for k in one) < 1e-6


def test_the_sample_counts_a_text_once(spark, monkeypatch):
    rows = [(i, f"The story of {i} and of the other one is told, in the end, by a child of the house. " * 3) for i in range(40)]
    sizes = []
    monkeypatch.setattr(quality, "_gradient", lambda sample, weights: (sizes.append(sample.count()), (np.zeros(len(weights)), 0))[1])
    for copies in (1, 60):
        docs = spark.createDataFrame(rows + rows[:1] * (copies - 1) + [(-1, None)], "doc_id long, text string").repartition(5)
        quality.train(docs)
    assert sizes[0] == sizes[1] == 40


# ---- language ----

def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = language_id.op7_language_id(spark, SF_MID).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_dictionaries_equal_those_of_whole_texts(spark):
    """Only as much text as a dictionary holds comes to the driver; the dictionaries are those of all ranked texts."""
    rng, size = np.random.default_rng(3), 3_000
    rows = [(lang, " ".join("".join(rng.choice(list("abcdefé"), 5)) for _ in range(n))) for lang in ("x", "y") for n in [8] * 30 + [9_000] * 3]
    texts = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    ranked = texts.selectExpr("lang", "text", "xxhash64(text) AS place").collect()
    want = {}
    for lang in ("x", "y"):
        own = sorted((r for r in ranked if r.lang == lang), key=lambda r: (len(r.text.encode()) > size // 8, r.place))
        want[lang] = b"".join(r.text.encode() + b" " for r in own)[:size]
    assert dict(language_id.train(texts, dictionary_bytes=size)) == want


def test_language_of_awkward_tables(spark, awkward, empty):
    models = language_id.train(awkward)
    assert {name for name, _ in models} == {"en", "fr", "de"} and models[0][0] == "en"
    rows = {r.doc_id: r for r in language_id.predict(awkward, models).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 and rows[i].rejected for i in (1, 2, 3, 6, ))
    assert rows[8].lang_pred == "en" and rows[5].lang_pred == "fr"
    assert {r.lang_pred for r in language_id.predict(awkward, []).collect()} == {"und"}
    assert language_id.train(empty) == [] and language_id.predict(empty, models).count() == 0


def test_a_language_of_copies_still_has_a_dictionary(spark):
    copy = "ein sehr langer deutscher satz der immer wieder kommt"
    rows = [("de", copy)] * 3000 + [("de", f"noch ein anderer satz nummer {i}") for i in "abcdefgh"] + [("en", f"some words {i}") for i in "xyz"]
    models = dict(language_id.train(spark.createDataFrame(rows, "lang string, text string"), sample_docs=5))
    assert set(models) == {"de", "en"} and models["de"].count(b"satz") == 5


def test_every_language_value_is_learned(spark, monkeypatch):
    from .helpers import prose
    letters = "abcdefghijklmnopqrst"
    own = {f"l{i:03d}": f"{letters[i // 20]}{letters[i % 20]}q" for i in range(150)}
    rows = [(lang, " ".join(w + tail for w in prose(k, 30).replace(".", "").split())) for lang, tail in own.items()
            for k in range(3 if lang < "l140" else 2)]
    texts = spark.createDataFrame(rows, "lang string, text string")
    models = language_id.train(texts)
    assert {name for name, _ in models} == set(own)
    rare = [row for row in rows if row[0] >= "l140"]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rare)], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, models).collect()}
    assert [got[i] for i in range(len(rare))] == [lang for lang, _ in rare]
    monkeypatch.setattr(language_id, "MODEL_BYTES", 150 * 300)
    small = language_id.train(texts)
    assert {name for name, _ in small} == set(own) and sum(len(d) for _, d in small) <= 150 * 300


# ---- language-model scoring ----

def _base(docs, held):
    tokens = {d.doc_id: [*words(d.text), None] for d in docs}
    count = Counter(w for k, t in tokens.items() if not held(k) for w in t)
    total, distinct = sum(count.values()), len(count)
    return {k: (len(t), sum(count[w] > 0 for w in t), total,
                sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t)) for k, t in tokens.items()}


@pytest.mark.parametrize("frequent", [50, 65_000])
def test_base_scores_equal_plain_python(spark, frequent):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    from pyspark.sql import functions as F

    from meterlake.llm.common import crc_mod
    rows = hmm_scoring.scores(docs, crc_mod(F.col("doc_id"), 10) == 0, states=3, rounds=2, frequent=frequent).collect()
    want = _base(docs.collect(), lambda k: zlib.crc32(str(k).encode()) % 10 == 0)
    assert len(rows) == len(want)
    for r in rows:
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.score < 0


def _model(k, symbols, seed):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm_scoring.Model(norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((symbols, k)), 0))


def _paths(model, symbols):
    """Probability of a sequence and expected counts, over all state paths."""
    from itertools import product
    k, total = len(model.start), 0.0
    start, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros(model.emits.shape)
    for path in product(range(k), repeat=len(symbols)):
        p = model.start[path[0]] * model.emits[symbols[0], path[0]]
        for a, b, s in zip(path, path[1:], symbols[1:]):
            p *= model.moves[a, b] * model.emits[s, b]
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
        for s, a in zip(symbols, path):
            emits[s, a] += p
    return total, start / total, moves / total, emits / total


def test_expected_counts_equal_all_paths():
    model, blocks = _model(3, 5, 1), [np.array(b) for b in ([4], [1, 1], [0, 3, 2], [2, 2, 4, 1, 0, 3])]
    start, moves, emits = hmm_scoring.expected(model, blocks, np.array([len(b) for b in blocks]))
    want = [_paths(model, b) for b in blocks]
    for got, i in ((start, 1), (moves, 2), (emits, 3)):
        assert got == pytest.approx(sum(w[i] for w in want), abs=1e-12)


def test_counts_of_long_texts_equal_the_uncut_recursion(monkeypatch):
    """Also of a text of 5,000 symbols, of one that ends at a block's end, and of one that is a block."""
    model, rng = _model(4, 30, 5), np.random.default_rng(6)
    texts = [rng.integers(0, 30, n) for n in (5_000, 1, 40, 512, 256, 257, 3)]
    want = [hmm_scoring.expected(model, [t], np.array([len(t)])) for t in texts]
    for block in (256, 7):
        monkeypatch.setattr(hmm_scoring, "BLOCK", block)
        got = [[s, m, hmm_scoring._summed(symbol, gamma, 30)] for s, m, gamma, symbol, _ in hmm_scoring.whole_texts(model, texts)]
        for i in range(3):
            assert sum(g[i] for g in got) == pytest.approx(sum(w[i] for w in want), rel=1e-9, abs=1e-9)
    assert list(hmm_scoring.whole_texts(model, [])) == []


def test_likelihood_equals_all_paths_and_chunks_equal_steps(monkeypatch):
    model = _model(3, 5, 2)
    sequences = [np.array(s) for s in ([4], [1, 0], [0, 3, 2, 2, 1, 4, 0])]
    at = np.concatenate([[0], np.cumsum([len(s) for s in sequences])])
    got = hmm_scoring.log_likelihoods(model, np.concatenate(sequences), at)
    assert got == pytest.approx([math.log10(_paths(model, s)[0]) for s in sequences])
    long = np.random.default_rng(3).integers(0, 5, 3_001)
    whole = hmm_scoring.log_likelihoods(model, long, np.array([0, len(long)]))
    monkeypatch.setattr(hmm_scoring, "CHUNK", 7)
    monkeypatch.setattr(hmm_scoring, "LONG", 14)
    assert hmm_scoring.log_likelihoods(model, long, np.array([0, len(long)])) == pytest.approx(whole)


def test_training_raises_the_likelihood(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    few, more = (hmm_scoring.scores(docs, F.lit(False), rounds=r, states=4).agg(F.sum("score"), F.sum("base_score")).first() for r in (0, 4))
    assert more[0] > few[0] and more[0] > more[1]


def _plain_scores(texts, held, words_of, states, rounds):
    """Baum-Welch over tokens by plain sums, each token with an emission of its own in each state, and every text's score."""
    import pyarrow as pa
    hashes = {w: next(hmm_scoring._tokens(hmm_scoring.ta.utf8(pa.array([w])))) for t in texts for w in t if w is not None}
    key = lambda w: hmm_scoring.END if w is None else hashes[w][2][0]
    count = Counter(w for t, h in zip(texts, held) if not h for w in t)
    vocabulary = sorted({w for t in texts for w in t}, key=str)
    unigram, first = words_of.unigram(), hmm_scoring.Model.first(words_of.unigram(), states)
    emits, prior = {}, 0.1 / states
    priors = prior * (len(words_of.tokens) + (words_of.class_distinct + 1).sum())
    for w in vocabulary:
        place = np.flatnonzero(words_of.tokens == key(w))
        at = place[0] if len(place) else len(words_of.tokens) + hashes[w][3][0]
        emits[w] = first.emits[at] * (1 if len(place) else (count[w] + 0.1) / words_of.mass / unigram[at])
    start, moves = first.start, first.moves

    def forward(t):
        a = [start * emits[t[0]]]
        for w in t[1:]:
            a.append((a[-1] @ moves) * emits[w])
        return a

    for _ in range(rounds):
        s, m, c = np.full(states, 0.1), np.full((states, states), 0.1), {w: np.zeros(states) for w in vocabulary}
        for t, h in zip(texts, held):
            if not h:
                a, b = forward(t), np.ones(states)
                total = a[-1].sum()
                for i in range(len(t) - 1, -1, -1):
                    c[t[i]] = c[t[i]] + a[i] * b / total
                    if i:
                        m = m + np.outer(a[i - 1], emits[t[i]] * b) * moves / total
                        b = moves @ (emits[t[i]] * b)
                s = s + a[0] * b / total
        room = sum(c.values()) + priors
        start, moves, emits = s / s.sum(), m / m.sum(axis=1, keepdims=True), {w: (c[w] + prior) / room for w in vocabulary}
    return [math.log10(forward(t)[-1].sum()) for t in texts]


@pytest.mark.parametrize("frequent", [3, 1000])
def test_scores_equal_plain_training_over_tokens(spark, monkeypatch, frequent):
    """With rare tokens that one group trains, that several train, that only held-out texts hold, in many buckets."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(11)
    pool = [f"{a}{b}{'x' * int(n)}" for a, b, n in zip("abcdefghijklmnopqrstuvwxyz", "mnopqrmnopqrmnopqrmnopqrmn", rng.integers(0, 4, 26))]
    texts = [[*(pool[min(int(i), 25)] for i in rng.exponential(6, rng.integers(0, 14))), None] for _ in range(40)]
    texts[0] = ["seen", "once", "seen", None]
    texts[5] = ["never", "learned", None]
    held = [i % 5 == 0 and i > 0 for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(w for w in t if w)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    words_of = hmm_scoring.vocabulary(hmm_scoring.token_counts(docs.filter("doc_id % 5 <> 0 OR doc_id = 0").select("text")), frequent)
    monkeypatch.setattr(hmm_scoring, "BUCKET", 5)
    got = hmm_scoring.scores(docs, (F.col("doc_id") % 5 == 0) & (F.col("doc_id") > 0), states=3, rounds=4, frequent=frequent).collect()
    want = _plain_scores(texts, held, words_of, 3, 4)
    assert len(got) == 40
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], rel=2e-4)  # half precision between rounds


def test_tokens_beyond_the_frequent_ones_have_states_of_their_own(spark):
    """Two sorts of text whose words share every class of length and last byte: only the words' own counts tell them apart."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(7)
    sorts = [[f"{a}{i:02d}z" for i in range(40)] for a in "pq"]
    rows = [(i, " ".join(rng.choice(sorts[i % 2], 60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    few, many = (hmm_scoring.scores(docs, F.col("doc_id") % 10 < 2, states=2, rounds=12, frequent=n).filter("held_out")
                 .agg(F.sum("score"), F.sum("base_score")).first() for n in (1, 65_000))
    assert few[0] - few[1] > 0.2 * 40 * 60  # of log10(2) a word, the most that two sorts can give
    assert few[0] == pytest.approx(many[0], rel=0.02)


def test_scores_of_awkward_tables(spark, awkward, empty):
    from pyspark.sql import functions as F
    rows = hmm_scoring.scores(awkward, F.col("doc_id") == 9, states=2, rounds=2).collect()
    assert len(rows) == awkward.count() and sum(r.held_out for r in rows) == 1
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    twice = [r.score for r in rows if r.doc_id == 10]
    assert len(twice) == 2 and twice[0] == pytest.approx(twice[1])
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    unseen = hmm_scoring.scores(awkward, F.lit(True), states=2, rounds=1).collect()
    assert {r.train_tokens for r in unseen} == {0} and {r.n_known for r in unseen} == {0}
    assert all(r.base_score == pytest.approx(0) and math.isfinite(r.score) for r in unseen)
    assert hmm_scoring.scores(empty, F.lit(False), rounds=1).count() == 0


def test_lanes_and_windows_equal_texts_one_by_one(monkeypatch):
    """Many texts in few lanes, windows of few steps: nothing passes from a text to the next one of its lane."""
    model, rng = _model(4, 30, 8), np.random.default_rng(9)
    texts = [rng.integers(0, 30, n) for n in rng.integers(1, 40, 50)]
    want = [hmm_scoring.expected(model, [t], np.array([len(t)])) for t in texts]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    logs = hmm_scoring.log_likelihoods(model, np.concatenate(texts), at)
    for lanes, window in ((3, 8), (7, 1000), (50, 16)):
        monkeypatch.setattr(hmm_scoring, "LANES", lanes)
        monkeypatch.setattr(hmm_scoring, "WINDOW", window)
        got = hmm_scoring.expected(model, texts, np.array([len(t) for t in texts]))
        for i in range(3):
            assert got[i] == pytest.approx(sum(w[i] for w in want), rel=1e-9, abs=1e-9)
        assert hmm_scoring.log_likelihoods(model, np.concatenate(texts), at) == pytest.approx(logs)
        assert hmm_scoring._Lanes(np.diff(at)).lanes == lanes


def test_a_groups_texts_share_rows(spark):
    """What travels in each round are a few rows a group, with every text and token in one of them."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").alias("id"), (F.col("doc_id") % 5 == 0).alias("held_out"), "text")
    vocabulary = hmm_scoring.vocabulary(hmm_scoring.token_counts(docs.filter("NOT held_out").select("text")), 50)
    rows = hmm_scoring.sequences(docs, vocabulary).filter("lengths IS NOT NULL").collect()
    want = {r.id: (r.held_out, len([*words(r.text), None])) for r in docs.collect()}
    assert len(rows) < len(want) / 10
    assert {i: (r.held_out, n) for r in rows for i, n in zip(r.ids, np.frombuffer(r.lengths, "<i8").tolist())} == want
    assert sum(len(r.ids) for r in rows) == len(want) and sum(len(r.symbols) for r in rows) == 2 * sum(n for _, n in want.values())
