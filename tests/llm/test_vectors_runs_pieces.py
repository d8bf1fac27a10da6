"""Whitening, periodic runs and piece coding against plain versions."""
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from meterlake.llm import periodic_runs as runs
from meterlake.llm import piece_coding as pieces
from meterlake.llm import whitening
from meterlake.llm.common import read_table, ship_package
from tests.conftest import SF_SMALL


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


# --- whitening ------------------------------------------------------------------------------------------

def brute_whitening(rows, dim):
    """Of (id, vector) rows: number and sums of the distinct integer vectors, eigenvalues and eigenvectors."""
    x = {tuple(int(np.floor(64 * float(c))) for c in v) + (0,) * (dim - len(v)) for _, v in rows}
    m = np.array(sorted(x), dtype=np.float64)
    s = np.array(sorted(x), dtype=object).sum(axis=0)
    centred = m - m.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(m))
    return len(m), s, values[::-1], vectors[:, ::-1]


def check_whitening(got, rows, dim, expected_components):
    n, s, values, vectors = brute_whitening(rows, dim)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    assert set(by) == {i for i, _ in rows}
    signs = {}
    for i, v in rows:
        own = {r["component"]: r for r in by[i]}
        assert sorted(own) == list(range(1, expected_components + 1))
        x = [int(np.floor(64 * float(c))) for c in v] + [0] * (dim - len(v))
        z = [n * a - b for a, b in zip(x, s)]
        for k in range(1, expected_components + 1):
            r = own[k]
            assert (r["n"], r["deviation"]) == (n, sum(a * a for a in z))
            assert r["explained"] == pytest.approx(values[k - 1] / values.sum(), rel=1e-6)
            assert r["identity_error"] < 1e-9
            plain = float(np.array([a / n for a in z]) @ vectors[:, k - 1]) / np.sqrt(values[k - 1])
            if abs(plain) > 1e-6:
                signs.setdefault(k, set()).add(bool(np.sign(plain) == np.sign(r["whitened"])))
            assert abs(r["whitened"]) == pytest.approx(abs(plain), abs=1e-6)
    assert all(len(v) == 1 for v in signs.values())


def test_whitening_equals_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((400, 20)) * np.linspace(1, 9, 20)
    rows = [(i, [float(c) for c in v[i]]) for i in range(400)] + [(400 + i, [float(c) for c in v[3]]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(19)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    check_whitening(whitening.whitened(df).collect(), rows, 20, 16)


def test_whitening_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id bigint, embedding array<double>, n int, x string, id string"
    good = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (2, [0.5, -2.0, 3.0]), (3, [4.0, 1.0]), (4, []), (5, [7.25, 0.0, -1.0])]
    bad = [(6, None), (7, [1.0, None, 2.0]), (8, [nan, 1.0, 1.0]), (9, [inf, 1.0, 1.0]), (10, [1.0, -inf, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in good + bad], schema)
    got = whitening.whitened(df).collect()
    assert sorted(r["vec_id"] for r in got if r["component"] == 1) == [1, 2, 2, 3, 4, 5]
    assert {r["component"] for r in got} == {1, 2, 3} and {r["n"] for r in got} == {5}
    assert whitening.whitened(df.limit(0)).collect() == []
    assert whitening.whitened(df.filter("vec_id = 1")).collect() == []
    assert whitening.whitened(df.filter("vec_id > 5")).collect() == []
    assert [r["vec_id"] for r in whitening.whitened(spark.createDataFrame([(None, [1.0]), (2, [3.0])], "vec_id bigint, embedding array<double>")).orderBy("vec_id").collect()] == [None, 2]


def test_whitening_leaves_out_components_without_variance(spark):
    rng = np.random.default_rng(5)
    a = rng.standard_normal((300, 3))
    df = spark.createDataFrame([(i, [*map(float, r), *map(float, r), 5.0]) for i, r in enumerate(a)], "vec_id bigint, embedding array<double>")
    got = whitening.whitened(df).collect()
    assert {r["component"] for r in got} == {1, 2, 3}
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("case", ["random", "graded", "equal", "clusters", "deficient"])
def test_solver_keeps_small_values_and_orthogonal_vectors(case):
    rng = np.random.default_rng(6)
    x = {"random": rng.standard_normal((90, 24)), "graded": rng.standard_normal((90, 24)) * np.logspace(0, -7, 24),
         "equal": np.vstack([np.eye(12), -np.eye(12)]), "deficient": rng.standard_normal((9, 24)),
         "clusters": np.diag([5.0] * 4 + [3.0] * 4 + [3.0 + 1e-9] * 4) @ np.linalg.qr(rng.standard_normal((12, 12)))[0]}[case]
    r = whitening._triangle(x, x.shape[1])
    values, directions, total = whitening.components(r, 24)
    plain = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(values, plain[:len(values)], rtol=1e-9)
    assert len(values) == np.linalg.matrix_rank(r)
    assert np.abs(directions.T @ directions - np.eye(len(values))).max() < 1e-9
    assert total == pytest.approx(float((plain ** 2).sum()))
    assert np.linalg.norm(r.T @ (r @ directions) - directions * values ** 2, axis=0).max() < 1e-12 * plain[0] ** 2


def test_op11_reads_every_row(spark):
    table = read_table(spark, SF_SMALL, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check_whitening(whitening.op11_whitening(spark, SF_SMALL).collect(), rows, 64, 16)


# --- periodic runs --------------------------------------------------------------------------------------

def brute_runs(words, min_length, min_exponent):
    best = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_exponent * q):
                best.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def periodic(r, n, letters):
    words = [r.randrange(letters) for _ in range(n)]
    for _ in range(r.randint(0, 3)):
        if n:
            s, p, z = r.randrange(n), r.randint(1, 7), r.randint(0, n)
            for i in range(s + p, min(s + z, n)):
                words[i] = words[i - p]
    return words


@pytest.mark.parametrize("min_length,min_exponent", [(6, 4), (2, 2), (4, 3), (9, 2)])
def test_runs_equal_brute_force(min_length, min_exponent):
    r = random.Random(min_length * 10 + min_exponent)
    for _ in range(400):
        texts = [periodic(r, r.randint(0, 70), r.randint(1, 4)) for _ in range(r.randint(0, 4))]
        ids = np.array(list(itertools.chain(*texts)), dtype=np.int64)
        starts, at, expected = [], 0, []
        for w in texts:
            if w:
                starts.append(at)
            expected += [(s + at, n, q) for s, n, q in brute_runs(w, min_length, min_exponent)]
            at += len(w)
        assert runs.runs_of(ids, np.array(starts, dtype=np.int64), min_length, min_exponent) == expected


def plain_op12(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words, 6, 4)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    top = sorted(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))[0] if found else (None,) * 3
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def op12(spark, docs, tmp_dir):
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    return sorted(map(tuple, runs.op12_periodic_runs(spark, tmp_dir).collect()), key=repr)


def test_op12_equals_brute_force(spark, tmp_dir):
    r = random.Random(9)
    rows = [(i, " ".join("abcdefgh"[w] for w in periodic(r, r.randint(0, 120), 8)) if i % 7 else None) for i in range(600)]
    rows += [(700, "x " * 400), (701, "   \u000b     \t   "), (701, "B b " * 9), (None, "b " * 40), (702, " \n ")]
    rows += [(800 + i, " ".join(f"w{k}" for k in range(300))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS runs", "'x' AS collapsed", "2 AS id").repartition(5)
    assert op12(spark, docs, tmp_dir) == sorted((plain_op12(*r) for r in rows), key=repr)


def test_op12_awkward_documents(spark, awkward, empty, tmp_dir):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 50_000]
    got = op12(spark, awkward, f"{tmp_dir}/a")
    assert len(got) == len(rows)
    assert set(map(repr, (plain_op12(*r) for r in short))) <= set(map(repr, got))
    assert op12(spark, empty, f"{tmp_dir}/b") == []


def test_periodic_text_of_many_words():
    words = np.tile(np.random.default_rng(1).integers(0, 9000, 3000), 40)
    assert runs.runs_of(words, np.array([0])) == [(0, 120_000, 3000)]


# --- piece coding ---------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


TRICKY = [None, "", " ", "  ", "a  b", "▁", "▁x ▁", "<s>a</s><0x0A>", "\n\t a\x00b", "�", "日本語 Ünï \U0001F600x", " lead", "trail  ", "a" * 5000,
          " " * 3000, " " * 700 + "x" + " " * 31 + "y", "ab" * 900 + "aab" * 500, "=" * 999, "1" * 2000 + "@"]


def coded(texts):
    ids, at = pieces.encode_texts(pieces.public_model(), texts)
    return [ids[a:z].tolist() for a, z in zip(at, at[1:])]


def test_encoding_equals_the_library(library):
    r = random.Random(3)
    parts = ["a", "b", "e", "t", "h", " ", "  ", "▁", "\n", "é", "日", "1", "the", "ing", "ana", "aaaa", "\U0001F600", "\t", "0x", " " * 17, "="]
    texts = TRICKY + ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(r.choice(r.choice(["ab", "anb", "et", "ino"])) for _ in range(r.randint(1, 60))) for _ in range(2000)]
    assert coded(texts) == [library.encode(t or "") for t in texts]


def test_words_kept_do_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 3)
    texts = ["one two three four", "five six  seven one", "two"] * 3
    assert [coded([t])[0] for t in texts] == [library.encode(t) for t in texts]


def test_decoding_equals_the_library(library):
    r = random.Random(4)
    own = pieces.pieces_of(pieces.public_model())
    lists = [[r.choice([r.randrange(32000), r.randrange(259), 28705, 259]) for _ in range(r.randint(0, 12))] for _ in range(3000)]
    at = np.cumsum([0, *map(len, lists)])
    assert own.decode(np.array(list(itertools.chain(*lists))), at) == [library.decode(x) for x in lists]


def test_other_models_are_refused():
    model = pieces.public_model()
    with pytest.raises(ValueError, match="byte-pair"):
        pieces.Pieces(model[:-18] + model[-18:].replace(b"\x20\x00", b"\x20\x01"))


def test_op13_equals_the_library(spark, awkward, empty, library, tmp_dir):
    docs = read_table(spark, SF_SMALL, "documents")
    more = spark.createDataFrame([(10_000_000 + i, t) for i, t in enumerate(TRICKY)], "doc_id bigint, text string")
    for k, table in enumerate([docs.select("doc_id", "text").unionByName(more), awkward.withColumn("decoded", awkward["text"]), empty]):
        rows = [(r["doc_id"], r["text"]) for r in table.collect()]
        table.write.parquet(f"{tmp_dir}/{k}/documents.parquet")
        expected = []
        for i, t in rows:
            ids = library.encode(t or "")
            expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        got = [tuple(r) for r in pieces.op13_piece_coding(spark, f"{tmp_dir}/{k}").collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
