"""Benchmark search and the n-gram join against all pairs."""
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from meterlake.llm import decontamination, ngram_join, textarrays as ta
from meterlake.llm.components import connected_components
from tests.conftest import SF_SMALL

from .helpers import DOC_SCHEMA, components, prose, shingles


def _leaks(docs, items):
    out = set()
    for d in docs:
        have = shingles(d.text)
        for i in items:
            want = shingles(i.text)
            if want and len(want & have) >= 0.75 * len(want):
                out.add((d.doc_id, i.item_id, len(want), len(want & have)))
    return out


def test_leaks_equal_all_pairs(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = decontamination.leaks(docs, items, chunk_items=17).collect()  # several chunks
    assert {tuple(r)[:4] for r in got} == _leaks(docs.collect(), items.collect()) and got


def test_leaks_of_awkward_tables(spark, awkward, empty):
    inside = prose(1, 30_000).split()
    items = spark.createDataFrame([(0, None), (1, ""), (2, "word"), (3, " ".join(inside[20_000:20_040])), (4, prose(77, 40)),
                                   (5, " ".join(inside[10:40] + ["x"] * 4))], "item_id long, text string")
    got = {tuple(r)[:4] for r in decontamination.leaks(awkward, items).collect()}
    assert got == _leaks(awkward.collect(), items.collect())
    assert {(7, 3), (4, 2), (7, 5)} <= {g[:2] for g in got}
    assert decontamination.leaks(empty, items).count() == 0 and decontamination.leaks(awkward, items.limit(0)).count() == 0
    clean = decontamination.decontaminated(awkward, items, chunk_items=1)
    assert clean.columns == awkward.columns and clean.count() == awkward.count() - 2
    assert decontamination.decontaminated(awkward, items.limit(0)).count() == awkward.count()


def test_a_passage_is_found_wherever_windows_begin():
    item = prose(5, 33)
    index = next(decontamination.item_chunks(_Items([(1, item)]), "a", "b", 10))
    for lead in range(0, 140, 7):
        text = ta.utf8(pa.array([f"{prose(6, lead)} {item} {prose(8, 300)}"]))
        assert [r[:2] for r in decontamination._verified(text, index, 0.75)] == [(0, 0)], lead


def test_items_of_few_words_are_found_at_the_ends_of_long_texts(spark):
    rows, items = [], []
    for i in range(300):
        own = " ".join(f"w{i}x{j}" for j in range(5 + i % 4))
        items.append((i, own))
        around = prose(1_000 + i, 150)
        rows.append((i, " ".join([own, around] if i % 2 else [around, own])))
    rows.append((300, " ".join(items[1][1].split()[:5])))  # one of an item's two shingles
    docs, tests = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.leaks(docs, tests).collect()
    assert {tuple(r)[:4] for r in got} == _leaks(docs.collect(), tests.collect()) == {(i, i, 1 + i % 4, 1 + i % 4) for i in range(300)}


class _Items:
    def __init__(self, rows):
        self.rows = rows

    def select(self, *columns):
        return self

    def toLocalIterator(self):
        return iter(self.rows)


def test_join_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == components({r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("large, side, first", [(64, 256, 3), (5, 16, 1), (100_000, 256, 3)])
def test_join_of_a_large_group_of_near_copies_and_a_shared_passage(spark, monkeypatch, large, side, first):
    for name, value in (("LARGE", large), ("SIDE", side), ("FIRST", first)):
        monkeypatch.setattr(ngram_join, name, value)
    import random
    r = random.Random(4)
    base, passage = prose(2, 160).split(), prose(3, 60)
    texts = {}
    for k in range(150):  # copies of copies, so that not all of the group are linked directly
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = f"x{r.randrange(40)}"
        texts[k] = " ".join(w)
    for k in range(60):
        texts[1000 + k] = f"{passage} {prose(100 + k, r.randint(0, 60))}"
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], DOC_SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == components(texts)


def _links(texts):
    """Pairs of different sets of Jaccard 0.75 or more, each as the smallest keys of either."""
    least = {}
    for k in sorted(texts):
        least.setdefault(frozenset(shingles(texts[k])), k)
    sets = [s for s in least if s]
    return {tuple(sorted((least[a], least[b]))) for i, a in enumerate(sets) for b in sets[i + 1:]
            if 4 * len(a & b) >= 3 * len(a | b)}, {k: least[frozenset(shingles(t))] for k, t in texts.items()}


@pytest.mark.parametrize("cell, columns", [(1024, 2048), (11, 7)])
def test_every_link_inside_a_component_counts(spark, monkeypatch, cell, columns):
    import random
    monkeypatch.setattr(ngram_join, "CELL", cell)
    monkeypatch.setattr(ngram_join, "COLUMNS", columns)
    r = random.Random(6)
    texts = {}
    for group, size in enumerate((2, 3, 4, 90)):  # the last: some pairs of one component link and some do not
        base = prose(20 + group, 160).split()
        for k in range(size):
            w = list(base)
            for _ in range(1 + k % 9 if size == 90 else 1):
                w[r.randrange(len(w))] = f"y{group}{k}"
            texts[1000 * group + k] = " ".join(w)
    texts[5000], texts[5001] = texts[1000], texts[3000].upper()  # one class with another document
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], DOC_SCHEMA).repartition(4)
    want, least = _links(texts)
    count = {k: sum(least[k] in pair for pair in want) for k in texts}
    assert {r.doc_id: r.links for r in ngram_join.near_duplicates(docs).collect()} == count
    assert max(count.values()) > 20 and count[1000] == 2 and len(want) < 90 * 89 / 2
    listed = [tuple(sorted((r.id_a, r.id_b))) for r in ngram_join.class_links(docs).collect()]
    assert len(listed) == len(set(listed)) and set(listed) == want


def test_links_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want, least = _links({r.doc_id: r.text for r in docs.collect()})
    got = {r.doc_id: r.links for r in ngram_join.near_duplicates(docs).collect()}
    assert got == {k: sum(least[k] in pair for pair in want) for k in got}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=20), min_size=1, max_size=40))
def test_shared_counts(sets):
    import numpy as np
    got = ngram_join.shared_counts([np.array(sorted(s), dtype=np.uint64) for s in sets])
    assert all(got[i, j] == (len(a & b) if i < j else 0) for i, a in enumerate(sets) for j, b in enumerate(sets))


def test_join_of_awkward_tables(spark, awkward, empty):
    rows = ngram_join.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    want = components({r.doc_id: r.text for r in awkward.collect() if r.doc_id is not None})
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in rows if r.doc_id is not None)
    assert [r.component_id for r in rows if r.doc_id in (8, 9, 10, 11)] == [8] * 5
    assert ngram_join.near_duplicates(empty).count() == 0
    kept = ngram_join.one_of_each(awkward)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert kept.columns == awkward.columns and ids == [1, 2, 3, 4, 5, 6, 7, 8, 12, 13, 14, 15] and kept.count() == 13
    assert ngram_join.one_of_each(empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=70), st.sets(st.integers(0, 2**64 - 1), max_size=70))
def test_signatures_bound_the_difference(a, b):
    import numpy as np
    b = b | set(list(a)[: len(a) // 2])
    x, y = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
    assert ngram_join.signature_difference(ngram_join.signature_of(x), ngram_join.signature_of(y)) <= len(a ^ b)


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (5, 4), (6, 6)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], []])
def test_components_of_chains_and_stars(spark, edges):
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}
    for a, b in edges:
        if a != b:
            parent.setdefault(a, a), parent.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and parent[a] != parent[b]:
                parent[a] = parent[b] = min(parent[a], parent[b])
                changed = True
    assert got == parent


def test_one_of_each_keeps_clashing_columns_and_rows_that_differ(spark):
    from meterlake.llm import ngram_join
    text = prose(4, 60)
    rows = [(1, text, "a"), (2, text, "b"), (3, prose(5, 60), "c"), (3, prose(5, 60), "c"), (3, prose(5, 60), "d"), (None, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, note string").selectExpr(
        "*", "10 AS _place", "'x' AS _id", "true AS _gone", "1 AS key", "2 AS GONE", "3 AS place")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r[0], r[2], r["_place"], r["_id"], r["_gone"], r["key"], r["GONE"], r["place"]) for r in kept.collect()), key=repr)
    assert got == sorted([(1, "a", 10, "x", True, 1, 2, 3), (3, "c", 10, "x", True, 1, 2, 3), (3, "d", 10, "x", True, 1, 2, 3),
                          (None, "e", 10, "x", True, 1, 2, 3)], key=repr)
