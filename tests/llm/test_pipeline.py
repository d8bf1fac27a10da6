"""The corpus pipeline, and the package without the training-data folders."""
import os
import shutil
import subprocess
import sys

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from meterlake.llm import pii, quality
from meterlake.llm.tokenizer_files import encoder, public_byte_bpe
from tests.conftest import ROOT, SF_SMALL

from .helpers import components, shingles


def _joined(rows):
    """Each document's token ids, from its pieces."""
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        out[r.doc_id] = out.get(r.doc_id, b"") + bytes(r.ids)
    return out


def test_run_equals_its_stages_done_plainly(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    keep = {r.doc_id for r in quality.scored(docs).collect() if r.score >= 0.5}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in keep}
    texts = {k: texts[k] for k, (_, least) in components(texts).items() if least == k}
    clean = {k: t for k, t in texts.items() if all(not i or len(i & shingles(t)) < 0.75 * len(i) for i in items)}
    assert len(clean) < len(texts) < len(keep)
    source = spark.createDataFrame([(k, t) for k, t in clean.items()], "doc_id long, text string")
    own = encoder(public_byte_bpe())
    want = {}
    for r in pii.spans(source).collect():
        text, out, done = clean[r.doc_id], "", 0
        for s in sorted(r.spans, key=lambda s: s.start):
            out, done = out + text[done:s.start] + f"[{s.kind.upper()}]", s.end
        want[r.doc_id] = np.append(own.ids(out + text[done:]), 1).astype("<u4").tobytes()
    assert _joined(corpus_pipeline.run(spark, SF_SMALL).collect()) == want


def test_stages_keep_the_columns(spark, awkward, empty):
    for docs in (awkward, empty):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, SF_SMALL)
            assert kept.columns == docs.columns, name
            kept = spark.createDataFrame(kept.collect(), docs.schema)
        pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF_SMALL)
        assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in kept.collect()}


def test_rejected_documents_never_come_back(spark, awkward):
    ids = [r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, awkward, SF_SMALL).collect()]
    assert not {1, 2, 3, 6} & set(ids) and {8, 11} <= set(ids)


def test_the_rest_stands_without_the_folders(tmp_path):
    """The entry module imports, with its other queries, when these folders and the pipeline are gone."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in ("llm", "corpus_pipeline.py", ".git", "__pycache__")])
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)}, check=True)
    rest = [q for q in entry.queries() if not q.startswith("op") and q != "pipeline"]
    assert done.stdout.split()[0] == str(len(rest))


def test_registered_names():
    assert "pipeline" in entry.queries() and "op8_url_filter" in entry.oracle_sql()
    assert set(entry.oracle_sql()) <= set(entry.queries())
