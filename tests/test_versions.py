"""Versioned table: atomic commits, file-level corrections, crashes at every step, compaction and clustering."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterlake.operators.clean import curate
from meterlake.rules import CURATED_COLUMNS
from meterlake.sources import compaction, versions as V
from meterlake.sources.raw import normalize_columns
from meterlake.sources.standin import as_raw_frame, standin_raw_frame, standin_readings
from meterlake.streaming import merge_version, versioned, versioned_ingest
from meterlake.testdata import curated_standin
from tests.conftest import SF_SMALL

RAW = ("reading_ts timestamp_ntz, energy_kwh double, avg_voltage double, avg_current double, frequency_hz double, meter_id string")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _files(spark, root, number=None):
    return {r["file"] for r in V.live_files(spark, root, V.version(spark, root, number)).collect()}


def _readings(spark, rows):
    return spark.createDataFrame(rows, RAW)


def _month(spark, meters, day=1, kwh=0.25):
    return _readings(spark, [(dt.datetime(2020, 1, day, h), kwh, 230.0, 1.5, 50.0, m) for m in meters for h in range(24)])


def test_ingest_in_parts_equals_batch_and_replay_is_noop(spark, tmp_dir):
    raw = standin_raw_frame(spark, SF_SMALL).withColumn("_p", F.abs(F.hash("meter", "x_Timestamp")) % 3)
    for p in range(3):
        raw.filter(F.col("_p") == p).drop("_p").coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/p{p}")
    root, ck = f"{tmp_dir}/table", f"{tmp_dir}/ck"
    first = versioned_ingest(spark, f"{tmp_dir}/land", root, ck, max_files_per_trigger=1)
    assert (first["batches"], first["version"]) == (3, 3)
    expected = curated_standin(spark, SF_SMALL).select(*CURATED_COLUMNS)
    assert _same(V.read_version(spark, root), expected)
    again = versioned_ingest(spark, f"{tmp_dir}/land", root, ck, max_files_per_trigger=1)
    assert (again["batches"], again["version"]) == (0, 3)
    # the same rows landed once more change nothing
    raw.drop("_p").coalesce(2).write.option("header", True).csv(f"{tmp_dir}/land/again")
    assert versioned_ingest(spark, f"{tmp_dir}/land", root, ck)["batches"] == 1
    assert _same(V.read_version(spark, root), expected)


def test_a_correction_rewrites_the_one_file_that_holds_the_key(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    for k, meters in enumerate((["A1", "A2"], ["B1", "B2"], ["C1"])):
        merge_version(spark, _month(spark, meters), root, stream="s", batch_id=k)
    before = _files(spark, root)
    assert len(before) == 3
    fix = _readings(spark, [(dt.datetime(2020, 1, 1, 5), 0.125, 230.0, 1.5, 50.0, "B2")])
    old_reader = V.read_version(spark, root)
    out = merge_version(spark, fix, root, stream="s", batch_id=3)
    assert (out["rows"], out["files"], out["rewritten"], out["version"]) == (1, 1, 1, 4)
    after = _files(spark, root)
    holder = {r[0] for r in spark.read.parquet(*(f"{root}/data/{f}" for f in before)).filter("meter_id = 'B2'").select(F.input_file_name()).distinct().collect()}
    assert len(before - after) == 1 and all(next(iter(before - after)) in h for h in holder)
    key = "meter_id = 'B2' AND reading_ts = TIMESTAMP_NTZ '2020-01-01 05:00:00'"
    assert [r.energy_kwh for r in V.read_version(spark, root).filter(key).collect()] == [0.125]
    assert V.read_version(spark, root).count() == 24 * 5
    # a reader that began before sees its version to the end, and so does one that asks for it
    assert [r.energy_kwh for r in old_reader.filter(key).collect()] == [0.25]
    assert [r.energy_kwh for r in V.read_version(spark, root, number=3).filter(key).collect()] == [0.25]
    # a copy that loses is not stored
    worse = merge_version(spark, _readings(spark, [(dt.datetime(2020, 1, 1, 5), 3.0, 230.0, 1.5, 50.0, "B2")]), root)
    assert worse["rewritten"] == 1 and not _files(spark, root) - after - {f for f in _files(spark, root) if f not in before}
    assert [r.energy_kwh for r in V.read_version(spark, root).filter(key).collect()] == [0.125]


@pytest.mark.parametrize("step", ["curated rows written", "losing copies found", "files rewritten", "list written", "after the commit"])
def test_crash_at_each_step_leaves_the_old_or_the_new_version(spark, tmp_dir, monkeypatch, step):
    root = f"{tmp_dir}/table"
    merge_version(spark, _month(spark, ["A1", "B1"]), root, stream="s", batch_id=0)
    old = V.read_version(spark, root)
    batch = _month(spark, ["B1", "C1"], kwh=0.125)
    expected = curate(_month(spark, ["A1", "B1"]).unionByName(batch)).select(*CURATED_COLUMNS)

    class Crash(Exception):
        pass

    calls = {"write": 0}

    def crash_in(module, name, before=True, at=1):
        inner = getattr(module, name)

        def run(*a, **b):
            calls["write"] += 1
            if calls["write"] == at and before:
                raise Crash
            out = inner(*a, **b)
            if calls["write"] == at:
                raise Crash
            return out
        monkeypatch.setattr(module, name, run)

    {"curated rows written": lambda: crash_in(versioned, "write_files", before=False),
     "losing copies found": lambda: crash_in(versioned, "write_files", at=2),
     "files rewritten": lambda: crash_in(versioned, "commit"),
     "list written": lambda: crash_in(V, "publish"),
     "after the commit": lambda: crash_in(versioned, "commit", before=False)}[step]()
    with pytest.raises(Crash):
        merge_version(spark, batch, root, stream="s", batch_id=1)
    seen = V.read_version(spark, root)
    assert _same(seen, expected if step == "after the commit" else old)
    monkeypatch.undo()
    replay = merge_version(spark, batch, root, stream="s", batch_id=1)   # the stream runs the batch again
    assert replay["rows"] == (0 if step == "after the commit" else 48)
    assert _same(V.read_version(spark, root), expected)
    assert V.version(spark, root).number == 2


def test_a_commit_in_between_is_matched_again(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/table"
    merge_version(spark, _month(spark, ["A1"]), root)
    inner, other = versioned.commit, []

    def overtaken(*a, **b):
        if not other:
            other.append(1)
            merge_version(spark, _month(spark, ["A1", "B1"], kwh=0.0625), root)
        return inner(*a, **b)

    monkeypatch.setattr(versioned, "commit", overtaken)
    merge_version(spark, _month(spark, ["A1", "B1", "C1"], kwh=0.125), root)
    got = {(r["meter_id"], r["e"]) for r in V.read_version(spark, root).groupBy("meter_id").agg(F.sum("energy_kwh").alias("e")).collect()}
    assert got == {("A1", 1.5), ("B1", 1.5), ("C1", 3.0)}
    assert V.version(spark, root).number == 3
    base = V.version(spark, root, 1)
    with pytest.raises(V.CommitConflict):
        V.commit(spark, root, base, V.live_files(spark, root, base))


def test_empty_batches_and_an_empty_table(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    assert V.version(spark, root) is None
    assert V.read_version(spark, root).count() == 0
    out = merge_version(spark, _readings(spark, []), root, stream="s", batch_id=0)
    assert (out["rows"], out["files"], out["version"]) == (0, 0, 1)
    assert V.read_version(spark, root).columns == list(CURATED_COLUMNS)
    assert compaction.compact(spark, root) == 0 and compaction.cluster(spark, root) == 0


def test_vacuum_keeps_what_recent_versions_use(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    for k in range(4):
        merge_version(spark, _month(spark, ["A1"], kwh=0.5 / 2 ** k), root)
    kept = _files(spark, root) | _files(spark, root, 3)
    assert V.vacuum(spark, root, keep=2) == 0          # too young
    assert V.vacuum(spark, root, keep=2, older_than_s=-5) > 0
    there = {os.path.relpath(os.path.join(d, n), f"{root}/data") for d, _, names in os.walk(f"{root}/data") for n in names if n.endswith(".parquet")}
    assert there == kept
    assert V.read_version(spark, root).agg(F.sum("energy_kwh")).first()[0] == 24 / 16
    assert V.read_version(spark, root, number=3).count() == 24


def test_a_hundred_appends_compact(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    base = None
    rows = curate(standin_readings(spark, SF_SMALL)).withColumn("_p", F.abs(F.hash("meter_id", "reading_ts")) % 100)
    # a hundred commits written as one job's hundred files to a month, as many appends would leave them
    few = rows.filter("year = 1995")
    parts = few.repartition(100, "_p").drop("_p")
    added = V.write_files(spark, parts, root, laid_out=True)
    V.commit(spark, root, base, added)
    small = added.count()
    months = added.select("year", "month").distinct().count()
    assert small >= 50 * months / 12
    size = added.agg(F.sum("bytes")).first()[0]
    replaced = compaction.compact(spark, root, target_bytes=size)
    live = V.live_files(spark, root, V.version(spark, root))
    assert replaced == small and live.count() == months
    assert _same(V.read_version(spark, root), few.drop("_p"))
    assert compaction.compact(spark, root, target_bytes=size) == 0


def test_bins_hold_about_the_target(spark):
    t = dt.datetime(2020, 1, 1)
    files = spark.createDataFrame([(f"f{k}", 2020, 1 + k % 2, 10 + k, 1, t + dt.timedelta(hours=k), t, "a", "b") for k in range(40)]
                                  + [("large", 2020, 1, 95, 1, t, t, "a", "b"), ("alone", 2020, 3, 5, 1, t, t, "a", "b")], V.LIST_SCHEMA)
    got = compaction.bins(files, target_bytes=100).groupBy("year", "month", "bin").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in got) >= 36 and all(r["n"] > 1 and r["b"] < 175 for r in got)
    assert {r["month"] for r in got} == {1, 2}


def test_clustering_reduces_the_files_of_a_meter_and_week(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    start = dt.datetime(2020, 1, 1)
    rows = spark.range(400 * 31 * 8).select(
        F.timestamp_add("MINUTE", ((F.col("id") % 248) * 180).cast("int"), F.lit(start).cast("timestamp_ntz")).alias("reading_ts"),
        F.lit(0.25).alias("energy_kwh"), F.lit(230.0).alias("avg_voltage"), F.lit(1.5).alias("avg_current"), F.lit(50.0).alias("frequency_hz"),
        F.format_string("BR%04d", F.floor(F.col("id") / 248)).alias("meter_id"))
    table = curate(rows)
    V.commit(spark, root, None, V.write_files(spark, table.repartition(32), root, laid_out=True))
    def read(v):
        return V.selected(V.live_files(spark, root, v), "2020-01-08", "2020-01-15", ["BR0123"]).count()
    before = read(V.version(spark, root))
    size = V.live_files(spark, root, V.version(spark, root)).agg(F.sum("bytes")).first()[0]
    assert compaction.cluster(spark, root, target_bytes=size // 32 + 1) == 32
    after = read(V.version(spark, root))
    assert before == 32 and after <= 6
    assert _same(V.read_version(spark, root), table.select(*CURATED_COLUMNS))
    week = V.read_version(spark, root, "2020-01-08", "2020-01-15", ["BR0123"])
    assert week.count() == 56


def test_interleaved_bits():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    got = spark.range(1).select(compaction.interleaved(F.lit(0b101), F.lit(0b011), bits=3).alias("z")).first()["z"]
    assert got == 0b011011
