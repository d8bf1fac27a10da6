"""Steps that must not grow with a map task's share of the input, and layouts that must."""
import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from meterlake.operators import cells as CE, grains
from meterlake.operators.anomaly import rolling_scores
from meterlake.operators.clean import clean, curate
from meterlake.registry_streaming import _quarter_files
from meterlake.sources import compaction, versions as V
from meterlake.sources.raw import header_lines
from meterlake.sources.versions import commit
from meterlake.streaming import dead_letters, merge_version, outage_spells_stream
from meterlake.streaming.ingest import merge_batch
from meterlake.streaming.outages import spell_readings

RAW = "reading_ts timestamp_ntz, energy_kwh double, avg_voltage double, avg_current double, frequency_hz double, meter_id string"


def _readings(spark, *rows):
    return spark.createDataFrame([(dt.datetime(2020, *t), e, v, a, 50.0, m) for t, e, v, a, m in rows], RAW)


def _few(spark):
    return _readings(spark, ((1, 31, 23, 57), 0.5, 230.0, 4.0, "A"), ((2, 1, 0, 0), 0.25, 250.0, 2.0, "A"), ((2, 1, 0, 3), 0.5, 0.0, 2.0, "A"),
                     ((2, 1, 0, 3), 0.75, 230.0, 2.0, "A"), ((2, 1, 0, 3), 0.5, 0.0, 2.0, "B"), ((1, 31, 23, 57), 0.5, 210.0, 12.0, "B"))


def _same(a, b):
    return sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


def _before_shuffle(df):
    """The part of the physical plan that map tasks of its last shuffle run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("Exchange"):]


def test_rollups_laid_out_are_the_rollups(spark):
    c = curate(_few(spark))
    hourly = grains.hourly_rollup(c)
    assert _same(grains.hourly_rollup(c, laid_out=True), hourly)
    assert _same(grains.daily_rollup(c, laid_out=True), grains.daily_rollup(c))
    assert _same(grains.daily_rollup(hourly, laid_out=True), grains.daily_rollup(hourly))


def test_no_map_task_holds_a_group_for_every_row(spark, tmp_dir):
    curate(_few(spark)).write.parquet(tmp_dir + "/c")
    c = spark.read.parquet(tmp_dir + "/c")
    for df in (grains.hourly_rollup(c, laid_out=True), grains.daily_rollup(c, laid_out=True), clean(_few(spark)), clean(_few(spark), order="dedup_first")):
        assert "Aggregate" not in _before_shuffle(df)


def test_rows_without_a_key_do_not_meet_in_a_task(spark):
    some = _few(spark).withColumn("meter_id", F.when(F.col("avg_current") > 3, F.col("meter_id")))
    assert sorted(r["meter_id"] for r in clean(some).collect()) == ["A", "B"]
    assert "Filter atleastnnonnulls" in _before_shuffle(clean(some))


def test_headers_are_found_without_sorting_all_lines(spark):
    lines = spark.createDataFrame([("x_Timestamp,meter", "a"), ("1,A_1", "a"), ("a,METER", "b"), ("T_KWH,z", "c"), ("2,B", "c")], "value string, file string")
    found = header_lines(lines)
    assert {r["file"]: r["header"] for r in found.collect()} == {"a": "x_Timestamp,meter", "b": None, "c": "T_KWH,z"}
    assert {r["file"]: r["header"] for r in header_lines(lines, "METER").collect()} == {"a": None, "b": "a,METER", "c": None}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan


def test_written_files_are_listed_without_sorting_all_rows(spark, tmp_dir):
    listed = V.write_files(spark, curate(_few(spark)), tmp_dir)
    assert sorted((r["year"], r["month"], r["rows"], r["first_meter"], r["last_meter"]) for r in listed.collect()) == [(2020, 1, 2, "A", "B"), (2020, 2, 3, "A", "B")]
    commit_id = listed.first()["file"].split("/")[0].removeprefix("commit=")
    assert "SortAggregate" not in V.written_files(spark, tmp_dir, commit_id)._jdf.queryExecution().executedPlan().toString()


def test_a_versions_changes_are_kept(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    merge_version(spark, _few(spark), root)
    merge_version(spark, _readings(spark, ((2, 1, 0, 3), 0.25, 230.0, 2.0, "A"), ((2, 1, 0, 3), 0.75, 230.0, 2.0, "B"), ((3, 1, 0, 0), 0.5, 230.0, 2.0, "C")), root)
    changed = V.kept_changes(spark, root, 1, 2)
    # A's copy wins over the stored one, B's loses, C's is new
    assert sorted((r["meter_id"], r["energy_kwh"], r["_sign"]) for r in changed.collect()) == [("A", 0.25, 1), ("A", 0.5, -1), ("C", 0.5, 1)]
    commit(spark, root, V.version(spark, root), V.live_files(spark, root, V.version(spark, root)))
    assert V.kept_changes(spark, root, 1, 3) is None
    assert _same(CE.changed_rows(spark, root, 1, 3), changed)


def test_cluster_sorts_few_rows_in_a_task(spark, tmp_dir, monkeypatch):
    V.commit(spark, tmp_dir, None, V.write_files(spark, curate(_few(spark)), tmp_dir))
    monkeypatch.setattr(compaction, "SORT_ROWS", 1)
    before = V.read_version(spark, tmp_dir)
    assert compaction.cluster(spark, tmp_dir) == 2
    assert V.live_files(spark, tmp_dir, V.version(spark, tmp_dir)).count() == 5
    assert _same(V.read_version(spark, tmp_dir), before)


def test_a_landing_has_files_by_its_input(spark):
    frame = spark.range(0, 100, 1, 12)
    assert _quarter_files(frame) == 6 and _quarter_files(frame.coalesce(1)) == 1


def test_rows_of_a_batch_without_keys_are_counted(spark, tmp_dir):
    nulls = _few(spark).withColumn("meter_id", F.lit(None).cast("string"))
    assert merge_version(spark, nulls, f"{tmp_dir}/v")["rows"] == 6
    assert merge_batch(spark, nulls, f"{tmp_dir}/t", f"{tmp_dir}/s")["rows"] == 6
    assert merge_batch(spark, nulls.limit(0), f"{tmp_dir}/t", f"{tmp_dir}/s", batch_id=1)["rows"] == 0


def test_days_of_the_daily_rollup_are_dealt_by_meter_once(spark, tmp_dir):
    grains.daily_rollup(curate(_few(spark))).write.parquet(tmp_dir + "/d")
    days = spark.read.parquet(tmp_dir + "/d")
    twice = days.unionByName(days.limit(1)).unionByName(days.withColumn("meter_id", F.lit(None).cast("string")))
    assert _same(grains.daily(twice), twice.groupBy("meter_id", F.col("reading_date").alias("d")).agg(F.sum("energy_kwh").alias("kwh")))
    scored = rolling_scores(grains.daily(days), ["meter_id"], "d", "kwh", min_history=0)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    # no map task holds a group for every row; the window takes the aggregate's shuffle and order
    assert "Aggregate" not in _before_shuffle(scored) and plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_spells_take_only_readings_they_depend_on(spark):
    rows = _readings(spark, ((1, 1, 0, 0), 0.5, 230.0, 1.0, "A"), ((1, 1, 0, 3), 0.5, 230.0, 1.0, "A"), ((1, 1, 6, 0), 0.5, 0.0, 1.0, "A"),
                     ((1, 1, 6, 0), 0.25, 230.0, 1.0, "A"), ((1, 1, 6, 0), 0.25, 230.0, 1.0, "B"), ((1, 1, 12, 0), 0.5, 230.0, 1.0, "B"),
                     ((1, 1, 11, 50), 0.5, 230.0, 1.0, "B"), ((1, 1, 11, 51), 0.5, 230.0, 1.0, "B"))
    newest = dt.datetime(2020, 1, 1, 12)
    got = lambda before: sorted((r.meter_id, r.reading_ts.strftime("%H:%M"), r.avg_voltage)
                                for r in spell_readings(rows, before, newest, "10 minutes").collect())
    kept = [("A", "06:00", 0.0), ("A", "06:00", 230.0), ("B", "11:51", 230.0), ("B", "12:00", 230.0)]
    assert got(None) == kept and got(dt.datetime(2020, 1, 1)) == [("A", "00:00", 230.0), *kept]


def test_spells_of_copies_that_land_apart(spark, tmp_dir):
    header, day = "x_Timestamp,t_kWh,z_Avg Voltage (Volt),z_Avg Current (Amp),y_Freq (Hz),meter", "2020-01-01"
    landings = ([f"{day} 00:00:00,0.5,0,0,0,BR01", f"{day} 00:03:00,0.5,230,1,50,BR01", f"{day} 05:00:00,0.25,230,1,50,BR02", f"{day} 05:00:00,0.5,0,0,0,BR03",
                 "bad,0.5,0,0,0,BR01"],
                # copies of the last minutes: this one of BR02 loses, and that of BR03
                [f"{day} 05:00:00,0.5,0,0,0,BR02", f"{day} 05:00:00,0.75,230,1,50,BR03", f"{day} 04:57:00,0.5,0,0,0,BR03", f"{day} 04:00:00,0.5,0,0,0,BR03"],
                ["2020-01-02 00:00:00,0.5,230,1,50,BR01"])
    for i, rows in enumerate(landings):
        (Path(tmp_dir) / "land").mkdir(exist_ok=True)
        (Path(tmp_dir) / "land" / f"{i}.csv").write_text("\n".join([header, *rows]) + "\n")
        done = outage_spells_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/sink", f"{tmp_dir}/ck")
    got = sorted((r.meter_id, r.spell_start.strftime("%H:%M"), r.readings) for r in spark.read.parquet(f"{tmp_dir}/sink").collect())
    assert got == [("BR01", "00:00", 1), ("BR03", "04:57", 2)]
    dead = sorted((r.line, r.reason) for r in dead_letters(spark, done["staged"]).collect())
    assert dead == [(f"{day} 04:00:00,0.5,0,0,0,BR03", "late"), ("bad,0.5,0,0,0,BR01", "null")]
    staged = spark.read.parquet(f"{done['staged']}/rows/batch=0/kind=readings")
    assert staged.count() == 4 and staged.filter("line IS NOT NULL OR file IS NOT NULL").isEmpty()
    # the reading of 00:03 moved nothing and went nowhere
    assert spark.read.parquet(f"{done['staged']}/kept/batch=0").count() == 3
