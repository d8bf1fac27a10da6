"""Cells maintained from version changes equal a full rebuild; sketches stay within their bounds on any period."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlake.operators import cells as CE, sketches as SK
from meterlake.operators.clean import curate
from meterlake.operators.grains import hourly_rollup
from meterlake.operators.quality import exact_quantiles
from meterlake.sources import compaction, versions as V
from meterlake.sources.standin import standin_readings
from meterlake.streaming import merge_version
from meterlake.testdata import ROLLUP_COLUMNS, curated_standin
from tests.conftest import SF_SMALL

RAW = "reading_ts timestamp_ntz, energy_kwh double, avg_voltage double, avg_current double, frequency_hz double, meter_id string"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _rows(spark, *rows):
    return spark.createDataFrame([(dt.datetime(2020, 1, 1, *t), e, v, a, 50.0, m) for t, e, v, a, m in rows], RAW)


def _check(spark, root, path):
    table = V.read_version(spark, root)
    kept = CE.read_cells(spark, path)
    assert _same(kept, CE.cells_of(table).select(*kept.columns))
    assert _same(CE.hourly_from_cells(kept).select(*ROLLUP_COLUMNS), hourly_rollup(table).select(*ROLLUP_COLUMNS))


def test_cells_equal_a_rebuild_after_inserts_and_corrections(spark, tmp_dir):
    root, path = f"{tmp_dir}/t", f"{tmp_dir}/cells"
    assert CE.refresh_cells(spark, root, path) == {"version": None, "touched": 0, "recomputed": 0}
    merge_version(spark, _rows(spark, ((0, 0), 0.5, 230.0, 4.0, "A"), ((0, 3), 0.5, 230.0, 2.0, "A"), ((1, 0), 0.5, 230.0, 2.0, "A"),
                               ((0, 0), 0.5, 250.0, 2.0, "B"), ((0, 3), 0.25, 230.0, 2.0, "B")), root)
    assert CE.refresh_cells(spark, root, path) == {"version": 1, "touched": 3, "recomputed": 0}
    _check(spark, root, path)
    # new readings only: one cell grows, one is new, none is computed anew
    merge_version(spark, _rows(spark, ((0, 6), 0.125, 230.0, 9.0, "A"), ((5, 0), 0.125, 230.0, 9.0, "C")), root)
    assert CE.refresh_cells(spark, root, path) == {"version": 2, "touched": 2, "recomputed": 0}
    _check(spark, root, path)
    # a correction withdraws A's highest power of the first hour, and B's worst reading
    merge_version(spark, _rows(spark, ((0, 6), 0.0625, 230.0, 1.0, "A"), ((0, 0), 0.25, 230.0, 2.0, "B")), root)
    assert CE.refresh_cells(spark, root, path) == {"version": 3, "touched": 2, "recomputed": 2}
    _check(spark, root, path)
    # a correction of a reading that holds no extreme is only added and taken off
    merge_version(spark, _rows(spark, ((0, 3), 0.25, 231.0, 2.0, "A")), root)
    assert CE.refresh_cells(spark, root, path) == {"version": 4, "touched": 1, "recomputed": 0}
    _check(spark, root, path)
    # files packed anew hold the same rows: no cell is touched
    assert compaction.compact(spark, root) > 0
    assert CE.refresh_cells(spark, root, path) == {"version": 5, "touched": 0, "recomputed": 0}
    _check(spark, root, path)
    assert _same(CE.fold_cells(spark, path).drop("v"), CE.read_cells(spark, path))


def test_cells_that_lose_every_reading_go(spark, tmp_dir):
    root, path = f"{tmp_dir}/t", f"{tmp_dir}/cells"
    rows = curate(_rows(spark, ((0, 0), 0.5, 230.0, 4.0, "A"), ((2, 0), 0.5, 230.0, 4.0, "B")))
    first = V.commit(spark, root, None, V.write_files(spark, rows, root))
    CE.refresh_cells(spark, root, path)
    V.commit(spark, root, first, V.write_files(spark, rows.filter("meter_id = 'A'"), root))
    assert CE.refresh_cells(spark, root, path) == {"version": 2, "touched": 1, "recomputed": 0}
    assert [r.meter_id for r in CE.read_cells(spark, path).collect()] == ["A"]


def test_an_unfinished_refresh_is_repeated(spark, tmp_dir, monkeypatch):
    import os
    root, path = f"{tmp_dir}/t", f"{tmp_dir}/cells"
    merge_version(spark, _rows(spark, ((0, 0), 0.5, 230.0, 4.0, "A")), root)
    CE.refresh_cells(spark, root, path)
    merge_version(spark, _rows(spark, ((0, 3), 0.5, 230.0, 5.0, "A")), root)
    CE.refresh_cells(spark, root, path)
    os.remove(f"{path}/v=2/_SUCCESS")   # as if the write had not ended
    assert CE.cells_version(spark, path) == 1
    assert CE.refresh_cells(spark, root, path)["touched"] == 1
    _check(spark, root, path)


def test_sketches_of_any_period_are_within_the_bound(spark):
    meters = 30_000
    rows = spark.range(meters * 8).select(
        F.timestamp_add("HOUR", (F.col("id") % 8 * 3 + F.hash("id") % 3).cast("int"), F.lit(dt.datetime(2020, 1, 2)).cast("timestamp_ntz")).alias("reading_ts"),
        F.format_string("m%06d", F.floor(F.col("id") / 8) % F.when(F.col("id") % 8 < 3, meters // 10).otherwise(meters)).alias("meter_id"),
        F.when(F.col("id") % 5 == 0, "CRITICAL").otherwise("HEALTHY").alias("health_status"))
    cells = SK.status_sketches(rows).cache()
    bound = 4 * 1.04 / 2 ** (SK.LG_K / 2)
    for since, until in ((None, None), ("2020-01-02 06:00:00", "2020-01-02 09:00:00"), ("2020-01-02", "2020-01-02 07:00:00")):
        exact = {r.health_status: r.n for r in SK.of_period(rows, since, until, "reading_ts").groupBy("health_status").agg(F.count_distinct("meter_id").alias("n")).collect()}
        got = {r.health_status: r.meters for r in SK.meters_by_status(SK.of_period(cells, since, until)).collect()}
        assert set(got) == set(exact) and all(abs(got[s] - n) <= bound * n + 0.5 for s, n in exact.items())
    total = SK.kpi_meters(cells).first()
    assert abs(total.total_meters - meters) <= bound * meters and total.meters_seen_warning == 0
    assert SK.kpi_meters(cells.limit(0)).first().total_meters == 0


def test_buckets(spark):
    values = [0, 1, 255, 256, 257, 511, 512, 515, 516, 1 << 40, (1 << 40) + 12345]
    got = [(r.low, r.mid) for r in spark.createDataFrame([(v,) for v in values], "u bigint")
           .select(SK.bucket(F.col("u")).alias("low"), SK.bucket_middle(SK.bucket(F.col("u"))).alias("mid")).collect()]
    for v, (low, mid) in zip(values, got):
        drop = max(v.bit_length() - SK.BITS, 0)
        assert low == v >> drop << drop and mid == low + ((1 << drop) - 1) / 2
        assert abs(mid - v) <= max(v, 1) * 2.0 ** -SK.BITS


@pytest.mark.parametrize("since,until", [(None, None), ("1994-01-01", "1995-01-01")])
def test_histogram_quantiles_meet_their_bounds(spark, since, until):
    table = curated_standin(spark, SF_SMALL).cache()
    cells = SK.value_histograms(table)
    days = SK.of_period(cells.withColumn("_t", F.col("reading_date").cast("timestamp_ntz")), since, until, "_t").drop("_t")
    rows = SK.of_period(table, since, until, "reading_ts")
    exact = {r["column"]: r for r in exact_quantiles(rows, probs=(0.25, 0.5, 0.75, 0.99)).collect()}
    got = {r["column"]: r for r in SK.histogram_quantiles(SK.merged_histograms(days), (0.25, 0.5, 0.75, 0.99)).collect()}
    assert set(got) == set(exact)
    for c, r in got.items():
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.99, "p99")):
            true = exact[c][name]
            # half a bucket, and half a unit of the column's decimals
            slack = true * 2.0 ** -SK.BITS + 0.5 * 10.0 ** -SK.DECIMALS[c] + 1e-6
            assert abs(r[name] - true) <= slack
            inside = rows.filter(F.col(c).between(true - 2 * slack, true + 2 * slack)).count()
            assert SK.rank_error(rows, c, r[name], p) <= inside / rows.count()


def test_histograms_can_be_taken_off(spark):
    table = curated_standin(spark, SF_SMALL)
    half = F.abs(F.hash("meter_id", "reading_ts")) % 2 == 0
    whole = SK.value_histograms(table)
    left = whole.unionByName(SK.value_histograms(table.filter(half)).withColumn("n", -F.col("n")))
    left = left.groupBy("reading_date", "column", "low").agg(F.sum("n").alias("n")).filter("n <> 0")
    assert _same(left, SK.value_histograms(table.filter(~half)))
