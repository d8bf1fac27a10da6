"""Smoothing, seasonal extremes, the bracketed peak threshold and the latest partition."""
import datetime as dt
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from meterlake.operators.anomaly import anomaly_series
from meterlake.operators.extremes import seasonal_extremes
from meterlake.operators.regression import forecast_grouped
from meterlake.operators.smoothing import ALPHAS, BETAS, smoothing_forecast
from meterlake.plans import common, health, insights
from meterlake.sources.curated import latest_partition


def plain_smoothing(points, horizon):
    best = None
    for place, (a, b) in enumerate((a, b) for a in ALPHAS for b in BETAS):
        (last, level), trend, sse = points[0], 0.0, 0.0
        for x, y in points[1:]:
            ahead = level + trend * (x - last)
            error = y - ahead
            level, trend, sse, last = ahead + a * error, trend + a * b * error / (x - last), sse + error * error, x
        best = min(best, (sse, place, a, b, level, trend)) if best else (sse, place, a, b, level, trend)
    sse, _, a, b, level, trend = best
    out = []
    for h in range(1, horizon + 1):
        grown = 1 + sum((a * (1 + b * j)) ** 2 for j in range(1, h))
        half = statistics.NormalDist().inv_cdf(0.95) * (sse / (len(points) - 1) * grown) ** 0.5
        out.append((last + h, level + trend * h, half))
    return out


def test_smoothing_equals_the_plain_recursion_and_follows_a_level_change(spark):
    r = random.Random(2)
    series = {"flat": [(x, 10 + r.random()) for x in range(40)], "gaps": [(x, 5 + 0.3 * x + r.random()) for x in range(40) if x % 7],
              "step": [(x, (10 if x < 24 else 30) + r.random()) for x in range(36)], "short": [(0, 1.0), (1, 2.0)]}
    rows = [(k, x, y, "clash") for k, p in series.items() for x, y in p] + [("flat", None, 1.0, "c"), ("flat", 50, None, "c")]
    df = spark.createDataFrame(rows, "k string, x bigint, y double, points string").repartition(5)
    got = {(g.k, g.x_future): (g.forecast, g.upper - g.forecast) for g in smoothing_forecast(df, ["k"], "x", "y", 3).collect()}
    assert {k for k, _ in got} == {"flat", "gaps", "step"}
    for k in ("flat", "gaps", "step"):
        for x, value, half in plain_smoothing(series[k], 3):
            assert got[k, x] == pytest.approx((value, half), rel=1e-9)
    line = {(g.k, g.x_future): g.forecast for g in forecast_grouped(df.filter("y IS NOT NULL AND x IS NOT NULL"), ["k"], "x", "y", 3, 0.9).collect()}
    missed = [sum(abs(v - 30.5) for v in forecast) for forecast in ([got["step", x][0] for x in (36, 37, 38)], [line["step", x] for x in (36, 37, 38)])]
    assert missed[0] < 0.5 * missed[1], missed


def plain_extremes(rows, deviates=3.5, share=0.1):
    usual = {}
    for d, y in rows:
        usual.setdefault(d.weekday(), []).append(y)
    usual = {w: statistics.median(v) for w, v in usual.items()}
    left = sorted((y - usual[d.weekday()], d, y) for d, y in rows)
    gone = []
    for _ in range(int(len(rows) * share)):
        c = statistics.median(v[0] for v in left)
        s = 1.4826 * statistics.median(abs(v[0] - c) for v in left)
        above, below = left[-1][0] - c, c - left[0][0]
        if s <= 0 or max(above, below) <= deviates * s:
            break
        gone.append(left.pop(0 if below > above else -1))
    return {d for _, d, _ in gone} if len(rows) >= 14 else set()


def test_extremes_equal_the_plain_removal_and_find_masked_pairs(spark):
    r = random.Random(8)
    day = dt.date(2020, 1, 6)
    series = {}
    for k in range(12):
        n = r.choice([5, 14, 60, 200])
        series[f"s{k}"] = [(day + dt.timedelta(days=i), 10 + 5 * (i % 7 >= 5) + r.gauss(0, 0.5) + (r.random() < 0.06) * r.choice([-9, 8, 30])) for i in range(n)]
    series["flat"] = [(day + dt.timedelta(days=i), 3.0) for i in range(30)]
    # an outlier inflates the rolling deviation and hides the one that follows it
    series["masked"] = [(day + dt.timedelta(days=i), 10 + 0.1 * (i % 3) + (60.0 if i == 40 else 9.0 if i == 45 else 0.0)) for i in range(70)]
    rows = [(k, d, y, 1) for k, v in series.items() for d, y in v] + [("s0", None, 1.0, 1), ("s0", day, None, 1)]
    df = spark.createDataFrame(rows, "k string, d date, y double, expected int").drop("expected").repartition(4)
    got = {}
    for g in seasonal_extremes(df, ["k"], "d", "y").collect():
        got.setdefault(g.k, {})[g.d] = g
    for k, v in series.items():
        assert set(got.get(k, {})) == plain_extremes(v)
        assert all(abs(g.deviate) > 3.5 and g.y == dict(v)[g.d] for g in got.get(k, {}).values())
    pair = {day + dt.timedelta(days=40), day + dt.timedelta(days=45)}
    rolling = {g.d for g in anomaly_series(df.filter("k = 'masked' AND d IS NOT NULL AND y IS NOT NULL"), ["k"], "d", "y", n=None).collect()}
    assert pair <= set(got["masked"]) and day + dt.timedelta(days=45) not in rolling
    assert seasonal_extremes(df.limit(0), ["k"], "d", "y").collect() == []


def test_peak_threshold_is_the_exact_quantile(spark, monkeypatch):
    r = random.Random(4)
    for bracket in (10_000, 50):   # a wide bracket holds many values, ties among them
        monkeypatch.setattr(insights, "BRACKET", bracket)
        for q in (0.0, 0.25, 0.9, 0.99, 1.0):
            values = [r.choice([1.0, 2.0, 2.0, 3.5]) if r.random() < 0.5 else r.randint(0, 400) / 16 for _ in range(700)]
            t = [dt.datetime(2020, 1, 1) + dt.timedelta(minutes=3 * i) for i in range(700)]
            df = spark.createDataFrame(list(zip(t, values)), "reading_ts timestamp_ntz, power_kw double") \
                .selectExpr("reading_ts", "power_kw", "concat('m', cast(minute(reading_ts) as string)) AS meter_id", "2020 AS year", "1 AS month")
            got = insights.a6_peak_contributors(df, q, n=None).agg(F.sum("peak_intervals")).first()[0]
            limit = sorted(values)[max(1, -(-int(q * 100) * 700 // 100)) - 1]
            assert got == sum(v >= limit for v in values)
    assert insights.a6_peak_contributors(df.limit(0)).collect() == []


def test_peak_contributors_scan_the_readings_twice_and_run_few_jobs(spark, tmp_dir):
    df = spark.range(5000).selectExpr("timestamp_ntz '2020-01-01' + make_dt_interval(0, 0, cast(id % 500 as int) * 3) AS reading_ts",
                                      "cast(id % 97 as double) / 16 AS power_kw", "concat('m', id % 10) AS meter_id", "2020 AS year", "1 AS month")
    df.write.parquet(f"{tmp_dir}/t")
    sc = spark.sparkContext
    sc.setJobGroup("peaks", "peaks")
    try:
        insights.a6_peak_contributors(spark.read.schema(df.schema).parquet(f"{tmp_dir}/t"))
        first = len(sc.statusTracker().getJobIdsForGroup("peaks"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert first <= 2   # one write with its shuffle; nothing else runs before the result is asked for


def test_latest_partition_is_read_from_folder_names(spark, tmp_dir):
    assert latest_partition(spark, f"{tmp_dir}/none") is None
    rows = spark.createDataFrame([(1, 2019, 12), (2, 2020, 2), (3, 2020, 11)], "v int, year int, month int")
    rows.write.partitionBy("year", "month").parquet(f"{tmp_dir}/t")
    assert latest_partition(spark, f"{tmp_dir}/t") == (2020, 11)
    os.makedirs(f"{tmp_dir}/t/year=2021/month=3")   # a folder left without files
    assert latest_partition(spark, f"{tmp_dir}/t") == (2020, 11)
    table = spark.read.parquet(f"{tmp_dir}/t")
    for period, n in (("year", 2), ("month", 1), ("all", 3)):
        assert common.latest_period(table, period, (2020, 11)).count() == common.latest_period(table, period).count() == n
    plan = common.latest_period(table, "month", (2020, 11))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "subquery" not in plan.lower()
    with pytest.raises(ValueError):
        health.latest_period(table, "week")
