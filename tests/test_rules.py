"""Boundary tables for bands, score, status and rejects (FIXTURES.md F5), header variants, parsing."""
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from meterlake.operators.clean import clean, curate, typed_readings
from meterlake.sources.raw import normalize_columns

TS = "2020-01-01 00:03:00"

# V, A, Hz, kWh, voltage_band, current_band, score, status
F5 = [
    (240.01, 1.0, 50.0, 0.01, "OVER_VOLTAGE", "LIGHT_LOAD", 70.0, "CRITICAL"),
    (240.0, 9.0, 50.5, 0.01, "NORMAL", "MEDIUM_LOAD", 100.0, "HEALTHY"),
    (220.0, 9.01, 49.5, 0.01, "NORMAL", "HIGH_LOAD", 80.0, "HIGH_LOAD"),
    (219.99, 3.0, 50.0, 0.01, "LOW", "MEDIUM_LOAD", 90.0, "HEALTHY"),
    (200.0, 0.0, 50.0, 0.0005, "LOW", "NO_LOAD", 70.0, "POSSIBLE_METER_ISSUE"),
    (199.99, 2.99, 50.0, 0.0005, "CRITICAL_LOW", "LIGHT_LOAD", 55.0, "WARNING"),
    (0.0, 0.0, 0.0, 0.0, "CRITICAL_LOW", "NO_LOAD", 60.0, "WARNING"),
    (250.0, 10.0, 49.49, 0.0, "OVER_VOLTAGE", "HIGH_LOAD", 15.0, "CRITICAL"),
]


def _frame(spark, rows):
    return spark.createDataFrame(
        rows, "reading_ts string, energy_kwh string, avg_voltage string, avg_current string, "
              "frequency_hz string, meter_id string")


@pytest.mark.parametrize("v,a,hz,kwh,vband,cband,score,status", F5)
def test_f5_boundaries(spark, v, a, hz, kwh, vband, cband, score, status):
    row = curate(_frame(spark, [(TS, str(kwh), str(v), str(a), str(hz), "BR01")])).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.voltage_band, r.current_band, r.health_score, r.health_status) == (vband, cband, score, status)
    expected = (Decimal(str(v)) * Decimal(str(a)) / 1000).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
    assert r.power_kw == float(expected)


@pytest.mark.parametrize("v,a,hz,kwh", [(400.01, 1, 50, 0.01), (230, 1, 50, 50.01), (230, 200.5, 50, 0.1),
                                        (230, 1, 70.01, 0.1), (-1, 1, 50, 0.1)])
def test_out_of_range_rejected(spark, v, a, hz, kwh):
    assert curate(_frame(spark, [(TS, str(kwh), str(v), str(a), str(hz), "BR01")])).count() == 0


@pytest.mark.parametrize("bad", [None, "abc", "2020-13-01 00:00:00", "2020-01-01"])
def test_bad_timestamp_or_value_is_null(spark, bad):
    rows = [(bad, "0.01", "230", "1", "50", "BR01"), (TS, bad, "230", "1", "50", "BR02")]
    assert curate(_frame(spark, rows)).count() == 0


def test_nan_rejected(spark):
    assert curate(_frame(spark, [(TS, "NaN", "230", "1", "50", "BR01")])).count() == 0


def test_timestamp_parse_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = typed_readings(_frame(spark, [("2020-03-08 02:30:00", "1", "230", "1", "50", " MH7 ")])).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert str(r.reading_ts) == "2020-03-08 02:30:00"
    assert r.meter_id == "MH7"


def test_time_attributes(spark):
    r = curate(_frame(spark, [("2021-10-31 23:57:00", "0.1", "230", "1", "50", "BR01")])).collect()[0]
    assert (r.year, r.month, r.day, r.hour, r.day_of_week, r.is_weekend) == (2021, 10, 31, 23, "Sunday", True)


def test_header_variants(spark):
    cols = ["X_Timestamp ", " t_KWH", "z_avg_voltage_(volt)", "z_avg current (amp)", "Y_FREQ (HZ)", "meter"]
    df = spark.createDataFrame([(TS, "0.1", "230", "1", "50", "BR01")], cols)
    out = normalize_columns(df)
    assert out.columns == ["reading_ts", "energy_kwh", "avg_voltage", "avg_current", "frequency_hz", "meter_id"]


def test_missing_column_raises(spark):
    df = spark.createDataFrame([(TS, "0.1", "230", "1", "50")], ["x_Timestamp", "t_kWh", "z_Avg Voltage (Volt)",
                                                                  "z_Avg Current (Amp)", "y_Freq (Hz)"])
    with pytest.raises(ValueError, match="meter_id"):
        normalize_columns(df)


def test_duplicates_keep_lowest_and_good_copy(spark):
    rows = [
        (TS, "0.2", "230", "1", "50", "BR01"), (TS, "0.1", "231", "1", "50", "BR01"),   # good + good → 0.1 kept
        (TS, "0.3", "999", "1", "50", "BR02"), (TS, "0.4", "230", "1", "50", "BR02"),   # bad + good → good kept
        (TS, "0.5", "230", "1", "50", "BR03"), (TS, "0.5", "230", "1", "50", "BR03"),   # exact copies
    ]
    got = {r.meter_id: r.energy_kwh for r in clean(_frame(spark, rows)).collect()}
    assert got == {"BR01": 0.1, "BR02": 0.4, "BR03": 0.5}


def test_dedup_first_order_loses_key_with_bad_survivor(spark):
    # script order: de-dup first (lowest copy 0.3/999 V survives), then the range check drops the key
    rows = [(TS, "0.3", "999", "1", "50", "BR02"), (TS, "0.4", "230", "1", "50", "BR02")]
    assert clean(_frame(spark, rows), order="dedup_first").count() == 0
    assert clean(_frame(spark, rows), order="filter_first").count() == 1


def test_score_range_on_standin(spark):
    from meterlake.testdata import curated_standin
    r = curated_standin(spark, "/root/testdata/sf0.001").agg(F.min("health_score"), F.max("health_score")).collect()[0]
    assert 15.0 <= r[0] <= r[1] <= 100.0


@pytest.mark.parametrize("text", ["2020-02-30 00:00:00", "2020-01-01T00:03:00", "2020-01-01 24:00:00",
                                  "2020-1-01 00:03:00", "2020-01-01 00:03:00.5", "20200101 00:03:00",
                                  "2020-01-01 00:3:00", "+2020-01-01 00:03"])
def test_timestamp_must_match_format(spark, text):
    from meterlake.functions.wallclock import parse_wallclock
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_wallclock(F.col("s"), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()[0].t is None


def test_timestamp_other_format(spark):
    from meterlake.functions.wallclock import parse_wallclock
    df = spark.createDataFrame([("01/02/2020 13:45",)], "s string")
    r = df.select(parse_wallclock(F.col("s"), "dd/MM/yyyy HH:mm").alias("t")).collect()[0]
    assert str(r.t) == "2020-02-01 13:45:00"


def test_power_band_rounded_vs_unrounded(spark):
    """The two job forms differ only where rounding to 4 decimals crosses a band edge (C3)."""
    from dataclasses import replace
    from meterlake.rules import RULES
    rows = [(TS, "0.1", "200.0005", "10.0", "50", "BR01"),   # 2.000005 kW → rounds to 2.0: MEDIUM vs HIGH
            (TS, "0.1", "230", "0.0000004", "50", "BR02"),   # 9.2e-8 kW → rounds to 0: IDLE vs LOW
            (TS, "0.1", "230", "5", "50", "BR03")]           # 1.15 kW either way
    script = {r.meter_id: r.power_band for r in curate(_frame(spark, rows)).collect()}
    sql_form = {r.meter_id: r.power_band
                for r in curate(_frame(spark, rows), replace(RULES, power_band_on_rounded=False)).collect()}
    assert script == {"BR01": "MEDIUM", "BR02": "IDLE", "BR03": "MEDIUM"}
    assert sql_form == {"BR01": "HIGH", "BR02": "LOW", "BR03": "MEDIUM"}
