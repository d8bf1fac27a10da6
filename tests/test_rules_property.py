"""Bands, score and status against a plain-Python statement of the rules, on random readings."""
from hypothesis import given, settings, strategies as st

from meterlake.operators.clean import enrich
from meterlake.rules import RULES


def expected(v, a, hz, kwh, r=RULES):
    vband = ("OVER_VOLTAGE" if v > r.over_voltage else "NORMAL" if v >= r.normal_voltage_min
             else "LOW" if v >= r.low_voltage_min else "CRITICAL_LOW")
    cband = ("HIGH_LOAD" if a > r.high_load_amps else "MEDIUM_LOAD" if a >= r.medium_load_amps
             else "LIGHT_LOAD" if a > 0 else "NO_LOAD")
    dead = kwh <= r.dead_kwh_max and v > r.dead_voltage_min
    pen = (r.penalty_over_voltage if v > r.over_voltage else r.penalty_critical_low if v < r.low_voltage_min
           else r.penalty_low_voltage if v < r.normal_voltage_min else 0.0)
    pen += r.penalty_over_current if a > r.high_load_amps else 0.0
    pen += r.penalty_frequency if (hz < r.frequency_band[0] or hz > r.frequency_band[1]) else 0.0
    pen += r.penalty_dead_meter if dead else 0.0
    score = max(r.score_floor, r.score_start - pen)
    status = ("CRITICAL" if v > r.over_voltage else "WARNING" if v < r.low_voltage_min
              else "HIGH_LOAD" if a > r.high_load_amps else "POSSIBLE_METER_ISSUE" if dead else "HEALTHY")
    return vband, cband, score, status


# values on a 0.01 grid around every threshold, plus the exact boundaries
volts = st.one_of(st.integers(0, 40000).map(lambda i: i / 100), st.sampled_from([0.0, 100.0, 200.0, 220.0, 240.0]))
amps = st.one_of(st.integers(0, 2000).map(lambda i: i / 100), st.sampled_from([0.0, 3.0, 9.0]))
freq = st.one_of(st.integers(0, 7000).map(lambda i: i / 100), st.sampled_from([49.5, 50.5]))
energy = st.one_of(st.integers(0, 5000).map(lambda i: i / 10000), st.sampled_from([0.0, 0.0005]))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(volts, amps, freq, energy), min_size=1, max_size=40))
def test_rules_match_plain_python(spark, rows):
    data = [(f"2020-01-01 00:{i % 60:02d}:00", kwh, v, a, hz, f"BR{i:04d}") for i, (v, a, hz, kwh) in enumerate(rows)]
    df = spark.createDataFrame(data, "reading_ts string, energy_kwh double, avg_voltage double, avg_current double, "
                                     "frequency_hz double, meter_id string")
    df = df.selectExpr("CAST(reading_ts AS timestamp_ntz) AS reading_ts", "energy_kwh", "avg_voltage", "avg_current",
                       "frequency_hz", "meter_id")
    got = {r.meter_id: (r.voltage_band, r.current_band, r.health_score, r.health_status) for r in enrich(df).collect()}
    for i, (v, a, hz, kwh) in enumerate(rows):
        assert got[f"BR{i:04d}"] == expected(v, a, hz, kwh), (v, a, hz, kwh)
