"""Oracle SQL for sources, sinks, per-reading derivations, filters, de-duplication and quality."""
from __future__ import annotations

from .base import CURATED_COLUMNS_SQL, R, with_curated, with_raw

BASE = "reading_ts, energy_kwh, avg_voltage, avg_current, frequency_hz, meter_id"
NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in BASE.split(", "))
IN_RANGE = ("energy_kwh BETWEEN 0 AND 50 AND avg_voltage BETWEEN 0 AND 400 "
            "AND avg_current BETWEEN 0 AND 200 AND frequency_hz BETWEEN 0 AND 70")
CLASSIFIED = f"""d AS (SELECT {BASE}, count(*) AS copies FROM raw GROUP BY ALL),
c AS (SELECT *, CASE WHEN NOT ({NOT_NULL}) THEN 'null' WHEN NOT ({IN_RANGE}) THEN 'out_of_range' END AS reason FROM d)"""
REJECTS = f"""{CLASSIFIED},
bad AS (SELECT {BASE}, reason AS reject_reason, copies FROM c WHERE reason IS NOT NULL),
rk AS (SELECT *, row_number() OVER (PARTITION BY meter_id, reading_ts
                                    ORDER BY energy_kwh, avg_voltage, avg_current, frequency_hz) AS rn
       FROM c WHERE reason IS NULL),
dups AS (SELECT {BASE}, 'duplicate' AS reject_reason, CASE WHEN rn = 1 THEN copies - 1 ELSE copies END AS copies FROM rk),
rej AS (SELECT * FROM bad UNION ALL SELECT * FROM dups WHERE copies > 0)"""
NUMERIC = ("energy_kwh", "avg_voltage", "avg_current", "frequency_hz", "power_kw", "health_score")


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    raw_rows = with_raw(f"SELECT {BASE} FROM raw")
    for k in ("read_raw_csv", "normalize_columns", "typed_readings"):
        q[k] = raw_rows
    cur_rows = with_curated(f"SELECT {CURATED_COLUMNS_SQL} FROM cur")
    for k in ("write_curated", "register_table", "curate"):
        q[k] = cur_rows
    q["read_curated"] = with_curated(f"""SELECT {CURATED_COLUMNS_SQL} FROM cur
WHERE reading_ts >= TIMESTAMP '1997-03-15 00:00:00' AND reading_ts < TIMESTAMP '1999-07-01 00:00:00'""")
    q["write_clean_csv"] = with_raw(f"SELECT {BASE} FROM dedup")
    q["dedup_key"] = with_raw(f"SELECT {BASE} FROM dedup")
    q["row_count_metric"] = with_curated("SELECT count(*) AS rows_written FROM cur")
    for k, cols in {
        "time_attributes": "meter_id, reading_ts, year, month, day, hour, day_of_week, is_weekend",
        "power_kw": "meter_id, reading_ts, avg_voltage, avg_current, power_kw",
        "voltage_band": "meter_id, reading_ts, avg_voltage, voltage_band",
        "current_band": "meter_id, reading_ts, avg_current, current_band",
        "power_band": "meter_id, reading_ts, power_kw, power_band",
        "health_score": "meter_id, reading_ts, health_score",
        "health_status": "meter_id, reading_ts, health_status",
        "town": "meter_id, reading_ts, substr(meter_id, 1, 2) AS town",
    }.items():
        q[k] = with_curated(f"SELECT {cols} FROM cur")
    q["drop_nulls"] = with_raw(f"SELECT {BASE} FROM raw WHERE {NOT_NULL}")
    q["range_filter"] = with_raw(f"SELECT {BASE} FROM raw WHERE {IN_RANGE}")
    q["dedup_exact"] = with_raw(f"SELECT DISTINCT {BASE} FROM raw")
    q["quality_report"] = with_raw("""
SELECT counts.source, rows_in, CAST(exact + coalesce(keydup, 0) AS BIGINT) AS dupes, nulls, out_of_range,
       coalesce(rows_out, 0) AS rows_out, coalesce(meters, 0) AS meters, min_ts, max_ts
FROM counts LEFT JOIN o USING (source)""", f"""ds AS (SELECT substr(meter_id, 1, 2) AS source, {BASE}, count(*) AS copies FROM raw GROUP BY ALL),
cs AS (SELECT *, CASE WHEN NOT ({NOT_NULL}) THEN 'null' WHEN NOT ({IN_RANGE}) THEN 'out_of_range' END AS reason FROM ds),
counts AS (SELECT source, CAST(sum(copies) AS BIGINT) AS rows_in, CAST(sum(copies - 1) AS BIGINT) AS exact,
                  count(*) FILTER (WHERE reason = 'null') AS nulls,
                  count(*) FILTER (WHERE reason = 'out_of_range') AS out_of_range
           FROM cs GROUP BY source),
k AS (SELECT source, meter_id, reading_ts, count(*) AS variants FROM cs WHERE reason IS NULL GROUP BY 1, 2, 3),
o AS (SELECT source, count(*) AS rows_out, sum(variants - 1) AS keydup, count(DISTINCT meter_id) AS meters,
             min(reading_ts) AS min_ts, max(reading_ts) AS max_ts FROM k GROUP BY source)""")
    q["rejects"] = with_raw(f"SELECT {BASE}, reject_reason, copies FROM rej", REJECTS)
    parts = []
    for c in NUMERIC:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, {R(f'avg({c})', 6)} AS mean,
       {R(f'stddev_samp({c})', 6)} AS std, CAST(min({c}) AS DOUBLE) AS min,
       CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS p50,
       CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM cur""")
    q["summary_stats"] = with_curated("\nUNION ALL\n".join(parts))
    q["summary_ids"] = with_curated("""
SELECT 'meter_id' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
       (SELECT meter_id FROM per ORDER BY n DESC, meter_id LIMIT 1) AS top, max(n) AS freq FROM per""",
                                    "per AS (SELECT meter_id, count(*) AS n FROM cur GROUP BY 1)")
    q["curated_checks"] = with_curated(f"""
SELECT rows_in, rejected, rows_out, rows_in = rows_out + rejected AS balance_ok, null_partitions,
       {R('v', 3)} AS mean_voltage, {R('hz', 3)} AS mean_frequency_hz,
       v BETWEEN 230 AND 250 AS voltage_ok, hz BETWEEN 49.5 AND 50.5 AS frequency_ok
FROM (SELECT count(*) AS rows_in FROM raw),
     (SELECT CAST(coalesce(sum(copies), 0) AS BIGINT) AS rejected FROM rej),
     (SELECT count(*) AS rows_out, count(*) FILTER (WHERE year IS NULL OR month IS NULL) AS null_partitions,
             avg(CASE WHEN avg_voltage > 0 THEN avg_voltage END) AS v,
             avg(CASE WHEN frequency_hz > 0 THEN frequency_hz END) AS hz FROM cur)""", REJECTS)
    q["completeness"] = with_curated(f"""
SELECT days.meter_id, days.reading_date, coalesce(cnt.readings, 0) AS readings,
       {R('100.0::DOUBLE * coalesce(cnt.readings, 0) / 480.0::DOUBLE', 1)} AS completeness_pct
FROM days LEFT JOIN cnt ON days.meter_id = cnt.meter_id AND days.reading_date = cnt.d
WHERE coalesce(cnt.readings, 0) < 432""", """cnt AS (SELECT meter_id, CAST(reading_ts AS DATE) AS d, count(*) AS readings FROM cur GROUP BY 1, 2),
span AS (SELECT meter_id, min(d) AS a, max(d) AS b FROM cnt GROUP BY 1),
days AS (SELECT meter_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS reading_date FROM span)""")
    return q
