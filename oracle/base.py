"""Shared DuckDB CTEs: stand-in readings from ``lineitem``, cleaning, curated columns.

The band, score and status ladders state fixed thresholds in the order that the rules dictate; the rest is
written from the survey's definitions. Spark's results and these must agree row for row.
"""
from __future__ import annotations


def R(x: str, n: int) -> str:
    """Half-up rounding through DECIMAL(38,12), result DOUBLE (same rule as ``meterlake.functions.rnd``)."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def DIV(a: str, b: str) -> str:
    """a / NULLIF(b, 0) in double."""
    return f"(CAST(({a}) AS DOUBLE) / NULLIF(CAST(({b}) AS DOUBLE), 0))"


RAW_CTES = f"""
li AS (
  SELECT l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln,
         l_quantity AS qty, l_tax AS tax, l_shipdate AS ship,
         (l_orderkey * 7 + l_linenumber * 131 + l_partkey) % 480 AS o
  FROM lineitem
),
gen AS (
  SELECT ship + to_minutes(CAST(3 * o AS INTEGER)) AS reading_ts,
    CASE WHEN (ok + ln) % 29 = 0 THEN {D(0)}
         ELSE qty / (CASE WHEN sk % 3 = 0 THEN {D(8192)} WHEN sk % 3 = 1 THEN {D(2048)} ELSE {D(512)} END)
                  * (CASE WHEN sk % 5 = 0 AND o >= 360 THEN {D(8)} ELSE {D(1)} END)
                  * (CASE WHEN sk % 7 = 3 AND ok % 31 = 0 THEN {D(64)} ELSE {D(1)} END)
    END AS energy_kwh,
    CASE WHEN (ok + pk) % 997 = 0 THEN {D(450)}
         WHEN (ok + ln) % 23 = 0 THEN {D(0)}
         ELSE {D(190)} + {D('(pk * 37 + ok * 11 + ln) % 560')} * {D(0.125)}
    END AS avg_voltage,
    CASE WHEN ok % 499 = 0 THEN CAST(NULL AS DOUBLE)
         ELSE {D('CAST(round(tax * 100.0) AS INTEGER)')} * {D(1.5)}
    END AS avg_current,
    CASE WHEN (ok + ln) % 23 = 0 THEN {D(0)}
         ELSE {D(49.25)} + {D('(ok * 13 + ln) % 100')} / {D(64)}
    END AS frequency_hz,
    (CASE WHEN sk % 2 = 0 THEN 'BR' ELSE 'MH' END) || lpad(CAST(sk AS VARCHAR), CAST(greatest(4, length(CAST(sk AS VARCHAR))) AS INTEGER), '0') AS meter_id,
    (ok * 3 + ln) % 211 = 0 AS dup
  FROM li
),
raw AS (
  SELECT reading_ts, energy_kwh, avg_voltage, avg_current, frequency_hz, meter_id FROM gen
  UNION ALL
  SELECT reading_ts, {D(0.5)}, {D(230)}, {D(1.5)}, {D(50)}, meter_id FROM gen WHERE dup
),
valid AS (
  SELECT * FROM raw
  WHERE reading_ts IS NOT NULL AND energy_kwh IS NOT NULL AND avg_voltage IS NOT NULL
    AND avg_current IS NOT NULL AND frequency_hz IS NOT NULL AND meter_id IS NOT NULL
    AND energy_kwh BETWEEN 0 AND 50 AND avg_voltage BETWEEN 0 AND 400
    AND avg_current BETWEEN 0 AND 200 AND frequency_hz BETWEEN 0 AND 70
),
dedup AS (
  SELECT reading_ts, energy_kwh, avg_voltage, avg_current, frequency_hz, meter_id FROM (
    SELECT *, row_number() OVER (PARTITION BY meter_id, reading_ts
                                 ORDER BY energy_kwh, avg_voltage, avg_current, frequency_hz) AS rn
    FROM valid) WHERE rn = 1
)"""


def enrich_sql(src: str) -> str:
    """SELECT list turning base readings from ``src`` into curated rows."""
    return f"""
  SELECT reading_ts, energy_kwh, avg_voltage, avg_current, frequency_hz, meter_id,
    CAST(day(reading_ts) AS INTEGER) AS day, CAST(hour(reading_ts) AS INTEGER) AS hour,
    dayname(reading_ts) AS day_of_week, dayofweek(reading_ts) IN (0, 6) AS is_weekend,
    power_kw,
    CASE WHEN avg_voltage > 240 THEN 'OVER_VOLTAGE' WHEN avg_voltage >= 220 THEN 'NORMAL'
         WHEN avg_voltage >= 200 THEN 'LOW' ELSE 'CRITICAL_LOW' END AS voltage_band,
    CASE WHEN avg_current > 9 THEN 'HIGH_LOAD' WHEN avg_current >= 3 THEN 'MEDIUM_LOAD'
         WHEN avg_current > 0 THEN 'LIGHT_LOAD' ELSE 'NO_LOAD' END AS current_band,
    CASE WHEN power_kw > 2.0 THEN 'HIGH' WHEN power_kw >= 0.5 THEN 'MEDIUM'
         WHEN power_kw > 0 THEN 'LOW' ELSE 'IDLE' END AS power_band,
    greatest({D(0)}, {D(100)}
      - CASE WHEN avg_voltage > 240 THEN {D(30)} WHEN avg_voltage < 200 THEN {D(25)}
             WHEN avg_voltage < 220 THEN {D(10)} ELSE {D(0)} END
      - CASE WHEN avg_current > 9 THEN {D(20)} ELSE {D(0)} END
      - CASE WHEN frequency_hz < 49.5 OR frequency_hz > 50.5 THEN {D(15)} ELSE {D(0)} END
      - CASE WHEN energy_kwh <= 0.0005 AND avg_voltage > 100 THEN {D(20)} ELSE {D(0)} END) AS health_score,
    CASE WHEN avg_voltage > 240 THEN 'CRITICAL' WHEN avg_voltage < 200 THEN 'WARNING'
         WHEN avg_current > 9 THEN 'HIGH_LOAD'
         WHEN energy_kwh <= 0.0005 AND avg_voltage > 100 THEN 'POSSIBLE_METER_ISSUE'
         ELSE 'HEALTHY' END AS health_status,
    CAST(year(reading_ts) AS INTEGER) AS year, CAST(month(reading_ts) AS INTEGER) AS month
  FROM (SELECT *, {R('avg_voltage * avg_current / ' + D(1000), 4)} AS power_kw FROM {src})"""


CURATED_CTES = RAW_CTES + f""",
cur AS ({enrich_sql('dedup')}
)"""

CURATED_COLUMNS_SQL = ("reading_ts, energy_kwh, avg_voltage, avg_current, frequency_hz, meter_id, day, hour, "
                       "day_of_week, is_weekend, power_kw, voltage_band, current_band, power_band, "
                       "health_score, health_status, year, month")


def with_curated(body: str, ctes: str = "") -> str:
    """Full statement: the curated CTE chain, optional extra CTEs, then ``body``."""
    extra = f",\n{ctes}" if ctes.strip() else ""
    return f"WITH {CURATED_CTES}{extra}\n{body}"


def with_raw(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes}" if ctes.strip() else ""
    return f"WITH {RAW_CTES}{extra}\n{body}"
