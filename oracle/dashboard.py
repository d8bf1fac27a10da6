"""Oracle SQL for the hourly rollup, dashboard feeds, filters and the generic forecast/anomaly operators."""
from __future__ import annotations

from statistics import NormalDist

from .base import DIV, R, with_curated

Z90 = NormalDist().inv_cdf(0.95)

ROLLUP = """hourly AS (
  SELECT meter_id, date_trunc('hour', reading_ts) AS hour_ts, sum(energy_kwh) AS energy_kwh,
         avg(avg_voltage) AS avg_voltage, avg(avg_current) AS avg_current,
         CAST(sum(CAST(round(power_kw * 10000.0) AS BIGINT)) AS DOUBLE) / count(*) / 10000.0::DOUBLE AS avg_power_kw,
         max(power_kw) AS peak_power_kw, avg(health_score) AS health_score,
         min(struct_pack(s := health_score,
                         r := CASE health_status WHEN 'CRITICAL' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'HIGH_LOAD' THEN 2
                                                 WHEN 'POSSIBLE_METER_ISSUE' THEN 3 ELSE 4 END,
                         st := health_status)).st AS worst_health_status,
         count(*) AS readings
  FROM cur GROUP BY 1, 2),
roll AS (
  SELECT meter_id, CAST(year(hour_ts) AS INTEGER) AS year, CAST(month(hour_ts) AS INTEGER) AS month,
         CAST(day(hour_ts) AS INTEGER) AS day, CAST(hour(hour_ts) AS INTEGER) AS hour,
         dayname(hour_ts) AS day_of_week, dayofweek(hour_ts) IN (0, 6) AS is_weekend, hour_ts,
         energy_kwh, avg_voltage, avg_current, avg_power_kw, peak_power_kw, health_score, worst_health_status, readings
  FROM hourly)"""

DAY = "CAST(hour_ts AS DATE)"
MONTH = "CAST(date_trunc('month', hour_ts) AS DATE)"


def _forecast(series: str, horizon: int, keys: str = "") -> str:
    """CTEs fit/steps/calc over ``series`` (keys…, x, kwh). ``keys`` like 'meter_id, '."""
    z = f"CAST('{Z90!r}' AS DOUBLE)"
    group = f"GROUP BY {keys.rstrip(', ')}" if keys else ""
    return f"""fit AS (
  SELECT {keys}regr_count(kwh, x) AS n, regr_slope(kwh, x) AS b1, regr_intercept(kwh, x) AS b0,
         regr_sxx(kwh, x) AS sxx, regr_syy(kwh, x) AS syy, regr_sxy(kwh, x) AS sxy, regr_avgx(kwh, x) AS xbar,
         max(x) AS last_x
  FROM {series} {group} HAVING regr_count(kwh, x) >= 3),
steps AS (SELECT *, CAST(unnest(range(1, {horizon + 1})) AS INTEGER) AS step FROM fit),
calc AS (
  SELECT *, last_x + step AS xf, b0 + b1 * CAST(last_x + step AS DOUBLE) AS yhat,
         {z} * sqrt(greatest(0.0::DOUBLE, syy - sxy * sxy / sxx) / (n - 2))
           * sqrt(1.0::DOUBLE + 1.0::DOUBLE / n
                  + (CAST(last_x + step AS DOUBLE) - xbar) * (CAST(last_x + step AS DOUBLE) - xbar) / sxx) AS half
  FROM steps)"""


def _month_of(xf: str) -> str:
    return f"make_date(CAST({xf} // 12 AS BIGINT), CAST({xf} % 12 + 1 AS BIGINT), 1)"


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    wr = lambda body, ctes="": with_curated(body, ROLLUP + (",\n" + ctes if ctes else ""))
    q["hourly_rollup"] = wr("SELECT * FROM roll")
    q["worst_status"] = wr("SELECT meter_id, hour_ts, worst_health_status FROM roll")
    q["d01_kpi_tiles"] = wr(f"""
SELECT count(DISTINCT meter_id) AS total_meters,
       count(DISTINCT CASE WHEN worst_health_status = 'HEALTHY' THEN meter_id END) AS healthy_meters,
       count(DISTINCT CASE WHEN worst_health_status = 'WARNING' THEN meter_id END) AS warning_meters,
       count(DISTINCT CASE WHEN worst_health_status = 'CRITICAL' THEN meter_id END) AS critical_meters,
       {R(f'sum(energy_kwh) / count(DISTINCT {DAY}) / count(DISTINCT meter_id)', 3)} AS avg_daily_kwh,
       {R('avg(avg_voltage)', 2)} AS avg_voltage, {R('avg(avg_current)', 3)} AS avg_current
FROM roll""")
    q["d02_health_gauge"] = wr(f"""
SELECT avg_health_score,
       CASE WHEN avg_health_score < 60 THEN 'red' WHEN avg_health_score > 80 THEN 'green' ELSE 'amber' END AS gauge_band
FROM (SELECT {R('avg(health_score)', 2)} AS avg_health_score FROM roll)""")
    pie = "SELECT worst_health_status, count(DISTINCT meter_id) AS meters FROM roll GROUP BY 1"
    q["d03_health_pie"] = wr(pie)
    q["d06_status_bar"] = wr(pie)
    q["d04_monthly_line"] = wr(f"SELECT {MONTH} AS month_start, {R('sum(energy_kwh)', 3)} AS total_kwh FROM roll GROUP BY 1")
    mon = f"mon AS (SELECT {MONTH} AS month_start, sum(energy_kwh) AS kwh FROM roll GROUP BY 1)"
    mser = "mser AS (SELECT year(month_start) * 12 + month(month_start) - 1 AS x, kwh FROM mon)"
    q["d05_monthly_forecast"] = wr(f"""
SELECT {_month_of('xf')} AS period, step, {R('yhat', 2)} AS forecast_kwh, {R('yhat - half', 2)} AS lower_kwh,
       {R('yhat + half', 2)} AS upper_kwh FROM calc""", f"{mon},\n{mser},\n{_forecast('mser', 3)}")
    q["d07_daily_line"] = wr(f"SELECT {DAY} AS day, {R('sum(energy_kwh)', 3)} AS total_kwh FROM roll GROUP BY 1")
    dser = (f"dd AS (SELECT {DAY} AS day, sum(energy_kwh) AS kwh FROM roll GROUP BY 1),\n"
            "dser AS (SELECT CAST(date_diff('day', DATE '1970-01-01', day) AS INTEGER) AS x, kwh FROM dd)")
    q["d08_daily_forecast"] = wr(f"""
SELECT CAST(DATE '1970-01-01' + CAST(xf AS INTEGER) AS DATE) AS period, step, {R('yhat', 2)} AS forecast_kwh,
       {R('yhat - half', 2)} AS lower_kwh, {R('yhat + half', 2)} AS upper_kwh FROM calc""",
                                 f"{dser},\n{_forecast('dser', 14)}")
    q["d09_daily_anomalies"] = wr(f"""
SELECT day, kwh, rolling_mean_30d, z_score, anomaly_type FROM (
  SELECT day, {R('kwh', 3)} AS kwh, {R('mu', 3)} AS rolling_mean_30d, {R('(kwh - mu) / NULLIF(sigma, 0)', 2)} AS z_score,
         CASE WHEN kwh > mu THEN 'SPIKE' ELSE 'COLLAPSE' END AS anomaly_type,
         {R('abs((kwh - mu) / NULLIF(sigma, 0))', 6)} AS strength
  FROM sc WHERE history >= 2 AND sigma > 1e-9 * greatest(abs(mu), abs(kwh)) AND abs(kwh - mu) > 3 * sigma)
ORDER BY strength DESC, day LIMIT 10""", f"""dd AS (SELECT {DAY} AS day, sum(energy_kwh) AS kwh FROM roll GROUP BY 1),
sc AS (SELECT day, kwh, avg(kwh) OVER w AS mu, stddev_samp(kwh) OVER w AS sigma, count(kwh) OVER w AS history
       FROM dd WINDOW w AS (ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))""")
    q["d10_top_consumers"] = wr(f"""
SELECT meter_id, total_kwh FROM (SELECT meter_id, {R('sum(energy_kwh)', 2)} AS total_kwh FROM roll GROUP BY 1)
ORDER BY total_kwh DESC NULLS LAST, meter_id LIMIT 10""")
    q["d11_heatmap"] = wr(f"""
SELECT day_of_week, CAST(isodow(hour_ts) AS INTEGER) AS weekday, hour, {R('sum(energy_kwh)', 2)} AS total_kwh
FROM roll GROUP BY 1, 2, 3""")
    q["d12_weekend_trend"] = wr(f"SELECT {DAY} AS day, is_weekend, {R('sum(energy_kwh)', 3)} AS total_kwh FROM roll GROUP BY 1, 2")
    q["d13_power_combo"] = wr(f"""
SELECT hour, {R('avg(avg_power_kw)', 3)} AS avg_power_kw, {R('max(peak_power_kw)', 3)} AS max_power_kw FROM roll GROUP BY 1""")
    q["d14_forecast_narrative"] = wr(f"""
SELECT next_period, expected_kwh, last_period, last_period_kwh, change_pct,
       'Expected consumption next month: ' || CAST(CAST(expected_kwh AS DECIMAL(20, 1)) AS VARCHAR) || ' kWh ('
       || coalesce(CAST(CAST(change_pct AS DECIMAL(20, 1)) AS VARCHAR), 'n/a') || '% vs last month)' AS narrative
FROM (
  SELECT {_month_of('xf')} AS next_period, {R('yhat', 1)} AS expected_kwh, last_period, {R('last_kwh', 1)} AS last_period_kwh,
         {R(DIV('100.0::DOUBLE * (yhat - last_kwh)', 'last_kwh'), 1)} AS change_pct
  FROM calc, (SELECT max(month_start) AS last_period, arg_max(kwh, month_start) AS last_kwh FROM mon))""",
                                    f"{mon},\n{mser},\n{_forecast('mser', 1)}")
    q["d15_voltage_trend"] = wr(f"""
SELECT day, avg_voltage, avg_voltage > 240 AS above_240, avg_voltage < 200 AS below_200
FROM (SELECT {DAY} AS day, {R('avg(avg_voltage)', 2)} AS avg_voltage FROM roll GROUP BY 1)""")
    q["d16_current_trend"] = wr(f"SELECT {DAY} AS day, {R('avg(avg_current)', 3)} AS avg_current FROM roll GROUP BY 1")
    q["d17_voltage_band_bar"] = with_curated("SELECT voltage_band, count(*) AS readings FROM cur GROUP BY 1")
    q["d18_unhealthy_table"] = with_curated(f"""
SELECT meter_id, avg_health_score, pct_critical, pct_warning FROM (
  SELECT meter_id, {R('avg(health_score)', 1)} AS avg_health_score,
         {R("100.0::DOUBLE * avg(CASE WHEN health_status = 'CRITICAL' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", 2)} AS pct_critical,
         {R("100.0::DOUBLE * avg(CASE WHEN health_status = 'WARNING' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", 2)} AS pct_warning
  FROM cur GROUP BY 1)
ORDER BY avg_health_score ASC NULLS LAST, meter_id LIMIT 20""")
    q["d19_health_trend"] = wr(f"SELECT {MONTH} AS month_start, {R('avg(health_score)', 2)} AS avg_health_score FROM roll GROUP BY 1")
    q["d20_outage_by_meter"] = with_curated(f"""
SELECT meter_id, outage_hours FROM (
  SELECT meter_id, {R('count(*) * 3.0::DOUBLE / 60.0::DOUBLE', 2)} AS outage_hours FROM cur WHERE avg_voltage = 0 GROUP BY 1)
ORDER BY outage_hours DESC, meter_id LIMIT 20""")
    q["dashboard_filter"] = wr("""
SELECT * FROM roll WHERE hour_ts >= TIMESTAMP '1996-01-01 00:00:00' AND hour_ts < TIMESTAMP '1999-01-01 00:00:00'
  AND substr(meter_id, 1, 2) IN ('BR') AND worst_health_status IN ('CRITICAL', 'WARNING', 'POSSIBLE_METER_ISSUE')""")
    q["town_view"] = with_curated("SELECT * FROM cur WHERE substr(meter_id, 1, 2) IN ('MH')")
    q["forecast_grouped"] = with_curated(f"""
SELECT meter_id, {_month_of('xf')} AS period, step, {R('yhat', 2)} AS forecast_kwh, {R('yhat - half', 2)} AS lower_kwh,
       {R('yhat + half', 2)} AS upper_kwh FROM calc""",
        "ms AS (SELECT meter_id, year * 12 + month - 1 AS x, sum(energy_kwh) AS kwh FROM cur GROUP BY meter_id, year, month),\n"
        + _forecast("ms", 3, "meter_id, "))
    q["forecast_seasonal"] = with_curated(f"""
SELECT calc.meter_id, {_month_of('xf')} AS period, step,
       {R('yhat + coalesce(season, 0.0::DOUBLE)', 2)} AS forecast_kwh,
       {R('(yhat - half) + coalesce(season, 0.0::DOUBLE)', 2)} AS lower_kwh,
       {R('(yhat + half) + coalesce(season, 0.0::DOUBLE)', 2)} AS upper_kwh
FROM calc LEFT JOIN idx ON calc.meter_id = idx.meter_id AND calc.xf % 12 = idx.phase""",
        "ms AS (SELECT meter_id, year * 12 + month - 1 AS x, sum(energy_kwh) AS kwh FROM cur GROUP BY meter_id, year, month),\n"
        + _forecast("ms", 3, "meter_id, ") + """,
res AS (SELECT ms.meter_id, ms.x % 12 AS phase, ms.kwh - (f.b0 + f.b1 * CAST(ms.x AS DOUBLE)) AS r
        FROM ms JOIN fit f ON ms.meter_id = f.meter_id),
idx AS (SELECT meter_id, phase, avg(r) AS season FROM res GROUP BY 1, 2)""")
    q["daily_rollup"] = with_curated("""
SELECT meter_id, CAST(reading_ts AS DATE) AS reading_date, CAST(year(CAST(reading_ts AS DATE)) AS INTEGER) AS year,
       CAST(month(CAST(reading_ts AS DATE)) AS INTEGER) AS month, sum(energy_kwh) AS energy_kwh, count(*) AS readings
FROM cur GROUP BY 1, 2""")
    hours = ", ".join(f"{R(f'sum(energy_kwh) FILTER (WHERE hour = {h})', 2)} AS h{h:02d}" for h in range(24))
    q["q21_heatmap_wide"] = with_curated(f"SELECT day_of_week, {hours} FROM cur GROUP BY day_of_week")
    q["anomaly_series"] = with_curated(f"""
SELECT town, d, {R('kwh', 3)} AS kwh, {R('mu', 3)} AS rolling_mean_30d, {R('(kwh - mu) / NULLIF(sigma, 0)', 2)} AS z_score,
       CASE WHEN kwh > mu THEN 'SPIKE' ELSE 'COLLAPSE' END AS anomaly_type
FROM sc WHERE history >= 2 AND sigma > 1e-9 * greatest(abs(mu), abs(kwh)) AND abs(kwh - mu) > 3 * sigma""",
        f"""td AS (SELECT substr(meter_id, 1, 2) AS town, CAST(reading_ts AS DATE) AS d, sum(energy_kwh) AS kwh FROM cur GROUP BY 1, 2),
sc AS (SELECT town, d, kwh, avg(kwh) OVER w AS mu, stddev_samp(kwh) OVER w AS sigma, count(kwh) OVER w AS history
       FROM td WINDOW w AS (PARTITION BY town ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))""")
    return q
