"""Oracle SQL for the streaming operators."""
from __future__ import annotations

from .base import CURATED_COLUMNS_SQL, D, R, enrich_sql, with_curated, with_raw

EVENTS_READINGS = f"""ev AS (SELECT event_id AS eid, ts, user_id AS uid, hour(ts) * 60 + minute(ts) AS mod FROM events),
er AS (
  SELECT CAST(ts AS DATE) + to_minutes(CAST(mod - mod % 3 AS INTEGER)) AS reading_ts,
         CASE WHEN eid % 17 = 0 THEN {D(0)} ELSE {D('eid % 64 + 1')} / {D(1024)} END AS energy_kwh,
         CASE WHEN eid % 97 = 0 THEN {D(250)} WHEN eid % 41 = 0 THEN {D(0)}
              ELSE {D(196)} + {D('eid % 320')} * {D(0.125)} END AS avg_voltage,
         {D('eid % 13')} * {D(0.75)} AS avg_current,
         CASE WHEN eid % 41 = 0 THEN {D(0)} ELSE {D(49.25)} + {D('eid % 100')} / {D(64)} END AS frequency_hz,
         (CASE WHEN uid % 2 = 0 THEN 'BR' ELSE 'MH' END) || lpad(CAST(uid AS VARCHAR), CAST(greatest(4, length(CAST(uid AS VARCHAR))) AS INTEGER), '0') AS meter_id
  FROM ev),
evalid AS (
  SELECT DISTINCT * FROM er
  WHERE reading_ts IS NOT NULL AND energy_kwh IS NOT NULL AND avg_voltage IS NOT NULL AND avg_current IS NOT NULL
    AND frequency_hz IS NOT NULL AND meter_id IS NOT NULL
    AND energy_kwh BETWEEN 0 AND 50 AND avg_voltage BETWEEN 0 AND 400
    AND avg_current BETWEEN 0 AND 200 AND frequency_hz BETWEEN 0 AND 70),
eenr AS ({enrich_sql('evalid')}),
wins AS (
  SELECT meter_id, time_bucket(INTERVAL 15 MINUTE, reading_ts) AS window_start, count(*) AS readings,
         count(*) FILTER (WHERE health_status <> 'HEALTHY') AS unhealthy,
         count(*) FILTER (WHERE health_status = 'CRITICAL') AS critical,
         count(*) FILTER (WHERE health_status = 'WARNING') AS warning,
         count(*) FILTER (WHERE health_status = 'HIGH_LOAD') AS high_load,
         count(*) FILTER (WHERE health_status = 'POSSIBLE_METER_ISSUE') AS meter_issue,
         min(health_score) AS min_score
  FROM eenr GROUP BY 1, 2),
emax AS (SELECT max(reading_ts) AS m FROM evalid)"""


def sql() -> dict[str, str]:
    in_range = ("energy_kwh BETWEEN 0 AND 50 AND avg_voltage BETWEEN 0 AND 400 AND avg_current BETWEEN 0 AND 200 "
                "AND frequency_hz BETWEEN 0 AND 70")
    columns = "reading_ts, energy_kwh, avg_voltage, avg_current, frequency_hz, meter_id"
    missing = " OR ".join(f"{c} IS NULL" for c in columns.split(", "))
    return {
        "versioned_ingest": with_curated(f"SELECT {CURATED_COLUMNS_SQL} FROM cur"),
        "clustered_table": with_curated(f"""SELECT {CURATED_COLUMNS_SQL} FROM cur
WHERE reading_ts >= TIMESTAMP '1995-02-01' AND reading_ts < TIMESTAMP '1995-05-01' AND meter_id LIKE 'BR%'"""),
        # a spell is open until the newest reading is ten minutes past the second after its last gap
        "outage_spells_stream": with_curated(f"""
SELECT meter_id, min(reading_ts) AS spell_start, max(reading_ts) AS spell_end, count(*) AS readings,
       {R('count(*) * 3.0::DOUBLE / 60.0::DOUBLE', 2)} AS est_hours
FROM islands GROUP BY meter_id, island
HAVING max(reading_ts) + INTERVAL 181 SECOND <= (SELECT max(reading_ts) FROM valid) - INTERVAL 10 MINUTE""", """zero AS (
  SELECT meter_id, reading_ts, lag(reading_ts) OVER (PARTITION BY meter_id ORDER BY reading_ts) AS before
  FROM cur WHERE avg_voltage = 0),
islands AS (SELECT *, sum(CASE WHEN before IS NULL OR date_diff('second', before, reading_ts) > 180 THEN 1 ELSE 0 END)
                   OVER (PARTITION BY meter_id ORDER BY reading_ts) AS island FROM zero)"""),
        "dead_letters": with_raw(f"""
SELECT reason, count(*) AS rows FROM (
  SELECT CASE WHEN {missing} THEN 'null' WHEN NOT ({in_range}) THEN 'out_of_range'
              WHEN day(reading_ts) = 1 AND reading_ts <= mark THEN 'late' END AS reason
  FROM raw, (SELECT max(reading_ts) - INTERVAL 10 MINUTE AS mark FROM valid WHERE day(reading_ts) <> 1) m)
WHERE reason IS NOT NULL GROUP BY reason"""),
        "incremental_ingest": with_curated(f"SELECT {CURATED_COLUMNS_SQL} FROM cur"),
        "health_alerts_stream": with_curated("""
SELECT meter_id, window_start, window_start + INTERVAL 15 MINUTE AS window_end, readings, unhealthy, critical,
       warning, high_load, meter_issue, min_score
FROM wins, emax WHERE window_start + INTERVAL 15 MINUTE <= m - INTERVAL 10 MINUTE AND unhealthy >= 1""",
                                             EVENTS_READINGS),
    }
