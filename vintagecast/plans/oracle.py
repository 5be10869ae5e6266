"""Independent DuckDB SQL for every registered query (the correctness oracle).

Fixtures are CTEs over the pre-registered tables, written from the
definitions in FIXTURES.md, not from the Spark code.  Means use exact
sums of billionths; rounded means use integer arithmetic so that both
engines round the exact value half away from zero.
"""

from __future__ import annotations

HEALTH_ZONE = "Europe/Prague"


# ------------------------------------------------------------------ numeric helpers
def nano(x: str) -> str:
    """Sum of a measure in whole billionths."""
    return f"SUM(CAST(round({x} * 1000000000) AS HUGEINT))"


def mean(x: str) -> str:
    return f"(CAST({nano(x)} AS DOUBLE) / CAST(1000000000 AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def mean_round(x: str, d: int) -> str:
    k, n = f"CAST({nano(x)} AS HUGEINT)", f"CAST(COUNT({x}) AS HUGEINT)"
    q = f"(sign({k}) * ((2 * abs({k}) * {10 ** d} + {n} * 1000000000) // NULLIF(2 * {n} * 1000000000, 0)))"
    return f"(CAST({q} AS DOUBLE) / {10 ** d})" if d else f"CAST({q} AS DOUBLE)"


def dsum(x: str) -> str:
    return f"(CAST({nano(x)} AS DOUBLE) / CAST(1000000000 AS DOUBLE))"


def rate(pred: str) -> str:
    return f"(CAST(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*))"


def daypart(hour: str, part_set: str) -> str:
    bands = {
        "A": [("morning", 6, 9), ("noon", 10, 14), ("afternoon", 14, 18), ("evening", 19, 23)],
        "B": [("morning", 6, 9), ("noon", 10, 13), ("afternoon", 14, 17), ("evening", 18, 23)],
        "C": [("morning", 6, 11), ("noon", 12, 14), ("afternoon", 15, 18), ("evening", 19, 23)],
    }[part_set]
    whens = " ".join(f"WHEN {hour} BETWEEN {lo} AND {hi} THEN '{n}'" for n, lo, hi in bands)
    other = "'other'" if part_set == "A" else "NULL"
    return f"CASE {whens} ELSE {other} END"


SORT_KEY = "CASE daypart WHEN 'morning' THEN 1 WHEN 'noon' THEN 2 WHEN 'afternoon' THEN 3 WHEN 'evening' THEN 4 ELSE 9 END"


# ------------------------------------------------------------------ fixtures
LOC = "'u' || CAST(user_id AS VARCHAR)"


def hourly_cte() -> str:
    return f"""
f1_pick AS (
  SELECT {LOC} AS location_name, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS snapshot_time_utc,
         event_id % 48 AS idx, min(event_id) AS eid, max(value) AS value
  FROM events GROUP BY 1, 2, 3
),
f1_base AS (
  SELECT location_name, snapshot_time_utc, CAST(idx AS BIGINT) AS idx, eid, value,
         snapshot_time_utc + to_hours(CAST(idx AS BIGINT)) AS forecast_time_local,
         CASE WHEN eid % 17 = 0 THEN NULL ELSE CAST((eid * 7) % 400 AS DOUBLE) / 10 - 5 END AS temperature_c
  FROM f1_pick
),
hourly AS (
  SELECT location_name, snapshot_time_utc, 'UTC' AS timezone, idx, forecast_time_local,
         CAST(forecast_time_local AS DATE) AS forecast_date_local,
         CAST(extract(hour FROM forecast_time_local) AS BIGINT) AS forecast_hour_local,
         temperature_c,
         temperature_c - CAST(eid % 6 AS DOUBLE) / 2 AS feels_like_c,
         CASE WHEN eid % 23 = 0 THEN NULL WHEN eid % 5 = 0 THEN value / 100 ELSE CAST(0 AS DOUBLE) END
           AS precipitation_mm,
         CASE WHEN eid % 29 = 0 THEN NULL ELSE value END AS wind_kmh,
         CAST((eid * 13) % 101 AS DOUBLE) AS cloudcover_pct
  FROM f1_base
)"""


# several snapshots a day in four zones, already normalised (wind and cloud cuts of F4)
FEED = f"""
f7_pick AS (
  SELECT user_id, CAST(date_diff('second', TIMESTAMP '2024-01-01', ts) // 14400 AS BIGINT) AS h, min(event_id) AS eid
  FROM events GROUP BY 1, 2
),
f7_hours AS (
  SELECT {LOC} AS location_name, TIMESTAMP '2024-03-28' + to_hours(h) AS snapshot_time_utc,
         CASE user_id % 4 WHEN 0 THEN 'UTC' WHEN 1 THEN 'Europe/Prague' WHEN 2 THEN 'America/New_York'
              ELSE 'Asia/Kolkata' END AS timezone, eid, i AS idx, eid + (i // 6) * 7 AS e
  FROM f7_pick, (SELECT unnest(range(24)) AS i) hours
),
f7_local AS (
  SELECT *, date_trunc('hour', timezone(timezone, timezone('UTC', snapshot_time_utc + to_hours(idx))))
              AS forecast_time_local,
         CASE WHEN e % 17 = 0 THEN NULL ELSE CAST((e * 7) % 400 AS DOUBLE) / 10 - 5 END AS temperature_c
  FROM f7_hours
),
hourly AS (
  SELECT location_name, snapshot_time_utc, timezone, idx, forecast_time_local,
         CAST(forecast_time_local AS DATE) AS forecast_date_local,
         CAST(extract(hour FROM forecast_time_local) AS BIGINT) AS forecast_hour_local, temperature_c,
         temperature_c - CAST(e % 6 AS DOUBLE) / 2 AS feels_like_c,
         CASE WHEN e % 23 = 0 THEN NULL WHEN e % 5 = 0 THEN CAST((eid * 11) % 50 + idx % 3 AS DOUBLE) / 100
              ELSE CAST(0 AS DOUBLE) END AS precipitation_mm,
         CASE WHEN e % 29 = 0 OR (extract(day FROM snapshot_time_utc) % 7 = 0 AND idx >= 21) THEN NULL
              ELSE CAST((eid * 11) % 50 + idx % 3 AS DOUBLE) END AS wind_kmh,
         CASE WHEN extract(day FROM snapshot_time_utc) <= 5 THEN NULL ELSE CAST((e * 13) % 101 AS DOUBLE) END
              AS cloudcover_pct
  FROM f7_local
)"""

LOCAL_RUN = "timezone(h.timezone, timezone('UTC', {0}.as_of_utc))"   # a run on its location's clock

SNAPS = """
snaps AS (SELECT DISTINCT location_name, snapshot_time_utc, timezone FROM hourly)"""

RUNS = SNAPS + """,
runs AS (SELECT location_name, timezone, snapshot_time_utc + INTERVAL 6 HOUR AS as_of_utc FROM snaps)"""

FEED_RUNS = SNAPS + """,
runs AS (SELECT location_name, timezone, snapshot_time_utc AS as_of_utc FROM snaps)"""

DIGEST_RUNS = SNAPS + """,
runs AS (
  SELECT location_name, timezone, snapshot_time_utc + INTERVAL 6 HOUR AS as_of_utc FROM snaps
  UNION
  SELECT location_name, timezone, snapshot_time_utc + INTERVAL 9 HOUR AS as_of_utc FROM snaps)"""

FINAL_RUNS = SNAPS + """,
runs AS (SELECT location_name, timezone, max(snapshot_time_utc) + INTERVAL 6 HOUR AS as_of_utc
         FROM snaps GROUP BY 1, 2)"""

# visible versions: newest (rn=1) and second newest (rn=2) snapshot at or before the run
VIS = """,
vis_all AS (
  SELECT r.location_name, r.as_of_utc, s.snapshot_time_utc,
         row_number() OVER (PARTITION BY r.location_name, r.as_of_utc ORDER BY s.snapshot_time_utc DESC) AS rn
  FROM runs r JOIN snaps s ON s.location_name = r.location_name AND s.snapshot_time_utc <= r.as_of_utc
),
vis AS (SELECT * FROM vis_all WHERE rn <= 2),
cur AS (SELECT location_name, as_of_utc, snapshot_time_utc FROM vis WHERE rn = 1)"""

REGISTRY = f"""
registry AS (
  SELECT {LOC} AS location_name, min(ts) AS snapshot_time_utc, 'f' || CAST(min(event_id) AS VARCHAR) AS raw_file,
         sha256('k' || CAST(CAST(json_extract_string(arg_min(props, event_id), '$.k') AS INTEGER) % 3 AS VARCHAR))
           AS content_hash,
         min(ts) AS inserted_at_utc, min(event_id) AS eid
  FROM events GROUP BY user_id, date_trunc('hour', ts)
)"""

REGISTRY_COPIES = REGISTRY + """,
registry_copies AS (
  SELECT location_name, snapshot_time_utc, raw_file, content_hash, inserted_at_utc FROM registry
  UNION ALL
  SELECT location_name, snapshot_time_utc + INTERVAL 30 MINUTE, raw_file, content_hash,
         snapshot_time_utc + INTERVAL 30 MINUTE
  FROM registry WHERE eid % 10 = 0
)"""

HEALTH = REGISTRY + f""",
snaps_day AS (
  SELECT location_name, snapshot_time_utc, content_hash,
         (snapshot_time_utc AT TIME ZONE 'UTC') AT TIME ZONE '{HEALTH_ZONE}' AS snapshot_time_local
  FROM registry
),
snaps_of_day AS (
  SELECT location_name, snapshot_time_utc, content_hash, snapshot_time_local,
         date_trunc('hour', snapshot_time_local) AS snapshot_hour_local,
         CAST(snapshot_time_local AS DATE) AS today_local_date
  FROM snaps_day
),
present AS (
  SELECT location_name, today_local_date, snapshot_hour_local, min(content_hash) AS content_hash
  FROM snaps_of_day GROUP BY 1, 2, 3
),
spine AS (
  SELECT location_name, CAST(d AS DATE) AS today_local_date
  FROM (SELECT location_name, min(today_local_date) AS d0,
               (SELECT max(today_local_date) FROM snaps_of_day) AS d1 FROM snaps_of_day GROUP BY 1) s,
       generate_series(CAST(s.d0 AS TIMESTAMP), CAST(s.d1 AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
),
expected AS (
  SELECT location_name, today_local_date, CAST(today_local_date AS TIMESTAMP) + to_hours(h) AS expected_hour_local
  FROM spine, generate_series(6, 19) AS t(h)
),
missing AS (
  SELECT e.* FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.location_name = e.location_name
                    AND p.today_local_date = e.today_local_date AND p.snapshot_hour_local = e.expected_hour_local)
),
changes AS (
  SELECT location_name, today_local_date, snapshot_hour_local, content_hash,
         CASE WHEN lag(content_hash) OVER w IS NULL THEN NULL
              WHEN content_hash <> lag(content_hash) OVER w THEN 1 ELSE 0 END AS changed_vs_prev
  FROM present WINDOW w AS (PARTITION BY location_name, today_local_date ORDER BY snapshot_hour_local)
),
rates AS (
  SELECT location_name, today_local_date,
         CAST((2 * 1000 * CAST(SUM(changed_vs_prev) AS HUGEINT) + COUNT(changed_vs_prev))
              // (2 * COUNT(changed_vs_prev)) AS DOUBLE) / 10 AS change_rate_pct_today
  FROM changes WHERE changed_vs_prev IS NOT NULL GROUP BY 1, 2
),
mlist AS (
  SELECT location_name, today_local_date, COUNT(*) AS missing_hour_count_06_19,
         string_agg(strftime(expected_hour_local, '%H:%M'), ', ' ORDER BY expected_hour_local) AS missing_hours_list
  FROM missing GROUP BY 1, 2
),
health AS (
  SELECT s.location_name, s.today_local_date,
         CAST(coalesce(c.n, 0) AS BIGINT) AS snapshots_today, c.last_snapshot_local,
         r.change_rate_pct_today,
         CAST(coalesce(m.missing_hour_count_06_19, 0) AS BIGINT) AS missing_hour_count_06_19,
         m.missing_hours_list
  FROM spine s
  LEFT JOIN (SELECT location_name, today_local_date, COUNT(*) AS n, max(snapshot_time_local) AS last_snapshot_local
             FROM snaps_of_day GROUP BY 1, 2) c USING (location_name, today_local_date)
  LEFT JOIN rates r USING (location_name, today_local_date)
  LEFT JOIN mlist m USING (location_name, today_local_date)
)"""

ALERT_LOG = f"""
alert_log AS (
  SELECT ts AS sent_time_utc,
         CASE WHEN user_id % 2 = 0 THEN 'rain_next6h' ELSE 'wind_next6h' END AS alert_type,
         {LOC} AS location_name
  FROM events
)"""

BRIEF_LOG = f"""
brief_log AS (SELECT CAST(ts AS DATE) AS sent_date_local, {LOC} AS location_name FROM events WHERE event_type = 'purchase')"""

# F4 raw rows: per (location, snapshot), hours ordered by idx; day-of-month rules
RAW = """,
raw_pos AS (
  SELECT h.*, row_number() OVER (PARTITION BY location_name, snapshot_time_utc ORDER BY idx) - 1 AS pos,
         COUNT(*) OVER (PARTITION BY location_name, snapshot_time_utc) AS n,
         extract(day FROM snapshot_time_utc) AS dom
  FROM hourly h
),
raw AS (
  SELECT snapshot_time_utc, location_name, CAST(50 AS DOUBLE) AS latitude, CAST(14 AS DOUBLE) AS longitude, timezone,
         CASE WHEN extract(day FROM snapshot_time_utc) % 2 = 0 THEN 'open-meteo' ELSE 'fixture' END AS source,
         CASE WHEN extract(day FROM snapshot_time_utc) % 3 = 0 THEN '' ELSE 'v1/forecast' END AS endpoint,
         'forecast_' || lower(location_name) || '_' || strftime(snapshot_time_utc, '%Y%m%dT%H%M%S') || 'Z.json' AS raw_file,
         COUNT(*) AS n_hours
  FROM hourly GROUP BY location_name, snapshot_time_utc, timezone
)"""

NORM = """
SELECT location_name, snapshot_time_utc, timezone, CAST(pos AS BIGINT) AS idx, forecast_time_local,
       forecast_date_local, forecast_hour_local, temperature_c, feels_like_c, precipitation_mm,
       CASE WHEN dom % 7 = 0 AND pos >= n - 3 THEN NULL ELSE wind_kmh END AS wind_kmh,
       CASE WHEN dom <= 5 THEN NULL ELSE cloudcover_pct END AS cloudcover_pct
FROM raw_pos"""


def w(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


H = hourly_cte()
HW = hourly_cte()


# ------------------------------------------------------------------ alerts SQL
def _decisions(base: str, now: str = "v.as_of_utc") -> str:
    return base + VIS + f""",
hz AS (
  SELECT v.location_name, v.as_of_utc, v.rn, v.snapshot_time_utc, h.precipitation_mm, h.wind_kmh
  FROM vis v JOIN hourly h ON h.location_name = v.location_name AND h.snapshot_time_utc = v.snapshot_time_utc
  WHERE h.forecast_time_local >= {now} AND h.forecast_time_local < {now} + INTERVAL 6 HOUR
),
flags AS (
  SELECT location_name, as_of_utc, rn, snapshot_time_utc,
         MAX(CASE WHEN precipitation_mm > 0 THEN 1 ELSE 0 END) AS rain_next6h, MAX(wind_kmh) AS max_wind_next6h
  FROM hz GROUP BY 1, 2, 3, 4
),
piv AS (
  SELECT r.location_name, r.as_of_utc AS run_time_utc,
         MAX(CASE WHEN f.rn = 1 THEN f.snapshot_time_utc END) AS current_snapshot_utc,
         MAX(CASE WHEN f.rn = 2 THEN f.snapshot_time_utc END) AS prev_snapshot_utc,
         MAX(CASE WHEN f.rn = 1 THEN f.rain_next6h END) AS current_rain_next6h,
         MAX(CASE WHEN f.rn = 2 THEN f.rain_next6h END) AS prev_rain_next6h,
         MAX(CASE WHEN f.rn = 1 THEN f.max_wind_next6h END) AS current_max_wind_next6h,
         MAX(CASE WHEN f.rn = 2 THEN f.max_wind_next6h END) AS prev_max_wind_next6h
  FROM runs r LEFT JOIN flags f ON f.location_name = r.location_name AND f.as_of_utc = r.as_of_utc
  GROUP BY 1, 2
),
dec AS (
  SELECT *,
    CASE WHEN prev_rain_next6h IS NOT NULL AND current_rain_next6h = 1 AND prev_rain_next6h = 0
         THEN TRUE ELSE FALSE END AS should_alert_rain_next6h,
    CASE WHEN prev_max_wind_next6h IS NOT NULL AND current_max_wind_next6h >= 30
              AND (current_max_wind_next6h - prev_max_wind_next6h) >= 15
         THEN TRUE ELSE FALSE END AS should_alert_wind_next6h
  FROM piv
)"""


RAIN_COLS = ("location_name, run_time_utc, current_snapshot_utc, prev_snapshot_utc, current_rain_next6h, "
             "prev_rain_next6h, should_alert_rain_next6h")
WIND_COLS = ("location_name, run_time_utc, current_snapshot_utc, prev_snapshot_utc, current_max_wind_next6h, "
             "prev_max_wind_next6h, should_alert_wind_next6h")


def _gated(flag: str, cols: str, a_type: str) -> str:
    return f"""
SELECT {', '.join('d.' + c.strip() for c in cols.split(','))}, ls.last_sent_time_utc,
       CASE WHEN ls.last_sent_time_utc IS NULL THEN FALSE
            WHEN d.run_time_utc < ls.last_sent_time_utc + INTERVAL 2 HOUR THEN TRUE ELSE FALSE END AS in_cooldown,
       CASE WHEN d.{flag} AND NOT (CASE WHEN ls.last_sent_time_utc IS NULL THEN FALSE
            WHEN d.run_time_utc < ls.last_sent_time_utc + INTERVAL 2 HOUR THEN TRUE ELSE FALSE END)
            THEN TRUE ELSE FALSE END AS should_send_after_gating
FROM dec d LEFT JOIN (
  SELECT d2.location_name, d2.run_time_utc, MAX(l.sent_time_utc) AS last_sent_time_utc
  FROM dec d2 LEFT JOIN alert_log l ON l.location_name = d2.location_name AND l.alert_type = '{a_type}'
       AND l.sent_time_utc <= d2.run_time_utc
  GROUP BY 1, 2) ls ON ls.location_name = d.location_name AND ls.run_time_utc = d.run_time_utc"""


def _gated_q(flag, cols, a_type):
    return w(H, _decisions(RUNS), ALERT_LOG) + _gated(flag, cols, a_type)


WIND_TEXT = """CASE WHEN current_max_wind_next6h IS NULL THEN 'ALERT: Wind spike expected in next 6 hours.'
            ELSE 'ALERT: Wind spike expected (max ~' || CAST(CAST(round_even(current_max_wind_next6h, 0) AS BIGINT)
                 AS VARCHAR) || ' km/h in next 6h).' END"""

# decisions of the feed gated by their own sends: from each send on to the next decision at least 2 hours later
FEED_SENDS = w(FEED, _decisions(FEED_RUNS, LOCAL_RUN.format("v"))).replace("WITH", "WITH RECURSIVE", 1) + """,
fired AS (
  SELECT location_name, run_time_utc AS t, current_snapshot_utc AS snapshot_time_utc, 'rain_next6h' AS alert_type,
         'ALERT: Rain expected in next 6 hours.' AS message
  FROM dec WHERE should_alert_rain_next6h
  UNION ALL
  SELECT location_name, run_time_utc, current_snapshot_utc, 'wind_next6h', """ + WIND_TEXT + """
  FROM dec WHERE should_alert_wind_next6h
),
step AS (
  SELECT a.location_name, a.alert_type, a.t, min(b.t) AS t_next
  FROM fired a JOIN fired b ON b.location_name = a.location_name AND b.alert_type = a.alert_type
       AND b.t >= a.t + INTERVAL 2 HOUR
  GROUP BY 1, 2, 3
),
sends(location_name, alert_type, t) AS (
  SELECT location_name, alert_type, min(t) FROM fired GROUP BY 1, 2
  UNION ALL
  SELECT s.location_name, s.alert_type, n.t_next
  FROM sends s JOIN step n ON n.location_name = s.location_name AND n.alert_type = s.alert_type AND n.t = s.t
)
SELECT f.t AS sent_time_utc, f.alert_type, f.snapshot_time_utc, f.message, f.location_name
FROM fired f JOIN sends s ON s.location_name = f.location_name AND s.alert_type = f.alert_type AND s.t = f.t"""


# ------------------------------------------------------------------ digest SQL
def _v2_rows(base: str, now: str = "c.as_of_utc") -> str:
    return base + VIS + f""",
v2_rows AS (
  SELECT c.location_name, c.as_of_utc, c.snapshot_time_utc, h.forecast_time_local, h.forecast_hour_local,
         h.temperature_c, h.feels_like_c, h.precipitation_mm, h.wind_kmh, h.cloudcover_pct
  FROM cur c JOIN hourly h ON h.location_name = c.location_name AND h.snapshot_time_utc = c.snapshot_time_utc
  WHERE h.forecast_time_local >= date_trunc('hour', {now})
    AND h.forecast_time_local < date_trunc('hour', {now}) + INTERVAL 12 HOUR
),
band_rows AS (
  SELECT c.location_name, c.as_of_utc, c.snapshot_time_utc, h.forecast_time_local, h.forecast_hour_local,
         h.temperature_c, h.precipitation_mm
  FROM cur c JOIN hourly h ON h.location_name = c.location_name AND h.snapshot_time_utc = c.snapshot_time_utc
  WHERE h.forecast_time_local >= date_trunc('day', {now}) + INTERVAL 6 HOUR
    AND h.forecast_time_local < date_trunc('day', {now}) + INTERVAL 24 HOUR
),
v2 AS (
  SELECT location_name, as_of_utc AS run_time_utc, snapshot_time_utc,
         """ + mean_round("temperature_c", 1) + """ AS avg_temp_c_12h,
         """ + mean_round("feels_like_c", 1) + """ AS avg_feels_like_c_12h,
         """ + mean_round("cloudcover_pct", 0) + """ AS avg_cloudcover_pct_12h,
         CASE WHEN """ + mean("cloudcover_pct") + """ IS NULL THEN 'unknown'
              WHEN """ + mean("cloudcover_pct") + """ <= 20 THEN 'clear'
              WHEN """ + mean("cloudcover_pct") + """ <= 60 THEN 'partly cloudy' ELSE 'cloudy' END AS sky_text,
         max(coalesce(precipitation_mm, 0)) > 0 AS rain_possible,
         round(max(wind_kmh), 0) AS max_wind_kmh_12h,
         min(forecast_time_local) AS window_start_local, max(forecast_time_local) AS window_end_local,
         COUNT(*) AS n_hours
  FROM v2_rows GROUP BY 1, 2, 3
),
parts12 AS (
  SELECT location_name, as_of_utc, snapshot_time_utc, daypart,
         """ + mean_round("temperature_c", 0) + """ AS temp0,
         max(coalesce(precipitation_mm, 0)) > 0 AS rain_possible
  FROM (SELECT *, """ + daypart("forecast_hour_local", "C") + """ AS daypart FROM v2_rows) x
  WHERE daypart IS NOT NULL GROUP BY 1, 2, 3, 4
),
parts_band AS (
  SELECT location_name, as_of_utc, snapshot_time_utc, daypart,
         """ + mean_round("temperature_c", 0) + """ AS temp0,
         max(coalesce(precipitation_mm, 0)) > 0 AS rain_possible
  FROM (SELECT *, """ + daypart("forecast_hour_local", "C") + """ AS daypart FROM band_rows) x
  WHERE daypart IS NOT NULL GROUP BY 1, 2, 3, 4
),
meta AS (
  SELECT location_name, as_of_utc, snapshot_time_utc,
         CAST(sum(CASE WHEN rain_possible THEN 1 ELSE 0 END) AS BIGINT) AS rainy_parts, COUNT(*) AS total_parts
  FROM parts_band GROUP BY 1, 2, 3
),
line_final AS (
  SELECT p.location_name, p.as_of_utc, p.snapshot_time_utc,
         string_agg(p.daypart || ' ' || CAST(CAST(p.temp0 AS INTEGER) AS VARCHAR) || '°C'
                    || CASE WHEN m.rainy_parts = m.total_parts THEN '' WHEN p.rain_possible THEN ' (rain)' ELSE '' END,
                    ' • ' ORDER BY """ + SORT_KEY.replace("daypart", "p.daypart") + """) AS dayparts_line
  FROM parts_band p JOIN meta m ON p.location_name = m.location_name AND p.as_of_utc = m.as_of_utc
       AND p.snapshot_time_utc = m.snapshot_time_utc
  GROUP BY 1, 2, 3
),
final AS (
  SELECT a.location_name, a.run_time_utc, a.snapshot_time_utc, a.avg_temp_c_12h, a.avg_feels_like_c_12h,
         a.avg_cloudcover_pct_12h, a.sky_text, a.rain_possible, a.max_wind_kmh_12h, d.dayparts_line,
         a.window_start_local, a.window_end_local, a.n_hours
  FROM v2 a LEFT JOIN line_final d ON a.location_name = d.location_name AND a.run_time_utc = d.as_of_utc
       AND a.snapshot_time_utc = d.snapshot_time_utc
)"""


BRIEF_TEXT = """concat_ws(chr(10),
         'Morning brief (' || location_name || '): ' ||
           CASE WHEN avg_temp_c_12h IS NOT NULL AND avg_feels_like_c_12h IS NOT NULL
                THEN CAST(avg_temp_c_12h AS VARCHAR) || '°C (feels like ' || CAST(avg_feels_like_c_12h AS VARCHAR) || '°C)'
                WHEN avg_temp_c_12h IS NOT NULL THEN CAST(avg_temp_c_12h AS VARCHAR) || '°C'
                ELSE '(temperature unavailable)' END,
         'Sky: ' || coalesce(nullif(trim(sky_text), ''), 'unknown'),
         CASE WHEN rain_possible THEN 'Rain: possible' END,
         CASE WHEN max_wind_kmh_12h >= 25
              THEN 'Wind: up to ' || CAST(CAST(round_even(max_wind_kmh_12h, 0) AS BIGINT) AS VARCHAR) || ' km/h' END,
         CASE WHEN length(trim(dayparts_line)) > 0 THEN 'Dayparts: ' || trim(dayparts_line) END)"""


# day metrics: today from the current snapshot; earlier days from the newest
# snapshot at or before the run that has the hour
def _days(base: str, days_back: int) -> str:
    return base + VIS + f""",
today_rows AS (
  SELECT c.location_name, c.as_of_utc, CAST(c.as_of_utc AS DATE) AS run_date, h.forecast_date_local,
         h.forecast_hour_local, h.temperature_c, h.feels_like_c, h.wind_kmh, h.precipitation_mm, 0 AS back
  FROM cur c JOIN hourly h ON h.location_name = c.location_name AND h.snapshot_time_utc = c.snapshot_time_utc
  WHERE h.forecast_date_local = CAST(c.as_of_utc AS DATE) AND h.forecast_hour_local BETWEEN 6 AND 23
),
hist_all AS (
  SELECT r.location_name, r.as_of_utc, CAST(r.as_of_utc AS DATE) AS run_date, h.*,
         row_number() OVER (PARTITION BY r.location_name, r.as_of_utc, h.forecast_time_local
                            ORDER BY h.snapshot_time_utc DESC) AS k
  FROM runs r JOIN hourly h ON h.location_name = r.location_name
       AND h.forecast_date_local >= CAST(CAST(r.as_of_utc AS DATE) - INTERVAL {days_back} DAY AS DATE)
       AND h.forecast_date_local < CAST(r.as_of_utc AS DATE)
       AND h.snapshot_time_utc <= r.as_of_utc
),
past_rows AS (
  SELECT location_name, as_of_utc, run_date, forecast_date_local, forecast_hour_local, temperature_c,
         feels_like_c, wind_kmh, precipitation_mm, CAST(run_date - forecast_date_local AS INTEGER) AS back
  FROM hist_all WHERE k = 1 AND forecast_hour_local BETWEEN 6 AND 23
),
part_rows AS (
  SELECT *, {daypart('forecast_hour_local', 'B')} AS daypart FROM today_rows
  UNION ALL
  SELECT *, {daypart('forecast_hour_local', 'B')} AS daypart FROM past_rows WHERE back = 1
),
part_deltas AS (
  SELECT location_name, as_of_utc, daypart,
         {mean('CASE WHEN back = 0 THEN temperature_c END')} - {mean('CASE WHEN back = 1 THEN temperature_c END')}
           AS delta_temp
  FROM part_rows GROUP BY 1, 2, 3
  HAVING max(CASE WHEN back = 0 THEN 1 END) IS NOT NULL AND max(CASE WHEN back = 1 THEN 1 END) IS NOT NULL
),
most_changed AS (
  SELECT p.location_name, p.as_of_utc, p.daypart AS most_changed_daypart, p.delta_temp AS max_daypart_delta
  FROM part_deltas p JOIN (SELECT location_name, as_of_utc, max(abs(delta_temp)) AS m FROM part_deltas GROUP BY 1, 2) x
       ON p.location_name = x.location_name AND p.as_of_utc = x.as_of_utc AND abs(p.delta_temp) = x.m
),
day_means AS (
  SELECT location_name, as_of_utc, run_date,
         {mean('CASE WHEN back = 0 THEN temperature_c END')} AS today_avg_temp,
         {mean('CASE WHEN back = 1 THEN temperature_c END')} AS yday_avg_temp,
         {mean('CASE WHEN back >= 1 THEN temperature_c END')} AS last4_avg_temp,
         max(CASE WHEN back = 0 THEN 1 END) AS has_today, max(CASE WHEN back = 1 THEN 1 END) AS has_yday
  FROM (SELECT location_name, as_of_utc, run_date, back, temperature_c FROM today_rows
        UNION ALL SELECT location_name, as_of_utc, run_date, back, temperature_c FROM past_rows) u
  GROUP BY 1, 2, 3
)"""


def _daypart_summary(src: str, part_set: str) -> str:
    return f"""
SELECT location_name, as_of_utc, forecast_date_local AS date_local, daypart,
       {mean('temperature_c')} AS avg_temp_c, {mean('feels_like_c')} AS avg_feels_like_c,
       {mean('wind_kmh')} AS avg_wind_kmh, {dsum('precipitation_mm')} AS total_precip_mm,
       CAST(SUM(CASE WHEN precipitation_mm > 0 THEN 1 ELSE 0 END) AS BIGINT) AS precip_hours
FROM (SELECT *, {daypart('forecast_hour_local', part_set)} AS daypart FROM {src}) x
GROUP BY 1, 2, 3, 4"""


HZ_COLS = "location_name, as_of_utc, snapshot_time_utc, forecast_time_local, temperature_c, precipitation_mm, wind_kmh"


def _cur_join(where: str) -> str:
    return w(H, RUNS + VIS) + f"""
SELECT c.location_name, c.as_of_utc, c.snapshot_time_utc, h.forecast_time_local, h.temperature_c,
       h.precipitation_mm, h.wind_kmh
FROM cur c JOIN hourly h ON h.location_name = c.location_name AND h.snapshot_time_utc = c.snapshot_time_utc
WHERE {where}"""


LATEST = """,
latest AS (
  SELECT h.* FROM hourly h JOIN (SELECT location_name, max(snapshot_time_utc) AS s FROM hourly GROUP BY 1) l
  ON h.location_name = l.location_name AND h.snapshot_time_utc = l.s
)"""


def _dist_profile() -> str:
    def block(col, prefix, qs, zero=False):
        parts = [f"min({col}) AS {prefix}_min"]
        parts += [f"quantile_cont({col}, {q}) AS {prefix}_p{int(round(q * 100)):02d}" for q in qs]
        parts.append(f"max({col}) AS {prefix}_max")
        if zero:
            parts.append(f"{rate(col + ' = 0')} AS {prefix}_zero_rate")
        parts.append(f"{rate(col + ' IS NULL')} AS {prefix}_null_rate")
        return ", ".join(parts)
    return block


_B = _dist_profile()


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # ---------------------------------------------------------- sources
    q["read_envelopes"] = w(H) + RAW + """
SELECT snapshot_time_utc, location_name, latitude, longitude, timezone, source, endpoint, n_hours FROM raw"""
    q["envelope_project"] = w(H) + RAW + """
SELECT snapshot_time_utc, location_name, latitude, longitude, timezone, source, endpoint, raw_file FROM raw"""
    q["newest_file"] = w(H) + RAW + """
SELECT location_name, snapshot_time_utc, raw_file FROM raw WHERE raw_file = (SELECT max(raw_file) FROM raw)"""
    q["registry_append"] = """
SELECT 'u' || CAST(user_id AS VARCHAR) AS location_name, ts AS snapshot_time_utc,
       'f' || CAST(event_id AS VARCHAR) AS raw_file,
       sha256(CAST(json_object('k', CAST(json_extract_string(props, '$.k') AS INTEGER)) AS VARCHAR)) AS content_hash,
       TIMESTAMP '2024-02-01' AS inserted_at_utc
FROM events"""
    q["dedup_raw"] = w(REGISTRY_COPIES) + """
SELECT location_name, snapshot_time_utc, raw_file, content_hash, inserted_at_utc FROM (
  SELECT *, row_number() OVER (PARTITION BY raw_file ORDER BY snapshot_time_utc) AS rn FROM registry_copies) x
WHERE rn = 1"""
    q["load_once"] = w(REGISTRY_COPIES) + """
SELECT location_name, snapshot_time_utc, raw_file, content_hash, inserted_at_utc FROM (
  SELECT *, row_number() OVER (PARTITION BY raw_file ORDER BY snapshot_time_utc) AS rn FROM registry_copies) x
WHERE rn = 1 AND raw_file NOT IN (SELECT raw_file FROM registry WHERE extract(day FROM snapshot_time_utc) < 16)"""
    q["content_hash"] = """
SELECT event_id, sha256(CAST(json_object('k', CAST(json_extract_string(props, '$.k') AS INTEGER)) AS VARCHAR))
       AS content_hash
FROM events"""
    q["content_changed"] = w(REGISTRY) + """
SELECT location_name, snapshot_time_utc, raw_file, content_hash,
       coalesce(lag(content_hash) OVER (PARTITION BY location_name ORDER BY snapshot_time_utc, raw_file)
                <> content_hash, TRUE) AS content_changed
FROM registry"""
    # ---------------------------------------------------------- normalization
    q["normalize_hourly"] = w(H) + RAW + NORM
    q["explode_parallel_arrays"] = w(H) + RAW + """
SELECT location_name, snapshot_time_utc, CAST(pos AS BIGINT) AS idx, strftime(forecast_time_local, '%Y-%m-%dT%H:%M')
       AS forecast_time_str, temperature_c AS temperature_2m, feels_like_c AS apparent_temperature,
       precipitation_mm AS precipitation,
       CASE WHEN dom % 7 = 0 AND pos >= n - 3 THEN NULL ELSE wind_kmh END AS windspeed_10m,
       CASE WHEN dom <= 5 THEN NULL ELSE cloudcover_pct END AS cloudcover
FROM raw_pos"""
    q["has_field_cloudcover"] = w(H) + RAW + """
SELECT location_name, snapshot_time_utc, extract(day FROM snapshot_time_utc) > 5 AS has_cloudcover FROM raw"""
    q["has_field_weathercode"] = w(H) + RAW + """
SELECT location_name, snapshot_time_utc, FALSE AS has_hourly_weathercode FROM raw"""
    # ---------------------------------------------------------- versions
    q["latest_snapshot"] = w(H) + LATEST + "\nSELECT * FROM latest"
    q["latest_registered"] = w(REGISTRY) + """
SELECT location_name, max(snapshot_time_utc) AS snapshot_time_utc FROM registry GROUP BY 1"""
    q["latest_two_snapshots"] = w(H, SNAPS) + """
SELECT location_name, snapshot_time_utc, rn FROM (
  SELECT location_name, snapshot_time_utc,
         row_number() OVER (PARTITION BY location_name ORDER BY snapshot_time_utc DESC) AS rn FROM snaps) x
WHERE rn <= 2"""
    q["latest_two_orders"] = """
SELECT o_custkey, o_orderkey, o_orderdate, rn FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x
WHERE rn <= 2"""
    q["snapshot_dense_rank"] = w(H) + """
SELECT location_name, snapshot_time_utc, idx, forecast_time_local,
       dense_rank() OVER (PARTITION BY location_name ORDER BY snapshot_time_utc DESC) AS snapshot_rank
FROM hourly"""
    deltas = """
SELECT c.location_name, c.forecast_time_local, c.snapshot_time_utc AS curr_snapshot, p.snapshot_time_utc AS prev_snapshot,
       c.temperature_c - p.temperature_c AS delta_temp_c, c.feels_like_c - p.feels_like_c AS delta_feels_like_c,
       c.precipitation_mm - p.precipitation_mm AS delta_precip_mm, c.wind_kmh - p.wind_kmh AS delta_wind_kmh
FROM pairs x
JOIN hourly c ON c.location_name = x.location_name AND c.snapshot_time_utc = x.cur_s
JOIN hourly p ON p.location_name = x.location_name AND p.snapshot_time_utc = x.prev_s
     AND p.forecast_time_local = c.forecast_time_local"""
    q["snapshot_deltas"] = w(H, SNAPS) + """,
ranked AS (SELECT location_name, snapshot_time_utc,
                  dense_rank() OVER (PARTITION BY location_name ORDER BY snapshot_time_utc DESC) AS r FROM snaps),
pairs AS (SELECT location_name, max(CASE WHEN r = 1 THEN snapshot_time_utc END) AS cur_s,
                 max(CASE WHEN r = 2 THEN snapshot_time_utc END) AS prev_s FROM ranked GROUP BY 1)""" + deltas + """
QUALIFY row_number() OVER (PARTITION BY c.location_name ORDER BY c.forecast_time_local) <= 20"""
    q["snapshot_deltas_all"] = w(H, SNAPS) + """,
pairs AS (SELECT location_name, snapshot_time_utc AS cur_s,
                 lag(snapshot_time_utc) OVER (PARTITION BY location_name ORDER BY snapshot_time_utc) AS prev_s
          FROM snaps)""" + deltas
    q["forecast_history"] = w(H) + """
SELECT location_name, forecast_time_local, snapshot_time_utc, forecast_date_local, forecast_hour_local,
       temperature_c, feels_like_c, precipitation_mm, wind_kmh, cloudcover_pct
FROM (SELECT *, row_number() OVER (PARTITION BY location_name, forecast_time_local
                                   ORDER BY snapshot_time_utc DESC) AS k FROM hourly) x
WHERE k = 1"""
    # ---------------------------------------------------------- windows and filters
    q["horizon_exact"] = _cur_join(
        "h.forecast_time_local >= c.as_of_utc AND h.forecast_time_local < c.as_of_utc + INTERVAL 6 HOUR")
    q["horizon_hour_aligned"] = _cur_join(
        "h.forecast_time_local >= date_trunc('hour', {now}) "
        "AND h.forecast_time_local < date_trunc('hour', {now}) + INTERVAL 12 HOUR")
    q["today_band"] = _cur_join(
        "h.forecast_time_local >= date_trunc('day', {now}) + INTERVAL 6 HOUR "
        "AND h.forecast_time_local < date_trunc('day', {now}) + INTERVAL 24 HOUR")
    q["hour_band"] = w(H) + "\nSELECT * FROM hourly WHERE forecast_hour_local BETWEEN 6 AND 23"
    q["calendar_day_filter"] = w(H, RUNS + VIS) + """
SELECT c.location_name, c.as_of_utc, c.snapshot_time_utc, h.forecast_time_local,
       CAST(CAST(c.as_of_utc AS DATE) - h.forecast_date_local AS BIGINT) AS day_offset
FROM cur c JOIN hourly h ON h.location_name = c.location_name AND h.snapshot_time_utc = c.snapshot_time_utc
WHERE CAST(c.as_of_utc AS DATE) - h.forecast_date_local IN (0, 1)"""
    q["data_driven_today"] = w(H) + LATEST + """
SELECT location_name, min(forecast_date_local) AS today_date FROM latest GROUP BY 1"""
    q["location_filter"] = w(H) + "\nSELECT * FROM hourly WHERE location_name = 'u1'"
    q["having_filter"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS c FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"""
    # ---------------------------------------------------------- alerts
    q["rain_flag"] = w(H, _decisions(RUNS)) + """
SELECT location_name, as_of_utc, rn, snapshot_time_utc, rain_next6h FROM flags"""
    q["wind_max"] = w(H, _decisions(RUNS)) + """
SELECT location_name, as_of_utc, rn, snapshot_time_utc, max_wind_next6h FROM flags"""
    q["rain_pivot"] = w(H, _decisions(RUNS)) + f"""
SELECT {RAIN_COLS.replace(', should_alert_rain_next6h', '')} FROM dec"""
    q["wind_pivot"] = w(H, _decisions(RUNS)) + f"""
SELECT {WIND_COLS.replace(', should_alert_wind_next6h', '')} FROM dec"""
    q["rain_decision"] = w(H, _decisions(RUNS)) + f"\nSELECT {RAIN_COLS} FROM dec"
    q["show_decision"] = q["rain_decision"]
    q["wind_decision"] = w(H, _decisions(RUNS)) + f"\nSELECT {WIND_COLS} FROM dec"
    all_cols = ("location_name, run_time_utc, current_snapshot_utc, prev_snapshot_utc, current_rain_next6h, "
                "prev_rain_next6h, should_alert_rain_next6h, current_max_wind_next6h, prev_max_wind_next6h, "
                "should_alert_wind_next6h")
    q["alert_replay"] = w(H, _decisions(RUNS)) + f"\nSELECT {all_cols} FROM dec"
    q["alert_replay_wide"] = w(HW, _decisions(RUNS)) + f"\nSELECT {all_cols} FROM dec"
    # ---------------------------------------------------------- gating
    q["last_sent"] = w(ALERT_LOG) + """
SELECT location_name, alert_type, max(sent_time_utc) AS last_sent_time_utc FROM alert_log GROUP BY 1, 2"""
    q["rain_gated"] = _gated_q("should_alert_rain_next6h", RAIN_COLS, "rain_next6h")
    q["wind_gated"] = _gated_q("should_alert_wind_next6h", WIND_COLS, "wind_next6h")
    q["alert_outbox"] = (w(H, _decisions(RUNS), ALERT_LOG)
                         + ",\nrg AS (" + _gated("should_alert_rain_next6h", RAIN_COLS, "rain_next6h") + ")"
                         + ",\nwg AS (" + _gated("should_alert_wind_next6h", WIND_COLS, "wind_next6h") + ")"
                         + """
SELECT run_time_utc AS sent_time_utc, 'rain_next6h' AS alert_type, current_snapshot_utc AS snapshot_time_utc,
       'ALERT: Rain expected in next 6 hours.' AS message, location_name
FROM rg WHERE should_send_after_gating
UNION ALL
SELECT run_time_utc, 'wind_next6h', current_snapshot_utc,
       """ + WIND_TEXT + """,
       location_name
FROM wg WHERE should_send_after_gating""")
    q["alert_feed"] = w(FEED, _decisions(FEED_RUNS, LOCAL_RUN.format("v"))) + f"\nSELECT {all_cols} FROM dec"
    q["alert_feed_outbox"] = FEED_SENDS
    q["cooldown_replay"] = """
WITH RECURSIVE d AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS location_name, event_type AS alert_type, ts AS decision_time_utc,
         event_id AS decision_id
  FROM events
),
nxt AS (
  SELECT a.decision_id, first(b.decision_id ORDER BY b.decision_time_utc, b.decision_id) AS next_id
  FROM d a LEFT JOIN d b ON b.location_name = a.location_name AND b.alert_type = a.alert_type
       AND b.decision_time_utc >= a.decision_time_utc + INTERVAL 2 HOUR
  GROUP BY 1
),
firsts AS (
  SELECT first(decision_id ORDER BY decision_time_utc, decision_id) AS decision_id FROM d GROUP BY location_name, alert_type
),
chain(decision_id) AS (
  SELECT decision_id FROM firsts
  UNION ALL
  SELECT n.next_id FROM chain c JOIN nxt n ON n.decision_id = c.decision_id WHERE n.next_id IS NOT NULL
)
SELECT d.location_name, d.alert_type, d.decision_time_utc, d.decision_id,
       d.decision_id IN (SELECT decision_id FROM chain) AS should_send_after_gating
FROM d"""
    # ---------------------------------------------------------- health
    q["snapshots_of_day"] = w(HEALTH) + """
SELECT location_name, snapshot_time_utc, content_hash, snapshot_time_local, snapshot_hour_local, today_local_date
FROM snaps_of_day"""
    q["dedup_hours"] = w(HEALTH) + "\nSELECT * FROM present"
    q["expected_hours"] = w(HEALTH) + "\nSELECT * FROM expected"
    q["missing_hours"] = w(HEALTH) + "\nSELECT * FROM missing"
    q["hash_changes"] = w(HEALTH) + "\nSELECT * FROM changes"
    q["change_rate"] = w(HEALTH) + "\nSELECT * FROM rates"
    q["missing_hours_list"] = w(HEALTH) + "\nSELECT * FROM mlist"
    q["snapshot_health"] = w(HEALTH) + "\nSELECT * FROM health"
    q["health_latest"] = w(HEALTH) + "\nSELECT * FROM health QUALIFY row_number() OVER (PARTITION BY location_name ORDER BY today_local_date DESC) <= 5"
    # ---------------------------------------------------------- digest
    q["brief_v1"] = w(H, RUNS + VIS) + """,
nh AS (
  SELECT c.location_name, c.as_of_utc, h.temperature_c, h.feels_like_c, h.precipitation_mm, h.wind_kmh
  FROM cur c JOIN hourly h ON h.location_name = c.location_name AND h.snapshot_time_utc = c.snapshot_time_utc
  WHERE h.forecast_time_local >= c.as_of_utc AND h.forecast_time_local < c.as_of_utc + INTERVAL 12 HOUR
)
SELECT r.location_name, r.as_of_utc AS run_time_utc, CAST(r.as_of_utc AS DATE) AS today_local_date,
       """ + mean_round("nh.temperature_c", 1) + """ AS avg_temp_next12h,
       """ + mean_round("nh.feels_like_c", 1) + """ AS avg_feels_next12h,
       MAX(CASE WHEN nh.location_name IS NULL THEN NULL WHEN nh.precipitation_mm > 0 THEN 1 ELSE 0 END)
         AS any_rain_next12h,
       round(MAX(nh.wind_kmh), 0) AS max_wind_next12h
FROM runs r LEFT JOIN nh ON nh.location_name = r.location_name AND nh.as_of_utc = r.as_of_utc
GROUP BY 1, 2, 3"""
    v2_cols = ("location_name, run_time_utc, snapshot_time_utc, avg_temp_c_12h, avg_feels_like_c_12h, "
               "avg_cloudcover_pct_12h, sky_text, rain_possible, max_wind_kmh_12h, window_start_local, "
               "window_end_local, n_hours")
    q["brief_v2"] = w(H, _v2_rows(RUNS)) + f"\nSELECT {v2_cols} FROM v2"
    q["dayparts_line"] = w(H, _v2_rows(RUNS)) + """
SELECT location_name, as_of_utc AS run_time_utc, snapshot_time_utc,
       string_agg(daypart || ' ' || CAST(CAST(temp0 AS INTEGER) AS VARCHAR) || '°C'
                  || CASE WHEN rain_possible THEN ' (rain)' ELSE '' END, ' • ' ORDER BY """ + SORT_KEY + """)
         AS dayparts_line
FROM parts12 GROUP BY 1, 2, 3"""
    q["dayparts_meta"] = w(H, _v2_rows(RUNS)) + """
SELECT location_name, as_of_utc AS run_time_utc, snapshot_time_utc, rainy_parts, total_parts FROM meta"""
    q["brief_final"] = w(H, _v2_rows(RUNS)) + "\nSELECT * FROM final"
    q["brief_feed"] = w(FEED, _v2_rows(FEED_RUNS, LOCAL_RUN.format("c"))) + "\nSELECT * FROM final"
    q["stream_brief_once"] = w(FEED, _v2_rows(FEED_RUNS, LOCAL_RUN.format("c"))) + """,
at_home AS (
  SELECT f.*, timezone(r.timezone, timezone('UTC', f.run_time_utc)) AS local_run
  FROM final f JOIN runs r ON r.location_name = f.location_name AND r.as_of_utc = f.run_time_utc
),
firsts AS (
  SELECT location_name, CAST(local_run AS DATE) AS sent_date_local, min(run_time_utc) AS run_time_utc
  FROM at_home WHERE extract(hour FROM local_run) >= 7 GROUP BY 1, 2
)
SELECT e.sent_date_local, e.run_time_utc AS sent_time_utc, location_name, """ + BRIEF_TEXT + """ AS message
FROM firsts e JOIN final USING (location_name, run_time_utc)"""
    q["brief_outbox"] = w(H, _v2_rows(DIGEST_RUNS), BRIEF_LOG) + """,
elig AS (
  SELECT f.*, CAST(f.run_time_utc AS DATE) AS sent_date_local,
         row_number() OVER (PARTITION BY f.location_name, CAST(f.run_time_utc AS DATE) ORDER BY f.run_time_utc) AS k
  FROM final f
  WHERE extract(hour FROM f.run_time_utc) >= 7
    AND NOT EXISTS (SELECT 1 FROM brief_log b WHERE b.location_name = f.location_name
                    AND b.sent_date_local = CAST(f.run_time_utc AS DATE))
)
SELECT sent_date_local, run_time_utc AS sent_time_utc, location_name,
       """ + BRIEF_TEXT + """ AS message
FROM elig WHERE k = 1"""
    q["brief_metrics"] = w(H, _days(FINAL_RUNS, 4)) + """
SELECT m.location_name, m.run_date AS today_date, m.today_avg_temp, m.yday_avg_temp,
       m.today_avg_temp - m.yday_avg_temp AS delta_vs_yesterday, m.last4_avg_temp,
       m.today_avg_temp - m.last4_avg_temp AS delta_vs_last4days, c.most_changed_daypart, c.max_daypart_delta
FROM day_means m LEFT JOIN most_changed c ON c.location_name = m.location_name AND c.as_of_utc = m.as_of_utc
WHERE m.has_today IS NOT NULL"""
    q["brief_metrics_faithful"] = w(H) + LATEST + f""",
td AS (SELECT location_name, min(forecast_date_local) AS today_date FROM latest GROUP BY 1),
rows AS (
  SELECT l.location_name, t.today_date, l.temperature_c, CAST(t.today_date - l.forecast_date_local AS INTEGER) AS back
  FROM latest l JOIN td t ON t.location_name = l.location_name
  WHERE l.forecast_hour_local BETWEEN 6 AND 23
),
m AS (
  SELECT location_name, today_date,
         {mean('CASE WHEN back = 0 THEN temperature_c END')} AS today_avg_temp,
         {mean('CASE WHEN back = 1 THEN temperature_c END')} AS yday_avg_temp,
         {mean('CASE WHEN back BETWEEN 1 AND 4 THEN temperature_c END')} AS last4_avg_temp
  FROM rows GROUP BY 1, 2 HAVING max(CASE WHEN back = 0 THEN 1 END) IS NOT NULL
)
SELECT location_name, today_date, today_avg_temp, yday_avg_temp, today_avg_temp - yday_avg_temp AS delta_vs_yesterday,
       last4_avg_temp, today_avg_temp - last4_avg_temp AS delta_vs_last4days,
       CAST(NULL AS VARCHAR) AS most_changed_daypart, CAST(NULL AS DOUBLE) AS max_daypart_delta
FROM m"""
    q["last4_avg"] = w(H, _days(RUNS, 4)) + """
SELECT location_name, run_date AS today_date, last4_avg_temp FROM day_means"""
    q["most_changed_daypart"] = w(H, _days(RUNS, 1)) + "\nSELECT * FROM most_changed"
    q["daily_headline"] = w(H, _days(RUNS, 4)) + """
SELECT m.location_name, m.today_avg_temp, m.yday_avg_temp, m.today_avg_temp - m.yday_avg_temp AS delta_avg_temp,
       c.most_changed_daypart, c.max_daypart_delta
FROM day_means m JOIN most_changed c ON c.location_name = m.location_name AND c.as_of_utc = m.as_of_utc
WHERE m.has_today IS NOT NULL AND m.has_yday IS NOT NULL"""
    q["daypart_summary_today"] = w(H, _days(RUNS, 1)) + _daypart_summary("today_rows", "A")
    q["daypart_summary_yesterday"] = w(H, _days(RUNS, 1)) + _daypart_summary(
        "(SELECT * FROM past_rows WHERE back = 1)", "B")
    q["compare_days"] = w(H, _days(RUNS, 1)) + f""",
t AS ({_daypart_summary('today_rows', 'B')}),
y AS ({_daypart_summary('(SELECT * FROM past_rows WHERE back = 1)', 'B')})
SELECT t.location_name, t.as_of_utc, t.daypart, t.avg_temp_c AS today_temp, y.avg_temp_c AS yday_temp,
       t.avg_temp_c - y.avg_temp_c AS delta_temp, t.avg_wind_kmh AS today_wind, y.avg_wind_kmh AS yday_wind,
       t.avg_wind_kmh - y.avg_wind_kmh AS delta_wind
FROM t JOIN y ON t.location_name = y.location_name AND t.as_of_utc = y.as_of_utc AND t.daypart = y.daypart"""
    # ---------------------------------------------------------- profile
    q["raw_summary"] = w(H) + RAW + """
SELECT location_name, COUNT(*) AS n_snapshots, min(snapshot_time_utc) AS first_snapshot_utc,
       max(snapshot_time_utc) AS last_snapshot_utc FROM raw GROUP BY 1"""
    q["registry_summary"] = w(REGISTRY) + """
SELECT location_name, COUNT(*) AS n_files_loaded, min(snapshot_time_utc) AS first_snapshot,
       max(snapshot_time_utc) AS last_snapshot FROM registry GROUP BY 1"""
    q["hourly_summary"] = w(H) + """
SELECT location_name, COUNT(*) AS n_rows, COUNT(DISTINCT snapshot_time_utc) AS n_snapshots,
       min(forecast_time_local) AS first_forecast_time_local, max(forecast_time_local) AS last_forecast_time_local
FROM hourly GROUP BY 1"""
    q["duplicate_key_count"] = w(H) + """
SELECT COUNT(*) AS duplicate_keys FROM (
  SELECT 1 FROM hourly GROUP BY location_name, snapshot_time_utc, forecast_time_local HAVING COUNT(*) > 1) x"""
    q["duplicate_key_count_lineitem"] = """
SELECT COUNT(*) AS duplicate_keys FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) x"""
    q["duplicate_examples"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS c, min(l_suppkey) AS min_idx, max(l_suppkey) AS max_idx
FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
ORDER BY l_orderkey DESC, l_linenumber LIMIT 20"""
    q["hours_per_snapshot"] = w(H) + """
SELECT location_name, snapshot_time_utc, COUNT(*) AS n_hours FROM hourly GROUP BY 1, 2
QUALIFY row_number() OVER (PARTITION BY location_name ORDER BY snapshot_time_utc DESC) <= 20"""
    q["rows_per_snapshot"] = w(H) + """
SELECT location_name, snapshot_time_utc, COUNT(*) AS rows FROM hourly GROUP BY 1, 2"""
    q["rows_per_snapshot_newest"] = w(H) + """
SELECT location_name, snapshot_time_utc, rows FROM (
  SELECT location_name, snapshot_time_utc, COUNT(*) AS rows,
         row_number() OVER (PARTITION BY location_name ORDER BY snapshot_time_utc DESC) AS k
  FROM hourly GROUP BY 1, 2) x WHERE k <= 10"""
    q["cloud_range"] = w(H) + """
SELECT location_name, snapshot_time_utc, min_cloud, max_cloud FROM (
  SELECT location_name, snapshot_time_utc, min(cloudcover_pct) AS min_cloud, max(cloudcover_pct) AS max_cloud,
         row_number() OVER (PARTITION BY location_name ORDER BY snapshot_time_utc DESC) AS k
  FROM hourly GROUP BY 1, 2) x WHERE k <= 3"""
    q["latest_raw"] = w(H) + RAW + """
SELECT location_name, snapshot_time_utc, raw_file FROM (
  SELECT *, row_number() OVER (PARTITION BY location_name ORDER BY snapshot_time_utc DESC) AS k FROM raw) x
WHERE k <= 5"""
    q["registry_latest"] = w(REGISTRY) + """
SELECT location_name, snapshot_time_utc FROM (
  SELECT *, row_number() OVER (PARTITION BY location_name ORDER BY snapshot_time_utc DESC) AS k FROM registry) x
WHERE k <= 5"""
    q["total_rows"] = w(H) + "\nSELECT COUNT(*) AS total_rows FROM hourly"
    q["distribution_profile"] = w(H) + f"""
SELECT location_name, {_B('temperature_c', 'temp', [0.05, 0.5, 0.95])}, {_B('feels_like_c', 'feels', [0.5])},
       {_B('precipitation_mm', 'precip', [0.5, 0.95], True)}, {_B('wind_kmh', 'wind', [0.5, 0.95])}
FROM hourly GROUP BY 1"""
    q["distribution_profile_lineitem"] = f"""
SELECT l_returnflag, {_B('l_quantity', 'qty', [0.05, 0.5, 0.95])}, {_B('l_extendedprice', 'price', [0.05, 0.5, 0.95])},
       {_B('l_discount', 'disc', [0.05, 0.5, 0.95], True)}
FROM lineitem GROUP BY 1"""
    q["latest_rows_with_type"] = w(H) + LATEST + """
SELECT location_name, snapshot_time_utc, forecast_time_local, typeof(forecast_time_local) AS forecast_time_local_type,
       precipitation_mm
FROM (SELECT *, row_number() OVER (PARTITION BY location_name ORDER BY forecast_time_local) AS k FROM latest) x
WHERE k <= 5"""
    q["stats_and_sample"] = w(H) + LATEST + """
SELECT location_name, 'STATS' AS section, CAST(snapshot_time_utc AS VARCHAR) AS latest_snapshot_utc,
       CAST(COUNT(*) AS VARCHAR) AS a, CAST(min(forecast_time_local) AS VARCHAR) AS b,
       CAST(max(forecast_time_local) AS VARCHAR) AS c, typeof(min(forecast_time_local)) AS d
FROM latest GROUP BY location_name, snapshot_time_utc
UNION ALL
SELECT location_name, 'SAMPLE', CAST(snapshot_time_utc AS VARCHAR), CAST(forecast_time_local AS VARCHAR),
       typeof(forecast_time_local), CAST(CAST(precipitation_mm AS DECIMAL(38,9)) AS VARCHAR), ''
FROM (SELECT *, row_number() OVER (PARTITION BY location_name ORDER BY forecast_time_local) AS k FROM latest) x
WHERE k <= 5"""
    # ---------------------------------------------------------- streaming (one trigger = batch rule)
    q["stream_ingest"] = q["read_envelopes"]
    q["stream_dedup"] = w(REGISTRY) + "\nSELECT location_name, raw_file, snapshot_time_utc FROM registry"
    q["stream_hour_counts"] = w(REGISTRY_COPIES) + """
SELECT location_name, date_trunc('hour', snapshot_time_utc) AS hour_start_utc, COUNT(*) AS n_snapshots,
       min(content_hash) AS content_hash
FROM registry_copies GROUP BY 1, 2"""
    q["stream_change"] = q["content_changed"]
    q["stream_change_by_snapshot"] = q["content_changed"]
    q["stream_cooldown"] = q["cooldown_replay"]
    q["stream_alert"] = q["alert_feed_outbox"]
    # ---------------------------------------------------------- sinks
    q["append_alert_log"] = q["alert_outbox"]
    q["append_brief_log"] = (q["brief_outbox"])
    q["append_health"] = q["snapshot_health"]
    q["rebuild_table"] = w(H) + "\nSELECT * FROM hourly"
    q["create_if_missing"] = w(REGISTRY) + (
        "\nSELECT location_name, snapshot_time_utc, raw_file, content_hash, inserted_at_utc FROM registry")
    # ---------------------------------------------------------- wide variants (F6)
    for k in ("brief_final", "compare_days", "brief_metrics", "snapshot_deltas_all", "forecast_history",
              "normalize_hourly"):
        assert H.strip("\n") in q[k]
        q[k + "_wide"] = q[k].replace(H.strip("\n"), HW.strip("\n"))
    return q
