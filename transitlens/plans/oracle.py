"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The oracle restates each query's semantics in plain SQL over the driver's
tables, independently of the Spark operators: e.g. bunching is the direct
all-pairs self-join here, while the Spark operator uses the grid method.
Shared building blocks are CTE fragments joined into one WITH clause.
"""
from __future__ import annotations

# Fixed values used by the SQL below (same as transitlens.config / fixtures).
TZ_OFFSET_S = 19800   # Asia/Kolkata, +05:30, no daylight saving

CTE = {}

CTE["raw"] = """
ev AS (
  SELECT event_id, user_id,
         1767225600 + (epoch_us(ts) // 1000000 - 1704067200) // 10 AS obs_epoch
  FROM events
),
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS entity_id,
         'V' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS vehicle_id,
         CASE WHEN event_id % 89 <> 0 THEN CAST(user_id % 6 AS VARCHAR) END AS route_id,
         CASE WHEN event_id % 89 <> 0 THEN CAST(user_id % 6 AS VARCHAR) || '_' ||
              lpad(CAST(event_id % 24 AS VARCHAR), 2, '0') || '_' ||
              lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') END AS trip_id,
         CASE WHEN event_id % 97 = 0 THEN 0.0::DOUBLE
              ELSE 28.55::DOUBLE + CAST((event_id * 7919) % 10 AS DOUBLE) / 100.0::DOUBLE END AS latitude,
         CASE WHEN event_id % 97 = 0 THEN 0.0::DOUBLE
              ELSE 77.10::DOUBLE + CAST(((event_id * 104729) // 10) % 10 AS DOUBLE) / 100.0::DOUBLE END AS longitude,
         0.0::DOUBLE AS speed,
         obs_epoch AS vehicle_timestamp,
         CAST(obs_epoch // 3600 + rep AS VARCHAR) AS fetched_at,
         user_id
  FROM ev CROSS JOIN (SELECT 0 AS rep UNION ALL SELECT 1) r
  WHERE rep = 0 OR event_id % 11 = 0
)"""

CTE["pings"] = """
pos AS (
  SELECT vehicle_id, trim(route_id) AS route_id, trim(trip_id) AS trip_id,
         latitude AS lat, longitude AS lon, vehicle_timestamp AS obs_epoch, fetched_at AS snapshot_id
  FROM raw
),
valid_pos AS (
  SELECT * FROM pos
  WHERE route_id IS NOT NULL AND vehicle_id IS NOT NULL AND obs_epoch IS NOT NULL
    AND lat BETWEEN 28.0 AND 29.0 AND lon BETWEEN 76.5 AND 77.8
),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY vehicle_id, obs_epoch
                                 ORDER BY snapshot_id NULLS FIRST, route_id NULLS FIRST,
                                          trip_id NULLS FIRST, lat, lon) AS rn
    FROM valid_pos) WHERE rn = 1
),
lagged AS (
  SELECT *, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon,
         obs_epoch - lag(obs_epoch) OVER w AS gap_s
  FROM dedup WINDOW w AS (PARTITION BY vehicle_id ORDER BY obs_epoch)
),
dist AS (
  SELECT *, 12742000.0::DOUBLE * asin(sqrt(
           sin(radians(lat - prev_lat) / 2) * sin(radians(lat - prev_lat) / 2)
           + cos(radians(prev_lat)) * cos(radians(lat)) * sin(radians(lon - prev_lon) / 2) * sin(radians(lon - prev_lon) / 2)
         )) AS dist_m
  FROM lagged
),
spd AS (
  SELECT * EXCLUDE (prev_lat, prev_lon),
         round(CASE WHEN gap_s BETWEEN 60 AND 1500 THEN dist_m / gap_s * 3.6 END, 2) AS speed_kmph
  FROM dist
),
flagged AS (
  SELECT *, coalesce(speed_kmph <= 80.0, false) AS is_speed_valid,
         coalesce(speed_kmph <= 80.0 AND speed_kmph > 3.0, false) AS is_moving,
         DATE '1970-01-01' + CAST((obs_epoch + 19800) // 86400 AS INTEGER) AS service_date,
         CAST(((obs_epoch + 19800) // 3600) % 24 AS INTEGER) AS hour_of_day,
         CAST(dayofweek(DATE '1970-01-01' + CAST((obs_epoch + 19800) // 86400 AS INTEGER)) + 1 AS INTEGER) AS day_of_week,
         TRY_CAST(split_part(trip_id, '_', 2) AS INTEGER) AS dispatch_hour,
         TRY_CAST(split_part(trip_id, '_', 3) AS INTEGER) AS dispatch_minute
  FROM spd
),
mv AS (
  SELECT snapshot_id, route_id, vehicle_id, lat, lon FROM flagged WHERE is_moving AND snapshot_id IS NOT NULL
),
close_pairs AS (
  SELECT a.snapshot_id, a.route_id, a.vehicle_id AS v1, b.vehicle_id AS v2,
         12742000.0::DOUBLE * asin(sqrt(
           sin(radians(b.lat - a.lat) / 2) * sin(radians(b.lat - a.lat) / 2)
           + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lon - a.lon) / 2) * sin(radians(b.lon - a.lon) / 2)
         )) AS d
  FROM mv a JOIN mv b ON a.snapshot_id = b.snapshot_id AND a.route_id = b.route_id AND a.vehicle_id < b.vehicle_id
),
bunched_set AS (
  SELECT snapshot_id, route_id, v1 AS vehicle_id FROM close_pairs WHERE d < 300.0
  UNION
  SELECT snapshot_id, route_id, v2 FROM close_pairs WHERE d < 300.0
),
pings AS (
  SELECT f.*, (b.vehicle_id IS NOT NULL) AS is_bunched
  FROM flagged f LEFT JOIN bunched_set b
    ON f.snapshot_id = b.snapshot_id AND f.route_id = b.route_id AND f.vehicle_id = b.vehicle_id
)"""

CTE["route_hour"] = """
route_hour AS (
  SELECT route_id, service_date, hour_of_day, day_of_week,
         CAST(count(*) AS BIGINT) AS n_pings,
         CAST(count(DISTINCT vehicle_id) AS BIGINT) AS n_vehicles,
         CAST(sum(CAST(is_speed_valid AS BIGINT)) AS BIGINT) AS n_speed_obs,
         CAST(sum(CAST(is_moving AS BIGINT)) AS BIGINT) AS n_moving,
         CAST(round(CAST(avg(CASE WHEN is_speed_valid THEN speed_kmph END) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_speed_kmph,
         CAST(round(CAST(avg(CASE WHEN is_moving THEN speed_kmph END) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_moving_speed_kmph,
         CAST(sum(CAST(is_bunched AS BIGINT)) AS BIGINT) AS n_bunched
  FROM pings GROUP BY route_id, service_date, hour_of_day, day_of_week
)"""

CTE["warehouse"] = """
dim_route AS (
  SELECT CAST(row_number() OVER (ORDER BY route_id) AS INTEGER) AS route_key, route_id
  FROM (SELECT DISTINCT route_id FROM (SELECT route_id FROM pings UNION ALL SELECT route_id FROM route_hour) u
        WHERE route_id IS NOT NULL) d
),
dim_vehicle AS (
  SELECT CAST(row_number() OVER (ORDER BY vehicle_id) AS INTEGER) AS vehicle_key, vehicle_id
  FROM (SELECT DISTINCT vehicle_id FROM pings WHERE vehicle_id IS NOT NULL) d
),
dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
         CAST(year(d) AS SMALLINT) AS year, CAST(month(d) AS SMALLINT) AS month, CAST(day(d) AS SMALLINT) AS day,
         CAST(dayofweek(d) + 1 AS SMALLINT) AS day_of_week, dayname(d) AS day_name,
         dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(generate_series AS DATE) AS d
        FROM generate_series(TIMESTAMP '2026-01-01', TIMESTAMP '2028-12-31', INTERVAL 1 DAY)) g
),
dim_hour AS (
  SELECT CAST(h AS SMALLINT) AS hour_key,
         lpad(CAST(h AS VARCHAR), 2, '0') || ':00-' || lpad(CAST(h AS VARCHAR), 2, '0') || ':59' AS hour_label,
         CASE WHEN h BETWEEN 0 AND 5 THEN 'Night' WHEN h BETWEEN 6 AND 10 THEN 'Morning peak'
              WHEN h BETWEEN 11 AND 15 THEN 'Midday' WHEN h BETWEEN 16 AND 20 THEN 'Evening peak'
              ELSE 'Late evening' END AS day_part
  FROM range(24) t(h)
),
fact_rh AS (
  SELECT CAST(year(service_date) * 10000 + month(service_date) * 100 + day(service_date) AS INTEGER) AS date_key,
         CAST(hour_of_day AS SMALLINT) AS hour_key, r.route_key,
         CAST(n_pings AS INTEGER) AS n_pings, CAST(n_vehicles AS INTEGER) AS n_vehicles,
         CAST(n_speed_obs AS INTEGER) AS n_speed_obs, CAST(n_moving AS INTEGER) AS n_moving,
         CAST(avg_speed_kmph AS DECIMAL(7,2)) AS avg_speed_kmph,
         CAST(avg_moving_speed_kmph AS DECIMAL(7,2)) AS avg_moving_speed_kmph,
         CAST(n_bunched AS INTEGER) AS n_bunched
  FROM route_hour JOIN dim_route r USING (route_id)
  WHERE CAST(year(service_date) * 10000 + month(service_date) * 100 + day(service_date) AS INTEGER)
        IN (SELECT date_key FROM dim_date)
),
fact_ping AS (
  SELECT p.obs_epoch,
         CAST(year(service_date) * 10000 + month(service_date) * 100 + day(service_date) AS INTEGER) AS date_key,
         CAST(hour_of_day AS SMALLINT) AS hour_key, r.route_key, v.vehicle_key, trip_id,
         CAST(dispatch_hour AS SMALLINT) AS dispatch_hour, CAST(dispatch_minute AS SMALLINT) AS dispatch_minute,
         CAST(lat AS DECIMAL(9,6)) AS lat, CAST(lon AS DECIMAL(9,6)) AS lon, CAST(gap_s AS INTEGER) AS gap_s,
         CAST(CAST(dist_m AS DECIMAL(38,6)) AS DECIMAL(10,1)) AS dist_m, CAST(speed_kmph AS DECIMAL(8,2)) AS speed_kmph,
         is_speed_valid, is_moving, is_bunched
  FROM pings p JOIN dim_route r USING (route_id) JOIN dim_vehicle v USING (vehicle_id)
  WHERE CAST(year(service_date) * 10000 + month(service_date) * 100 + day(service_date) AS INTEGER)
        IN (SELECT date_key FROM dim_date)
),
rh_view AS (
  SELECT f.*, r.route_id, d.full_date, d.day_of_week, h.hour_label, h.day_part
  FROM fact_rh f JOIN dim_route r USING (route_key) JOIN dim_date d USING (date_key) JOIN dim_hour h USING (hour_key)
)"""

ORDER = ["raw", "pings", "route_hour", "warehouse"]


def with_ctes(*names: str) -> str:
    """WITH clause holding the named fragments and everything they depend on."""
    need = set()
    for n in names:
        need.update(ORDER[: ORDER.index(n) + 1])
    return "WITH " + ",".join(CTE[n].strip("\n") for n in ORDER if n in need) + "\n"


def quality_sql(dataset: str, relation: str, checks) -> str:
    """One SELECT per check over ``relation`` (a CTE name), UNION ALL'ed;
    the same result columns as operators.quality.run_suite."""
    parts = []
    for i, c in enumerate(checks):
        head = (f"SELECT '{dataset}' AS dataset, CAST({i} AS INTEGER) AS check_no, '{c.check_id}' AS check_id, "
                f"'{c.check_type}' AS check_type, '{c.column or ','.join(c.columns)}' AS column_name")
        if c.check_type == "row_count_between":
            parts.append(f"{head}, count(*) >= {c.min_value} AS success, CAST(count(*) AS BIGINT) AS element_count, "
                         f"CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_pct FROM {relation}")
            continue
        if c.check_type == "compound_unique":
            cols = ", ".join(c.columns)
            present = " OR ".join(f"{k} IS NOT NULL" for k in c.columns)
            u, d, src = ("coalesce(sum(CASE WHEN k > 1 THEN k END), 0)", "coalesce(sum(k), 0)",
                         f"(SELECT count(*) AS k FROM {relation} WHERE {present} GROUP BY {cols}) g")
            n = f"(SELECT count(*) FROM {relation})"
        else:
            col = c.column
            if c.check_type == "not_null":
                u, d = f"count(*) FILTER (WHERE {col} IS NULL)", "count(*)"
            elif c.check_type == "between":
                conds = []
                if c.min_value is not None:
                    conds.append(f"{col} >= {c.min_value}")
                if c.max_value is not None:
                    conds.append(f"{col} <= {c.max_value}")
                u, d = f"count(*) FILTER (WHERE {col} IS NOT NULL AND NOT ({' AND '.join(conds)}))", f"count({col})"
            elif c.check_type == "in_set":
                vals = ", ".join("true" if v is True else "false" if v is False else repr(v) for v in c.values)
                u, d = f"count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))", f"count({col})"
            elif c.check_type == "pair_a_ge_b":
                both = f"{col} IS NOT NULL AND {c.column_b} IS NOT NULL"
                op = ">=" if c.or_equal else ">"
                u, d = f"count(*) FILTER (WHERE {both} AND NOT ({col} {op} {c.column_b}))", f"count(*) FILTER (WHERE {both})"
            else:
                raise ValueError(c.check_type)
            src, n = relation, "count(*)"
        parts.append(
            f"SELECT * EXCLUDE (u, d), CAST(u AS BIGINT) AS unexpected_count, "
            f"CASE WHEN d > 0 THEN CAST(round(CAST(CAST(u AS DOUBLE) * 100.0 / d AS DECIMAL(38,8)), 4) AS DOUBLE) END AS unexpected_pct "
            f"FROM (SELECT dataset, check_no, check_id, check_type, column_name, "
            f"coalesce(CAST(d - u AS DOUBLE) / nullif(d, 0) >= {c.mostly}, true) AS success, element_count, u, d "
            f"FROM ({head}, CAST({n} AS BIGINT) AS element_count, {u} AS u, {d} AS d FROM {src}) x) y")
    return "\nUNION ALL\n".join(parts)


_BATCH_NAMES = ["ev", "raw", "pos", "valid_pos", "dedup", "lagged", "dist", "spd", "flagged", "mv",
                "close_pairs", "bunched_set", "pings", "route_hour"]


def batch_ctes(suffix: str, event_filter: str) -> str:
    """The raw -> pings -> route_hour fragments restricted to a subset of events,
    with every CTE name suffixed (for two-batch load fixtures)."""
    import re
    text = ",".join(CTE[n].strip("\n") for n in ["raw", "pings", "route_hour"])
    text = text.replace("FROM events", f"FROM (SELECT * FROM events WHERE {event_filter}) events_sub", 1)
    for n in sorted(_BATCH_NAMES, key=len, reverse=True):
        text = re.sub(rf"\b{n}\b(?!\.)", f"{n}{suffix}", text)
    return text

CTE_STATIC = """
stop_times AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_suppkey AS VARCHAR) AS stop_id,
         TRY_CAST(CAST(l_linenumber AS VARCHAR) AS INTEGER) AS stop_sequence,
         CAST(split_part(hms, ':', 1) AS INTEGER) * 3600 + CAST(split_part(hms, ':', 2) AS INTEGER) * 60
           + CAST(split_part(hms, ':', 3) AS INTEGER) AS sched_arrival_sec
  FROM (SELECT *, lpad(CAST(sec // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST((sec // 60) % 60 AS VARCHAR), 2, '0')
                  || ':' || lpad(CAST(sec % 60 AS VARCHAR), 2, '0') AS hms
        FROM (SELECT *, (l_partkey * 37) % 108000 AS sec FROM lineitem) a) b
),
stops AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS stop_id, s_name AS stop_name,
         28.55::DOUBLE + CAST(s_suppkey % 10 AS DOUBLE) / 100.0::DOUBLE AS stop_lat,
         77.10::DOUBLE + CAST((s_suppkey // 10) % 10 AS DOUBLE) / 100.0::DOUBLE AS stop_lon
  FROM supplier
),
trips AS (SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id FROM orders),
routes AS (SELECT CAST(c_custkey AS VARCHAR) AS route_id, c_mktsegment AS route_short_name, c_name AS route_long_name FROM customer),
dpos AS (
  SELECT vehicle_id, CAST(user_id AS VARCHAR) AS trip_id, route_id AS route_id_rt, latitude AS lat, longitude AS lon,
         speed, vehicle_timestamp AS obs_epoch
  FROM raw
),
dpos_clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY vehicle_id, obs_epoch ORDER BY trip_id NULLS FIRST,
             route_id_rt NULLS FIRST, lat NULLS FIRST, lon NULLS FIRST, speed NULLS FIRST) AS rn
    FROM dpos WHERE trip_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND obs_epoch IS NOT NULL) x
  WHERE rn = 1
),
cand AS (
  SELECT p.*, st.stop_id, st.stop_sequence, st.sched_arrival_sec, s.stop_name, s.stop_lat, s.stop_lon,
         12742000.0::DOUBLE * asin(sqrt(
           sin(radians(s.stop_lat - p.lat) / 2) * sin(radians(s.stop_lat - p.lat) / 2)
           + cos(radians(p.lat)) * cos(radians(s.stop_lat)) * sin(radians(s.stop_lon - p.lon) / 2) * sin(radians(s.stop_lon - p.lon) / 2)
         )) AS dist_to_stop_m
  FROM dpos_clean p JOIN stop_times st USING (trip_id) JOIN stops s USING (stop_id)
),
nearest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY vehicle_id, obs_epoch
             ORDER BY CAST(round(CAST(dist_to_stop_m AS DECIMAL(38,6)), 1) AS DOUBLE), stop_sequence NULLS FIRST,
                      stop_id NULLS FIRST, sched_arrival_sec NULLS FIRST, dist_to_stop_m) AS rn
    FROM cand) x WHERE rn = 1
),
delays AS (
  SELECT n.*, t.route_id, r.route_short_name, r.route_long_name,
         DATE '1970-01-01' + CAST((obs_epoch + 19800) // 86400 AS INTEGER) + day_shift AS service_date,
         CAST(((obs_epoch + 19800) // 3600) % 24 AS INTEGER) AS hour_of_day,
         CAST(dayofweek(DATE '1970-01-01' + CAST((obs_epoch + 19800) // 86400 AS INTEGER)) + 1 AS INTEGER) AS day_of_week,
         raw_delay - CAST(day_shift AS BIGINT) * 86400 AS delay_sec,
         CAST(round(CAST((raw_delay - CAST(day_shift AS BIGINT) * 86400) / 60.0 AS DECIMAL(38,6)), 2) AS DOUBLE) AS delay_min,
         dist_to_stop_m <= 150.0 AS is_near_stop,
         abs(raw_delay - CAST(day_shift AS BIGINT) * 86400) > 10800 AS is_outlier
  FROM (SELECT *, CAST(round(raw_delay / 86400.0) AS INTEGER) AS day_shift
        FROM (SELECT *, obs_epoch - (((obs_epoch + 19800) // 86400) * 86400 - 19800 + sched_arrival_sec) AS raw_delay
              FROM nearest) a) n
  LEFT JOIN trips t USING (trip_id) LEFT JOIN routes r USING (route_id)
)"""


def with_static() -> str:
    return with_ctes("raw") + "," + CTE_STATIC.strip("\n") + "\n"
