"""Query catalogue: name -> (spark builder, oracle SQL).

Every builder takes (spark, sf_dir) and reads the driver's tables, so its
work grows with them.  Output columns are aliased identically to the oracle
SQL; doubles that come out of trigonometry are rounded the way the warehouse
stores them (distance 1 dp, speed 2 dp) so both engines agree exactly, and
instants are emitted as UTC TIMESTAMP_NTZ so no session time zone leaks in.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from transitlens.config import DEFAULT
from transitlens.functions.timefn import utc_ntz
from transitlens.operators import bunching, metrics
from transitlens.plans import flow
from transitlens.plans.oracle import with_ctes, with_static
from transitlens.sources import fixtures
from transitlens.sources.fixtures import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _pings(spark, sf_dir):
    return flow.fixture_pings(Tables(spark, sf_dir))


def _route_hour(spark, sf_dir):
    return metrics.route_hour(_pings(spark, sf_dir))


PING_OUT = ["snapshot_id", "route_id", "vehicle_id", "trip_id", "lat", "lon", "obs_epoch", "obs_ts",
            "service_date", "hour_of_day", "day_of_week", "dispatch_hour", "dispatch_minute",
            "gap_s", "dist_m", "speed_kmph", "is_speed_valid", "is_moving", "is_bunched"]


def ping_output(df: DataFrame) -> DataFrame:
    return df.select(
        "snapshot_id", "route_id", "vehicle_id", "trip_id", "lat", "lon", "obs_epoch",
        utc_ntz("obs_epoch").alias("obs_ts"), "service_date", "hour_of_day", "day_of_week",
        "dispatch_hour", "dispatch_minute", "gap_s",
        F.round(F.col("dist_m").cast("decimal(38,6)"), 1).cast("double").alias("dist_m"),
        "speed_kmph", "is_speed_valid", "is_moving", "is_bunched")


PING_SQL_COLS = """snapshot_id, route_id, vehicle_id, trip_id, lat, lon, obs_epoch,
  make_timestamp(obs_epoch * 1000000) AS obs_ts, service_date, hour_of_day, day_of_week,
  dispatch_hour, dispatch_minute, gap_s,
  CAST(round(CAST(dist_m AS DECIMAL(38,6)), 1) AS DOUBLE) AS dist_m,
  speed_kmph, is_speed_valid, is_moving, is_bunched"""


@register("clean_pings", with_ctes("pings") + f"SELECT {PING_SQL_COLS} FROM pings")
def q_clean_pings(spark, sf_dir):
    """The vehicle_pings_clean table."""
    return ping_output(_pings(spark, sf_dir))


@register("derived_speed", with_ctes("pings") + """
SELECT vehicle_id, obs_epoch, gap_s, CAST(round(CAST(dist_m AS DECIMAL(38,6)), 1) AS DOUBLE) AS dist_m,
       speed_kmph, is_speed_valid, is_moving
FROM pings WHERE gap_s IS NOT NULL""")
def q_derived_speed(spark, sf_dir):
    """Pings that have a predecessor, with gap, distance and speed."""
    return (ping_output(_pings(spark, sf_dir)).filter(F.col("gap_s").isNotNull())
            .select("vehicle_id", "obs_epoch", "gap_s", "dist_m", "speed_kmph", "is_speed_valid", "is_moving"))


@register("bunched_vehicles", with_ctes("pings") + "SELECT snapshot_id, route_id, vehicle_id FROM bunched_set")
def q_bunched_vehicles(spark, sf_dir):
    """(snapshot, route, vehicle) with a moving partner closer than 300 m (grid method)."""
    return bunching.close_vehicles(_pings_unflagged(spark, sf_dir))


def _pings_unflagged(spark, sf_dir):
    """Cleaned pings before bunching; written once because the bunching plan reads
    them in several branches."""
    from transitlens.operators import pings as P
    from transitlens.sources import feed, fixtures
    raw = fixtures.raw_feed(Tables(spark, sf_dir)("events"))
    return flow.write_and_read(P.clean(feed.positions_for_speed(raw)), "cleaned")


@register("route_hour_speed", with_ctes("route_hour") + "SELECT * FROM route_hour")
def q_route_hour_speed(spark, sf_dir):
    """A1 A2: route x date x hour metrics."""
    return _route_hour(spark, sf_dir)


@register("fleet_state", with_ctes("pings") + """
SELECT CAST(count(*) AS BIGINT) AS n,
       CAST(round(CAST(avg(CAST(is_moving AS DOUBLE)) * 100 AS DECIMAL(38,6)), 1) AS DOUBLE) AS pct_moving,
       CAST(round(CAST(avg(speed_kmph) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_speed_kmph,
       CAST(round(CAST(avg(CAST(is_bunched AS DOUBLE)) * 100 AS DECIMAL(38,6)), 1) AS DOUBLE) AS pct_bunched
FROM pings WHERE is_speed_valid""")
def q_fleet_state(spark, sf_dir):
    """Fleet summary over valid-speed pings."""
    return metrics.fleet_state(_pings(spark, sf_dir))


@register("slowest_preview", with_ctes("route_hour") + """
SELECT * FROM route_hour WHERE n_moving >= 3
ORDER BY avg_moving_speed_kmph ASC NULLS LAST, route_id, service_date, hour_of_day LIMIT 10""")
def q_slowest_preview(spark, sf_dir):
    """Top-10 slowest route-hours with at least 3 moving pings."""
    return metrics.slowest_preview(_route_hour(spark, sf_dir))


# ---------------------------------------------------------------- warehouse + reports

def _wh(spark, sf_dir):
    from transitlens.plans import warehouse_build
    pings = _pings(spark, sf_dir)
    return warehouse_build.load(spark, pings, metrics.route_hour(pings))


def _r():
    from transitlens.plans import reports
    return reports


@register("dim_date", with_ctes("warehouse") + """
SELECT d.*, CAST(coalesce(f.n, 0) AS BIGINT) AS n_facts
FROM dim_date d LEFT JOIN (SELECT date_key, count(*) AS n FROM fact_rh GROUP BY date_key) f USING (date_key)""")
def q_dim_date(spark, sf_dir):
    """The whole date dimension, with the route-hour facts of each date."""
    wh = _wh(spark, sf_dir)
    facts = wh.fact_route_hour.groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))
    return wh.dim_date.join(facts, "date_key", "left").withColumn("n_facts", F.coalesce("n", F.lit(0))).drop("n")


@register("dim_hour", with_ctes("warehouse") + """
SELECT h.hour_key, h.hour_label, h.day_part, CAST(count(f.route_key) AS BIGINT) AS route_hours
FROM dim_hour h LEFT JOIN fact_rh f USING (hour_key) GROUP BY h.hour_key, h.hour_label, h.day_part""")
def q_dim_hour(spark, sf_dir):
    """Hour dimension with the number of route-hour facts per hour."""
    wh = _wh(spark, sf_dir)
    n = wh.fact_route_hour.groupBy("hour_key").agg(F.count(F.lit(1)).alias("route_hours"))
    return (wh.dim_hour.join(n, "hour_key", "left")
              .select("hour_key", "hour_label", "day_part", F.coalesce("route_hours", F.lit(0)).alias("route_hours")))


@register("dim_route", with_ctes("warehouse") + "SELECT route_key, route_id FROM dim_route")
def q_dim_route(spark, sf_dir):
    """Route dimension with distributed surrogate keys."""
    return _wh(spark, sf_dir).dim_route.select("route_key", "route_id")


@register("dim_vehicle", with_ctes("warehouse") + "SELECT vehicle_key, vehicle_id FROM dim_vehicle")
def q_dim_vehicle(spark, sf_dir):
    """Vehicle dimension."""
    return _wh(spark, sf_dir).dim_vehicle.select("vehicle_key", "vehicle_id")


@register("fact_route_hour", with_ctes("warehouse") + "SELECT * FROM fact_rh")
def q_fact_route_hour(spark, sf_dir):
    """Route-hour fact (loaded_at omitted)."""
    return _wh(spark, sf_dir).fact_route_hour.drop("loaded_at")


@register("fact_ping", with_ctes("warehouse") + "SELECT * FROM fact_ping")
def q_fact_ping(spark, sf_dir):
    """Ping fact with NUMERIC scales (obs_ts shown as epoch seconds)."""
    f = _wh(spark, sf_dir).fact_ping
    return f.withColumn("obs_epoch", F.unix_seconds("obs_ts")).drop("obs_ts").select(
        "obs_epoch", *[c for c in f.columns if c != "obs_ts"])


@register("report_slowest", with_ctes("warehouse") + """
SELECT route_id, full_date, hour_label, n_moving, CAST(avg_moving_speed_kmph AS DOUBLE) AS avg_moving_speed_kmph, n_bunched
FROM rh_view WHERE n_moving >= 3
ORDER BY avg_moving_speed_kmph ASC NULLS LAST, route_id, full_date, hour_key LIMIT 10""")
def q_report_slowest(spark, sf_dir):
    """Top 10 slowest route-hours."""
    return _r().slowest_route_hours(_wh(spark, sf_dir))


@register("report_hour_rank", with_ctes("warehouse") + """
SELECT hour_label, route_id, CAST(avg_moving_speed_kmph AS DOUBLE) AS avg_moving_speed_kmph,
       CAST(slow_rank_in_hour AS INTEGER) AS slow_rank_in_hour
FROM (SELECT *, rank() OVER (PARTITION BY hour_key ORDER BY avg_moving_speed_kmph ASC NULLS LAST) AS slow_rank_in_hour
      FROM rh_view WHERE n_moving >= 3) t
WHERE slow_rank_in_hour = 1""")
def q_report_hour_rank(spark, sf_dir):
    """Slowest route(s) in each hour (ties kept)."""
    return _r().slowest_in_each_hour(_wh(spark, sf_dir))


@register("report_day_part", with_ctes("warehouse") + """
SELECT h.day_part, CAST(count(*) AS BIGINT) AS route_hour_rows,
       CAST(round(CAST(avg(CAST(f.avg_moving_speed_kmph AS DOUBLE)) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_speed_kmph,
       CAST(sum(f.n_bunched) AS BIGINT) AS total_bunched_pings
FROM fact_rh f JOIN dim_hour h USING (hour_key) GROUP BY h.day_part""")
def q_report_day_part(spark, sf_dir):
    """Congestion by day part."""
    return _r().by_day_part(_wh(spark, sf_dir))


BUNCHING_SQL = """
SELECT route_id, total_moving_pings, total_bunched_pings,
       CAST(round(CAST(CAST(total_bunched_pings AS DOUBLE) * 100.0 / CAST(nullif(total_moving_pings, 0) AS DOUBLE)
                  AS DECIMAL(38,6)), 1) AS DOUBLE) AS bunching_pct
FROM (SELECT r.route_id, CAST(sum(f.n_moving) AS BIGINT) AS total_moving_pings,
             CAST(sum(f.n_bunched) AS BIGINT) AS total_bunched_pings
      FROM fact_rh f JOIN dim_route r USING (route_key) GROUP BY r.route_id HAVING sum(f.n_moving) >= 10) t
ORDER BY bunching_pct DESC NULLS FIRST, route_id LIMIT {k}"""


@register("report_bunching", with_ctes("warehouse") + BUNCHING_SQL.format(k=10))
def q_report_bunching(spark, sf_dir):
    """Top-10 bunching rate per route."""
    return _r().bunching_rate(_wh(spark, sf_dir))


@register("report_day_over_day", with_ctes("warehouse") + """
SELECT route_id, full_date, avg_speed_kmph, prev_day_speed,
       CAST(round(CAST(avg_speed_kmph - prev_day_speed AS DECIMAL(38,6)), 2) AS DOUBLE) AS change_vs_prev_day
FROM (SELECT *, lag(avg_speed_kmph) OVER (PARTITION BY route_id ORDER BY full_date) AS prev_day_speed
      FROM (SELECT route_id, full_date,
                   CAST(round(CAST(avg(CAST(avg_moving_speed_kmph AS DOUBLE)) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_speed_kmph
            FROM rh_view WHERE n_moving >= 3 GROUP BY route_id, full_date) d) t""")
def q_report_day_over_day(spark, sf_dir):
    """Day-over-day trend per route (whole trend, not a preview)."""
    return _r().day_over_day(_wh(spark, sf_dir))


LOOKUP_SQL = """
SELECT route_id, CAST(full_date AS VARCHAR) AS full_date, hour_label, n_moving,
       CAST(avg_moving_speed_kmph AS DOUBLE) AS avg_moving_speed_kmph, n_bunched
FROM rh_view WHERE route_id = '{route}' AND n_moving >= {floor} {hour}"""


@register("lookup_route_speed", with_ctes("warehouse") + LOOKUP_SQL.format(route="1", floor=3, hour=""))
def q_lookup_route_speed(spark, sf_dir):
    """One route's route-hours (route '1', all hours, floor 3)."""
    return _r().route_speed(_wh(spark, sf_dir), "1")


@register("lookup_route_hour", with_ctes("warehouse") + LOOKUP_SQL.format(route="4", floor=5, hour="AND hour_key = 18"))
def q_lookup_route_hour(spark, sf_dir):
    """One route at one hour with a custom floor (route '4', 18:00, floor 5)."""
    return _r().route_speed(_wh(spark, sf_dir), "4", hour=18, min_moving=5)


@register("lookup_slowest", with_ctes("warehouse") + """
SELECT route_id, CAST(full_date AS VARCHAR) AS full_date, hour_label, n_moving,
       CAST(avg_moving_speed_kmph AS DOUBLE) AS avg_moving_speed_kmph, n_bunched
FROM rh_view WHERE n_moving >= 5
ORDER BY avg_moving_speed_kmph ASC NULLS LAST, route_id, full_date, hour_key LIMIT 25""")
def q_lookup_slowest(spark, sf_dir):
    """Slowest route-hours with parameters (floor 5, limit 25)."""
    return _r().slowest_route_hours(_wh(spark, sf_dir), min_moving=5, limit=25, date_as_text=True)


@register("tile_top15", with_ctes("warehouse") + """
SELECT route_id, CAST(round(CAST(avg(CAST(avg_moving_speed_kmph AS DOUBLE)) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_moving_speed_kmph,
       CAST(count(*) AS BIGINT) AS route_hours
FROM rh_view WHERE n_moving >= 3 GROUP BY route_id
ORDER BY avg_moving_speed_kmph ASC NULLS LAST, route_id LIMIT 15""")
def q_tile_top15(spark, sf_dir):
    """Top 15 slowest routes."""
    return _r().slowest_routes_tile(_wh(spark, sf_dir))


@register("tile_midday_evening", with_ctes("warehouse") + """
SELECT h.day_part, CAST(count(*) AS BIGINT) AS route_hour_rows,
       CAST(round(CAST(avg(CAST(f.avg_moving_speed_kmph AS DOUBLE)) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_speed_kmph,
       CAST(sum(f.n_bunched) AS BIGINT) AS total_bunched_pings
FROM fact_rh f JOIN dim_hour h USING (hour_key) WHERE h.day_part IN ('Midday', 'Evening peak') GROUP BY h.day_part""")
def q_tile_midday_evening(spark, sf_dir):
    """Midday vs evening-peak speed."""
    return _r().midday_vs_evening(_wh(spark, sf_dir))


@register("tile_kpi", with_ctes("warehouse") + """
SELECT (SELECT CAST(sum(n_pings) AS BIGINT) FROM fact_rh) AS total_pings,
       (SELECT CAST(count(DISTINCT route_key) AS BIGINT) FROM fact_rh) AS distinct_routes,
       (SELECT CAST(round(CAST(avg(CAST(speed_kmph AS DOUBLE)) AS DECIMAL(38,6)), 2) AS DOUBLE)
        FROM fact_ping WHERE is_moving) AS avg_moving_speed_kmph""")
def q_tile_kpi(spark, sf_dir):
    """KPI cards."""
    return _r().kpi_cards(_wh(spark, sf_dir))


@register("bar_scale", with_ctes("warehouse") + """
SELECT *, CASE WHEN max(coalesce(avg_moving_speed_kmph, 0.0)) OVER () > 0
               THEN CAST(round(CAST(greatest(6.0, coalesce(avg_moving_speed_kmph, 0.0)
                    / max(coalesce(avg_moving_speed_kmph, 0.0)) OVER () * 100.0) AS DECIMAL(38,6)), 2) AS DOUBLE)
               ELSE 0.0 END AS bar_pct
FROM (SELECT route_id, CAST(full_date AS VARCHAR) AS full_date, hour_label, n_moving,
             CAST(avg_moving_speed_kmph AS DOUBLE) AS avg_moving_speed_kmph, n_bunched
      FROM rh_view WHERE n_moving >= 3
      ORDER BY avg_moving_speed_kmph ASC NULLS LAST, route_id, full_date, hour_key LIMIT 10) t""")
def q_bar_scale(spark, sf_dir):
    """Relative bar widths of the slowest list."""
    r = _r()
    return r.bar_scale(r.slowest_route_hours(_wh(spark, sf_dir), date_as_text=True))


@register("insight_prompt", with_ctes("warehouse") + """
, slow AS (
  SELECT route_id, full_date, hour_label, n_moving, avg_moving_speed_kmph,
         row_number() OVER (ORDER BY avg_moving_speed_kmph ASC NULLS LAST, route_id, full_date, hour_key) AS r
  FROM rh_view WHERE n_moving >= 3 ORDER BY r LIMIT 10
), bunch AS (
  SELECT *, row_number() OVER (ORDER BY bunching_pct DESC NULLS FIRST, route_id) AS r FROM (""" + BUNCHING_SQL.format(k=5) + """) b
), lines AS (
  SELECT 0 AS sec, 0 AS r, 'Slowest bus routes (route_id, date, hour, moving buses, avg speed km/h):' AS line
  UNION ALL SELECT 1, r, printf('- Route %s on %s at %s: %s buses, %s km/h', route_id, CAST(full_date AS VARCHAR),
                                hour_label, CAST(n_moving AS VARCHAR), CAST(avg_moving_speed_kmph AS VARCHAR)) FROM slow
  UNION ALL SELECT 2, 0, chr(10) || 'Routes with the highest bus-bunching rate (same route, buses within 300m):'
  UNION ALL SELECT 3, r, printf('- Route %s: %s%% bunched (%s of %s moving pings)', route_id,
                                CAST(CAST(bunching_pct AS DECIMAL(10,1)) AS VARCHAR), CAST(total_bunched_pings AS VARCHAR),
                                CAST(total_moving_pings AS VARCHAR)) FROM bunch
  UNION ALL SELECT 4, 0, chr(10) || 'Write a short summary (4-6 sentences, plain English, no jargon) for a transit planner. '
         || 'Call out the worst congestion pattern and the worst bunching pattern. Do not invent numbers not shown above. '
         || 'Do not give traffic-management advice beyond one short suggestion.'
)
SELECT string_agg(line, chr(10) ORDER BY sec, r) AS prompt FROM lines""")
def q_insight_prompt(spark, sf_dir):
    """The insight prompt text."""
    return _r().insight_prompt(_wh(spark, sf_dir))


# ---------------------------------------------------------------- quality

def _q():
    from transitlens.operators import quality
    return quality


def _oracle_quality(dataset, relation, checks, pre=""):
    from transitlens.plans.oracle import quality_sql
    return pre + quality_sql(dataset, relation, checks)


def _pings_ts(spark, sf_dir):
    return _pings(spark, sf_dir)


_QP = _q().pings_suite()
_QR = _q().route_hour_suite()
_PINGS_TS_CTE = ", pings_ts AS (SELECT * EXCLUDE (obs_epoch), make_timestamp(obs_epoch * 1000000) AS obs_ts FROM pings)\n"


@register("quality_pings", _oracle_quality("vehicle_pings_clean", "pings_ts", _QP, with_ctes("pings") + _PINGS_TS_CTE))
def q_quality_pings(spark, sf_dir):
    """Q1 Q2 Q4-Q8 Q13: the 12 ping checks (Q6 fails on this data by design)."""
    return _q().run_suite(_pings(spark, sf_dir), "vehicle_pings_clean", _QP)


@register("quality_pings_valid", _oracle_quality("vehicle_pings_clean", "pings_ts", _QP,
                                                 with_ctes("pings") + ", pings_ts AS (SELECT * EXCLUDE (obs_epoch), "
                                                 "make_timestamp(obs_epoch * 1000000) AS obs_ts FROM pings WHERE is_speed_valid)\n"))
def q_quality_pings_valid(spark, sf_dir):
    """Q1-Q8: the ping checks on valid-speed pings (all pass)."""
    return _q().run_suite(_pings(spark, sf_dir).filter("is_speed_valid"), "vehicle_pings_clean", _QP)


@register("quality_route_hour", _oracle_quality("route_hour_speed", "route_hour", _QR, with_ctes("route_hour")))
def q_quality_route_hour(spark, sf_dir):
    """Q1 Q3 Q5 Q9-Q12 Q13: the 14 route-hour checks."""
    return _q().run_suite(_route_hour(spark, sf_dir), "route_hour_speed", _QR)


@register("quality_gate", with_ctes("route_hour") + _PINGS_TS_CTE + """
, results AS (""" + _oracle_quality("vehicle_pings_clean", "pings_ts", _QP) + "\nUNION ALL\n"
          + _oracle_quality("route_hour_speed", "route_hour", _QR) + """)
SELECT dataset, bool_and(success) AS passed, CAST(count(*) AS BIGINT) AS n_checks,
       CAST(count(*) FILTER (WHERE NOT success) AS BIGINT) AS n_failed
FROM results GROUP BY dataset""")
def q_quality_gate(spark, sf_dir):
    """Q13 Q14: pass/fail per dataset (the gate raises when any is false)."""
    q = _q()
    pings = _pings(spark, sf_dir)
    res = q.run_suite(pings, "vehicle_pings_clean", _QP).unionByName(
        q.run_suite(metrics.route_hour(pings), "route_hour_speed", _QR))
    return q.suite_passed(res)


# Faults by the second of the report, and by the hour of a route-hour row: (column, every nth, SQL and Spark value).
_PING_FAULTS = [("vehicle_id", 101, "NULL"), ("route_id", 103, "NULL"), ("lat", 107, "lat + 10"), ("lon", 109, "lon - 50"),
                ("hour_of_day", 113, "24"), ("day_of_week", 127, "0"), ("speed_kmph", 2, "-5.0")]
_HOUR_FAULTS = [("day_of_week", 7, "8"), ("n_pings", 5, "0"), ("n_vehicles", 11, "n_pings + 3"), ("n_speed_obs", 6, "n_pings + 1"),
                ("n_moving", 8, "n_speed_obs + 2"), ("avg_speed_kmph", 9, "99.5"), ("avg_moving_speed_kmph", 10, "1.5"), ("route_id", 13, "NULL")]


def _faulty(columns: list[str], faults, no: str) -> list[str]:
    of = {c: f"CASE WHEN {no} % {n} = 0 THEN {v} ELSE {c} END AS {c}" for c, n, v in faults}
    return [of.get(c, c) for c in columns]


def _keys_sql(dataset: str, relation: str, checks, key: list[str], shown: dict[str, str] | None = None) -> str:
    """Results of a suite with the five smallest offending keys; ``shown``: columns named by another one in keys."""
    parts = []
    for i, c in enumerate(checks):
        text = lambda cols: "concat_ws('|', " + ", ".join(f"CAST({x} AS VARCHAR)" for x in cols) + ")"
        if c.check_type == "row_count_between":
            continue
        if c.check_type == "compound_unique":
            cols = [(shown or {}).get(x, x) for x in c.columns]
            parts.append(f"SELECT {i} AS check_no, {text(cols)} AS key FROM {relation} WHERE "
                         f"{' OR '.join(f'{x} IS NOT NULL' for x in cols)} GROUP BY {', '.join(cols)} HAVING count(*) > 1")
            continue
        bad = {"not_null": f"{c.column} IS NULL", "in_set": f"{c.column} NOT IN (true, false)",
               "between": f"({c.column} < {c.min_value if c.min_value is not None else 'NULL'} OR {c.column} > {c.max_value if c.max_value is not None else 'NULL'})",
               "pair_a_ge_b": f"{c.column} < {c.column_b}"}[c.check_type]
        parts.append(f"SELECT {i} AS check_no, {text(key)} AS key FROM {relation} WHERE {bad}")
    keys = (f"SELECT check_no, string_agg(key, ',' ORDER BY key) AS keys FROM (SELECT * FROM (SELECT DISTINCT * FROM ({' UNION ALL '.join(parts)}) u) d "
            "QUALIFY row_number() OVER (PARTITION BY check_no ORDER BY key) <= 5) f GROUP BY check_no")
    return f"SELECT r.*, k.keys FROM ({_oracle_quality(dataset, relation, checks)}) r LEFT JOIN ({keys}) k USING (check_no)"


_PING_COLUMNS = ["vehicle_id", "route_id", "obs_epoch", "lat", "lon", "hour_of_day", "day_of_week", "speed_kmph", "is_moving", "is_bunched"]
_HOUR_COLUMNS = ["route_id", "service_date", "hour_of_day", "day_of_week", "n_pings", "n_vehicles", "n_speed_obs", "n_moving",
                 "avg_speed_kmph", "avg_moving_speed_kmph"]


@register("quality_failures_injected", with_ctes("route_hour") + f"""
, bad_pings AS (SELECT * EXCLUDE (obs_epoch), make_timestamp(obs_epoch * 1000000) AS obs_ts, obs_epoch AS no FROM (
  SELECT {', '.join(_faulty(_PING_COLUMNS, _PING_FAULTS, 'obs_epoch'))} FROM pings
  UNION ALL SELECT {', '.join(_PING_COLUMNS)} FROM pings WHERE obs_epoch % 131 = 0) x),
bad_hours AS (
  SELECT {', '.join(_faulty(_HOUR_COLUMNS, _HOUR_FAULTS, 'hour_of_day'))} FROM route_hour
  UNION ALL SELECT {', '.join(_HOUR_COLUMNS)} FROM route_hour WHERE hour_of_day = 3)
""" + _keys_sql("vehicle_pings_clean", "bad_pings", _QP, ["vehicle_id", "no"], {"obs_ts": "no"}) + "\nUNION ALL\n"
          + _keys_sql("route_hour_speed", "bad_hours", _QR, ["route_id", "service_date", "hour_of_day"]))
def q_quality_failures_injected(spark, sf_dir):
    """Q1-Q13: all 26 checks over rows with planted faults: counts, verdicts and the five smallest offending keys of each."""
    q = _q()
    pings = _pings(spark, sf_dir)
    rows = pings.withColumn("obs_epoch", F.unix_seconds("obs_ts")) if "obs_epoch" not in pings.columns else pings
    one = rows.select(*_PING_COLUMNS)
    bad = (one.selectExpr(*_faulty(_PING_COLUMNS, _PING_FAULTS, "obs_epoch")).unionByName(one.filter("obs_epoch % 131 = 0"))
           .withColumn("obs_ts", F.timestamp_seconds("obs_epoch")))
    hours = metrics.route_hour(pings).select(*_HOUR_COLUMNS)
    worse = hours.selectExpr(*_faulty(_HOUR_COLUMNS, _HOUR_FAULTS, "hour_of_day")).unionByName(hours.filter("hour_of_day = 3"))
    from transitlens.session import materialize
    bad, worse = materialize(bad, "faulty-pings"), materialize(worse, "faulty-hours")
    in_seconds = [q.unique("vehicle_id", "obs_epoch") if c.check_type == "compound_unique" else c for c in _QP]
    keys = q.failing_keys(bad, in_seconds, ["vehicle_id", "obs_epoch"])
    return (q.run_suite(bad, "vehicle_pings_clean", _QP).join(F.broadcast(keys), "check_no", "left")
            .unionByName(q.run_suite_with_keys(worse, "route_hour_speed", _QR, ["route_id", "service_date", "hour_of_day"])))


# ---------------------------------------------------------------- upserts (two-batch fixture)

def _batches(spark, sf_dir):
    """Batch 1 = pings of even event ids, batch 2 = all pings (speeds recomputed)."""
    from transitlens.sources import fixtures
    ev = Tables(spark, sf_dir)("events")
    p1 = flow.pings_from_raw(fixtures.raw_feed(ev.filter(F.col("event_id") % 2 == 0)))
    p2 = flow.pings_from_raw(fixtures.raw_feed(ev))
    return p1, p2


def _two_batch_dims(spark, p1, p2, rh1, rh2):
    from transitlens.operators import warehouse as W
    dr = W.upsert_dim(W.empty_dim_route(spark), p1.select("route_id").unionByName(rh1.select("route_id")),
                      "route_id", "route_key")
    dr = W.upsert_dim(dr, p2.select("route_id").unionByName(rh2.select("route_id")), "route_id", "route_key")
    dv = W.upsert_dim(W.empty_dim_vehicle(spark), p1.select("vehicle_id"), "vehicle_id", "vehicle_key")
    dv = W.upsert_dim(dv, p2.select("vehicle_id"), "vehicle_id", "vehicle_key")
    return dr, dv


_TWO_BATCH_CTES = (with_ctes("warehouse") + "," + __import__("transitlens.plans.oracle", fromlist=["x"]).batch_ctes(
    "_b1", "event_id % 2 = 0") + """,
dr1 AS (SELECT CAST(row_number() OVER (ORDER BY route_id) AS INTEGER) AS route_key, route_id
        FROM (SELECT DISTINCT route_id FROM (SELECT route_id FROM pings_b1 UNION ALL SELECT route_id FROM route_hour_b1) u
              WHERE route_id IS NOT NULL) d),
dr2 AS (SELECT * FROM dr1 UNION ALL
        SELECT CAST((SELECT coalesce(max(route_key), 0) FROM dr1) + row_number() OVER (ORDER BY route_id) AS INTEGER), route_id
        FROM (SELECT DISTINCT route_id FROM (SELECT route_id FROM pings UNION ALL SELECT route_id FROM route_hour) u
              WHERE route_id IS NOT NULL AND route_id NOT IN (SELECT route_id FROM dr1)) d),
dv1 AS (SELECT CAST(row_number() OVER (ORDER BY vehicle_id) AS INTEGER) AS vehicle_key, vehicle_id
        FROM (SELECT DISTINCT vehicle_id FROM pings_b1 WHERE vehicle_id IS NOT NULL) d),
dv2 AS (SELECT * FROM dv1 UNION ALL
        SELECT CAST((SELECT coalesce(max(vehicle_key), 0) FROM dv1) + row_number() OVER (ORDER BY vehicle_id) AS INTEGER), vehicle_id
        FROM (SELECT DISTINCT vehicle_id FROM pings WHERE vehicle_id IS NOT NULL
              AND vehicle_id NOT IN (SELECT vehicle_id FROM dv1)) d),
""")


def _fact_rh_sql(rh, dr):
    return f"""SELECT CAST(year(service_date) * 10000 + month(service_date) * 100 + day(service_date) AS INTEGER) AS date_key,
         CAST(hour_of_day AS SMALLINT) AS hour_key, r.route_key,
         CAST(n_pings AS INTEGER) AS n_pings, CAST(n_vehicles AS INTEGER) AS n_vehicles,
         CAST(n_speed_obs AS INTEGER) AS n_speed_obs, CAST(n_moving AS INTEGER) AS n_moving,
         CAST(avg_speed_kmph AS DECIMAL(7,2)) AS avg_speed_kmph,
         CAST(avg_moving_speed_kmph AS DECIMAL(7,2)) AS avg_moving_speed_kmph, CAST(n_bunched AS INTEGER) AS n_bunched
  FROM {rh} JOIN {dr} r USING (route_id)"""


def _fact_ping_sql(p, dr, dv):
    return f"""SELECT p.obs_epoch,
         CAST(year(service_date) * 10000 + month(service_date) * 100 + day(service_date) AS INTEGER) AS date_key,
         CAST(hour_of_day AS SMALLINT) AS hour_key, r.route_key, v.vehicle_key, trip_id,
         CAST(dispatch_hour AS SMALLINT) AS dispatch_hour, CAST(dispatch_minute AS SMALLINT) AS dispatch_minute,
         CAST(lat AS DECIMAL(9,6)) AS lat, CAST(lon AS DECIMAL(9,6)) AS lon, CAST(gap_s AS INTEGER) AS gap_s,
         CAST(CAST(dist_m AS DECIMAL(38,6)) AS DECIMAL(10,1)) AS dist_m, CAST(speed_kmph AS DECIMAL(8,2)) AS speed_kmph,
         is_speed_valid, is_moving, is_bunched
  FROM {p} p JOIN {dr} r USING (route_id) JOIN {dv} v USING (vehicle_id)"""


@register("upsert_dim_two_batches", _TWO_BATCH_CTES.rstrip().rstrip(",") + """
SELECT 'route' AS dim, route_key AS dim_key, route_id AS natural_id FROM dr2
UNION ALL SELECT 'vehicle', vehicle_key, vehicle_id FROM dv2""")
def q_upsert_dim_two_batches(spark, sf_dir):
    """Dimension insert-if-absent over two batches (keys stay stable)."""
    p1, p2 = _batches(spark, sf_dir)
    dr, dv = _two_batch_dims(spark, p1, p2, metrics.route_hour(p1), metrics.route_hour(p2))
    return (dr.select(F.lit("route").alias("dim"), F.col("route_key").alias("dim_key"), F.col("route_id").alias("natural_id"))
              .unionByName(dv.select(F.lit("vehicle").alias("dim"), F.col("vehicle_key").alias("dim_key"),
                                     F.col("vehicle_id").alias("natural_id"))))


@register("upsert_route_hour_two_batches", _TWO_BATCH_CTES + f"""
t AS ({_fact_rh_sql("route_hour_b1", "dr2")}),
s AS ({_fact_rh_sql("route_hour", "dr2")})
SELECT coalesce(s.date_key, t.date_key) AS date_key, coalesce(s.hour_key, t.hour_key) AS hour_key,
       coalesce(s.route_key, t.route_key) AS route_key,
       CASE WHEN s.route_key IS NOT NULL THEN s.n_pings ELSE t.n_pings END AS n_pings,
       CASE WHEN s.route_key IS NOT NULL THEN s.n_vehicles ELSE t.n_vehicles END AS n_vehicles,
       CASE WHEN s.route_key IS NOT NULL THEN s.n_speed_obs ELSE t.n_speed_obs END AS n_speed_obs,
       CASE WHEN s.route_key IS NOT NULL THEN s.n_moving ELSE t.n_moving END AS n_moving,
       CASE WHEN s.route_key IS NOT NULL THEN s.avg_speed_kmph ELSE t.avg_speed_kmph END AS avg_speed_kmph,
       CASE WHEN s.route_key IS NOT NULL THEN s.avg_moving_speed_kmph ELSE t.avg_moving_speed_kmph END AS avg_moving_speed_kmph,
       CASE WHEN s.route_key IS NOT NULL THEN s.n_bunched ELSE t.n_bunched END AS n_bunched
FROM t FULL OUTER JOIN s ON t.date_key = s.date_key AND t.hour_key = s.hour_key AND t.route_key = s.route_key""")
def q_upsert_route_hour_two_batches(spark, sf_dir):
    """K4 T4: route-hour fact after loading batch 1 then upserting batch 2 (all measures)."""
    from transitlens.operators import warehouse as W
    p1, p2 = _batches(spark, sf_dir)
    rh1, rh2 = metrics.route_hour(p1), metrics.route_hour(p2)
    dr, _ = _two_batch_dims(spark, p1, p2, rh1, rh2)
    f1, _ = W.fact_route_hour(rh1, dr)
    f2, _ = W.fact_route_hour(rh2, dr)
    merged = W.merge(f1, f2, ["date_key", "hour_key", "route_key"], touch={"loaded_at": F.current_timestamp()})
    return merged.drop("loaded_at")


_PING_KEEP = ["date_key", "hour_key", "route_key", "dispatch_hour", "dispatch_minute", "lat", "lon"]
_PING_UPD = ["trip_id", "gap_s", "dist_m", "speed_kmph", "is_speed_valid", "is_moving", "is_bunched"]


@register("upsert_ping_two_batches", _TWO_BATCH_CTES + f"""
t AS ({_fact_ping_sql("pings_b1", "dr2", "dv2")}),
s AS ({_fact_ping_sql("pings", "dr2", "dv2")})
SELECT coalesce(t.obs_epoch, s.obs_epoch) AS obs_epoch, coalesce(t.vehicle_key, s.vehicle_key) AS vehicle_key,
""" + ",\n".join(f"       CASE WHEN t.vehicle_key IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in _PING_KEEP) + ",\n"
    + ",\n".join(f"       CASE WHEN s.vehicle_key IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _PING_UPD) + """
FROM t FULL OUTER JOIN s ON t.vehicle_key = s.vehicle_key AND t.obs_epoch = s.obs_epoch""")
def q_upsert_ping_two_batches(spark, sf_dir):
    """K5 T5: ping fact after batch 1 then a partial-column upsert of batch 2
    (lat, lon, keys and dispatch time keep first-load values)."""
    from transitlens.operators import warehouse as W
    p1, p2 = _batches(spark, sf_dir)
    dr, dv = _two_batch_dims(spark, p1, p2, metrics.route_hour(p1), metrics.route_hour(p2))
    f1, _ = W.fact_ping(p1, dr, dv)
    f2, _ = W.fact_ping(p2, dr, dv)
    merged = W.merge(f1, f2, ["vehicle_key", "obs_ts"], update_cols=_PING_UPD)
    return merged.select(F.unix_seconds("obs_ts").alias("obs_epoch"), "vehicle_key", *_PING_KEEP, *_PING_UPD)


# ---------------------------------------------------------------- gated load into the stored warehouse

def _published_pings(spark, root):
    """Ping facts of the published version with natural ids."""
    from transitlens.plans import published
    wh = published.open_warehouse(spark, root)
    return (wh.fact_ping.join(wh.dim_route.select("route_key", "route_id"), "route_key")
              .join(wh.dim_vehicle.select("vehicle_key", "vehicle_id"), "vehicle_key")
              .select("vehicle_id", F.unix_seconds("obs_ts").alias("obs_epoch"), "date_key", "hour_key", "route_id",
                      "trip_id", "dispatch_minute", "speed_kmph", "is_moving"))


def _warehouse_root(spark):
    import uuid
    from transitlens.session import scratch_path
    return scratch_path(spark, f"warehouse-{uuid.uuid4().hex}")


_PUBLISHED_SQL = """SELECT vehicle_id, obs_epoch,
       CAST(year(service_date) * 10000 + month(service_date) * 100 + day(service_date) AS INTEGER) AS date_key,
       CAST(hour_of_day AS SMALLINT) AS hour_key, route_id, {trip} AS trip_id,
       CAST({minute} AS SMALLINT) AS dispatch_minute, CAST(speed_kmph AS DECIMAL(8,2)) AS speed_kmph, is_moving{more}
FROM pings WHERE is_speed_valid AND vehicle_id IS NOT NULL AND route_id IS NOT NULL
  AND CAST(year(service_date) * 10000 + month(service_date) * 100 + day(service_date) AS INTEGER) IN (SELECT date_key FROM dim_date)"""


@register("load_blocked", with_ctes("warehouse") + _PUBLISHED_SQL.format(
    trip="trip_id", minute="dispatch_minute", more=", CAST(1 AS INTEGER) AS version, true AS second_load_blocked"))
def q_load_blocked(spark, sf_dir):
    """Valid pings are published; a batch with hours outside the day
    is stopped by the gate, and the first version stays readable."""
    from transitlens.plans import published
    root, pings = _warehouse_root(spark), _pings(spark, sf_dir).filter("is_speed_valid")
    published.gated_load(spark, root, pings)
    try:
        published.gated_load(spark, root, pings.withColumn("hour_of_day", F.lit(24)))
        blocked = False
    except _q().QualityGateError:
        blocked = True
    version = published.current(spark, root)["version"]
    return _published_pings(spark, root).withColumns({"version": F.lit(version), "second_load_blocked": F.lit(blocked)})


@register("load_two_versions", with_ctes("warehouse") + _PUBLISHED_SQL.format(
    trip="CASE WHEN obs_epoch % 3 <> 1 THEN 'r' || trip_id ELSE trip_id END",
    minute="CASE WHEN obs_epoch % 3 = 0 THEN 59 ELSE dispatch_minute END", more=""))
def q_load_two_versions(spark, sf_dir):
    """Two loads whose batches share a third of the pings: kept,
    updated (trip, not dispatch time) and inserted rows, read from the second version."""
    from transitlens.plans import published
    root, pings = _warehouse_root(spark), _pings(spark, sf_dir).filter("is_speed_valid")
    published.gated_load(spark, root, pings.filter("obs_epoch % 3 <> 0"))
    published.gated_load(spark, root, pings.filter("obs_epoch % 3 <> 1").withColumns({
        "trip_id": F.concat(F.lit("r"), "trip_id"), "dispatch_minute": F.lit(59)}))
    return _published_pings(spark, root)


# ---------------------------------------------------------------- reports and lookups over the stored warehouse

_STORED_ROOTS: dict[tuple[str, str], str] = {}


def _stored_root(spark, sf_dir):
    """A published warehouse of the given tables, loaded once per application: all route-hours, and the valid pings
    (the gate stops others)."""
    from transitlens.plans import published
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED_ROOTS or published.current(spark, _STORED_ROOTS[key]) is None:
        root, pings = _warehouse_root(spark), _pings(spark, sf_dir)
        published.gated_load(spark, root, pings.filter("is_speed_valid"), metrics.route_hour(pings))
        _STORED_ROOTS[key] = root
    return _STORED_ROOTS[key]


def _stored(spark, sf_dir):
    from transitlens.plans import published
    return published.open_warehouse(spark, _stored_root(spark, sf_dir))


def _stored_features(wh):
    from transitlens.functions.fmt import dec_round as dr
    from transitlens.operators import model
    return model.prepared(_r().route_hour_view(wh)).select(
        "route_id", "full_date", "hour_key", "day_of_week", "is_peak_hour", "is_weekend", "is_train",
        dr("route_avg_speed", 4).alias("route_avg_speed"), "avg_moving_speed_kmph")


# The answers of the in-memory entries, from the published tables.
_STORED_REPORTS = {
    "report_slowest": lambda wh: _r().slowest_route_hours(wh),
    "report_hour_rank": lambda wh: _r().slowest_in_each_hour(wh),
    "report_day_part": lambda wh: _r().by_day_part(wh),
    "report_bunching": lambda wh: _r().bunching_rate(wh),
    "report_day_over_day": lambda wh: _r().day_over_day(wh),
    "lookup_slowest": lambda wh: _r().slowest_route_hours(wh, min_moving=5, limit=25, date_as_text=True),
    "tile_top15": lambda wh: _r().slowest_routes_tile(wh),
    "tile_midday_evening": lambda wh: _r().midday_vs_evening(wh),
    "tile_kpi": lambda wh: _r().kpi_cards(wh),
    "bar_scale": lambda wh: _r().bar_scale(_r().slowest_route_hours(wh, date_as_text=True)),
    "insight_prompt": lambda wh: _r().insight_prompt(wh),
}


def _register_stored(name, answer, sql):
    @register(f"stored_{name}", sql)
    def query(spark, sf_dir):
        return answer(_stored(spark, sf_dir))


for _name, _answer in _STORED_REPORTS.items():
    _register_stored(_name, _answer, ORACLE[_name])


@register("stored_lookup_route_hour", ORACLE["lookup_route_hour"])
def q_stored_lookup_route_hour(spark, sf_dir):
    """Route '4' at 18:00 from the published tables; other routes and hours are skipped by row group."""
    from transitlens.plans import published
    return _r().route_speed(published.open_route(spark, _stored_root(spark, sf_dir), "4", 18), "4", hour=18, min_moving=5)


@register("stored_lookup_dates", with_ctes("warehouse") + LOOKUP_SQL.format(
    route="1", floor=3, hour="AND date_key BETWEEN (SELECT min(date_key) + 1 FROM fact_rh) AND (SELECT min(date_key) + 2 FROM fact_rh)"))
def q_stored_lookup_dates(spark, sf_dir):
    """Route '1' over the second and third date key; folders of other dates are not listed."""
    from transitlens.plans import published
    root = _stored_root(spark, sf_dir)
    lo = min(int(d) for d in published.current(spark, root)["tables"]["fact_route_hour_speed"]["paths"])
    return _r().route_speed(published.open_route(spark, root, "1", first=lo + 1, last=lo + 2), "1")


@register("incremental_three_batches", with_ctes("pings") + f"SELECT {PING_SQL_COLS}, true AS only_changed_dates_written FROM pings")
def q_incremental_three_batches(spark, sf_dir):
    """Pings of three batches (the first half of the time, the second half, and late reports of the first six
    hours), equal to one run; every date whose rows the third batch changed has a new folder, and not all dates have one."""
    from transitlens.plans import incremental, published
    root, raw = _warehouse_root(spark), _raw(spark, sf_dir)
    epoch = F.col("vehicle_timestamp")
    span = raw.agg(F.min(epoch).alias("lo"), F.floor((F.min(epoch) + F.max(epoch)) / 2).alias("mid"))
    late = (F.col("entity_id").cast("long") % 17 == 3) & (epoch < F.col("lo") + 6 * 3600)
    part = raw.crossJoin(F.broadcast(span)).withColumn("part", F.when(late, 3).when(epoch < F.col("mid"), 1).otherwise(2))
    versions = [incremental.load_batch(spark, root, part.filter(F.col("part") == i).select(*raw.columns)) for i in (1, 2, 3)]
    two, three = versions[1:]
    exact = True
    for table in ("pings", "route_hours"):
        changed = published.dates_of(incremental.changed_dates(spark, root, table, two, three))
        written = incremental.written_dates(two, three, table)
        exact &= set(changed) <= set(written) and 0 < len(written) < len(three["tables"][table]["paths"])
    return ping_output(published.read_table(spark, root, "pings")).withColumn("only_changed_dates_written", F.lit(exact))


@register("incremental_route_hours", with_ctes("route_hour") + "SELECT * FROM route_hour")
def q_incremental_route_hours(spark, sf_dir):
    """Route-hours kept up to date over two batches, the second of which holds a seventh of all reports,
    drawn from every date."""
    from transitlens.plans import incremental, published
    root, raw = _warehouse_root(spark), _raw(spark, sf_dir)
    seventh = F.col("entity_id").cast("long") % 7 == 0
    incremental.load_batch(spark, root, raw.filter(~seventh))
    incremental.load_batch(spark, root, raw.filter(seventh))
    return published.read_table(spark, root, "route_hours").drop("date_key")


# ---------------------------------------------------------------- integrity, audits, reconcile

INTEGRITY_SQL = """
SELECT 'fact_route_hour_speed' AS table_name, 'pk' AS constraint_name,
       CAST(count(*) - count(DISTINCT (date_key, hour_key, route_key)) AS BIGINT) AS violations FROM fact_rh
UNION ALL SELECT 'fact_route_hour_speed', 'fk_date', CAST(count(*) AS BIGINT) FROM fact_rh WHERE date_key NOT IN (SELECT date_key FROM dim_date)
UNION ALL SELECT 'fact_route_hour_speed', 'fk_hour', CAST(count(*) AS BIGINT) FROM fact_rh WHERE hour_key NOT IN (SELECT hour_key FROM dim_hour)
UNION ALL SELECT 'fact_route_hour_speed', 'fk_route', CAST(count(*) AS BIGINT) FROM fact_rh WHERE route_key NOT IN (SELECT route_key FROM dim_route)
UNION ALL SELECT 'fact_route_hour_speed', 'not_null', CAST(count(*) AS BIGINT) FROM fact_rh
          WHERE n_pings IS NULL OR n_vehicles IS NULL OR n_speed_obs IS NULL OR n_moving IS NULL OR n_bunched IS NULL
UNION ALL SELECT 'fact_vehicle_ping', 'unique_vehicle_obs', CAST(count(*) - count(DISTINCT (vehicle_key, obs_epoch)) AS BIGINT) FROM fact_ping
UNION ALL SELECT 'fact_vehicle_ping', 'fk_date', CAST(count(*) AS BIGINT) FROM fact_ping WHERE date_key NOT IN (SELECT date_key FROM dim_date)
UNION ALL SELECT 'fact_vehicle_ping', 'fk_hour', CAST(count(*) AS BIGINT) FROM fact_ping WHERE hour_key NOT IN (SELECT hour_key FROM dim_hour)
UNION ALL SELECT 'fact_vehicle_ping', 'fk_route', CAST(count(*) AS BIGINT) FROM fact_ping WHERE route_key NOT IN (SELECT route_key FROM dim_route)
UNION ALL SELECT 'fact_vehicle_ping', 'fk_vehicle', CAST(count(*) AS BIGINT) FROM fact_ping WHERE vehicle_key NOT IN (SELECT vehicle_key FROM dim_vehicle)
UNION ALL SELECT 'fact_vehicle_ping', 'not_null', CAST(count(*) AS BIGINT) FROM fact_ping
          WHERE lat IS NULL OR lon IS NULL OR is_speed_valid IS NULL OR is_moving IS NULL OR is_bunched IS NULL
UNION ALL SELECT 'dim_hour', 'check_hour_range', CAST(count(*) AS BIGINT) FROM dim_hour WHERE NOT hour_key BETWEEN 0 AND 23
UNION ALL SELECT 'dim_date', 'unique_full_date', CAST(count(*) - count(DISTINCT full_date) AS BIGINT) FROM dim_date
UNION ALL SELECT 'dim_route', 'unique_route_id', CAST(count(*) - count(DISTINCT route_id) AS BIGINT) FROM dim_route
UNION ALL SELECT 'dim_vehicle', 'unique_vehicle_id', CAST(count(*) - count(DISTINCT vehicle_id) AS BIGINT) FROM dim_vehicle
"""


@register("integrity_checks", with_ctes("warehouse") + INTEGRITY_SQL)
def q_integrity_checks(spark, sf_dir):
    """primary/unique keys, foreign keys, not-null and check constraints (violation counts)."""
    from transitlens.operators import integrity
    return integrity.check_warehouse(_wh(spark, sf_dir))


@register("duplicate_audit", with_ctes("warehouse") + """
SELECT (SELECT CAST(count(*) - count(DISTINCT (date_key, hour_key, route_key)) AS BIGINT) FROM fact_rh) AS dup_route_hour,
       (SELECT CAST(count(*) - count(DISTINCT (vehicle_key, obs_epoch)) AS BIGINT) FROM fact_ping) AS dup_ping,
       (SELECT CAST(count(*) - count(DISTINCT route_id) AS BIGINT) FROM dim_route) AS dup_route,
       (SELECT CAST(count(*) - count(DISTINCT vehicle_id) AS BIGINT) FROM dim_vehicle) AS dup_vehicle""")
def q_duplicate_audit(spark, sf_dir):
    """Natural-key duplicate counts of the four loaded tables."""
    from transitlens.operators import integrity
    return integrity.duplicate_audit(_wh(spark, sf_dir))


@register("table_counts", with_ctes("warehouse") + """
SELECT 'dim_date' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM dim_date
UNION ALL SELECT 'dim_hour', CAST(count(*) AS BIGINT) FROM dim_hour
UNION ALL SELECT 'dim_route', CAST(count(*) AS BIGINT) FROM dim_route
UNION ALL SELECT 'dim_vehicle', CAST(count(*) AS BIGINT) FROM dim_vehicle
UNION ALL SELECT 'fact_route_hour_speed', CAST(count(*) AS BIGINT) FROM fact_rh
UNION ALL SELECT 'fact_vehicle_ping', CAST(count(*) AS BIGINT) FROM fact_ping""")
def q_table_counts(spark, sf_dir):
    """Row count per warehouse table."""
    from transitlens.operators import warehouse as W
    return W.table_counts(_wh(spark, sf_dir).tables())


@register("reconcile", _TWO_BATCH_CTES + f"""
a AS (SELECT r.route_id, f.date_key, f.hour_key, f.n_pings, f.n_vehicles, f.n_speed_obs, f.n_moving,
             f.avg_speed_kmph, f.avg_moving_speed_kmph, f.n_bunched FROM fact_rh f JOIN dim_route r USING (route_key)),
b AS (SELECT r.route_id, f.date_key, f.hour_key, f.n_pings, f.n_vehicles, f.n_speed_obs, f.n_moving,
             f.avg_speed_kmph, f.avg_moving_speed_kmph, f.n_bunched FROM ({_fact_rh_sql("route_hour", "dr2")}) f JOIN dr2 r USING (route_key))
SELECT *, 'left_only' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) x
UNION ALL SELECT *, 'right_only' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) y""")
def q_reconcile(spark, sf_dir):
    """D-R1: single-load vs two-batch-upserted route-hour facts, row for row (empty = identical)."""
    from transitlens.operators import warehouse as W
    wh = _wh(spark, sf_dir)
    p1, p2 = _batches(spark, sf_dir)
    rh1, rh2 = metrics.route_hour(p1), metrics.route_hour(p2)
    dr, _ = _two_batch_dims(spark, p1, p2, rh1, rh2)
    f1, _ = W.fact_route_hour(rh1, dr)
    f2, _ = W.fact_route_hour(rh2, dr)
    merged = W.merge(f1, f2, ["date_key", "hour_key", "route_key"])
    cols = ["route_id", "date_key", "hour_key", "n_pings", "n_vehicles", "n_speed_obs", "n_moving",
            "avg_speed_kmph", "avg_moving_speed_kmph", "n_bunched"]
    a = wh.fact_route_hour.join(wh.dim_route.select("route_key", "route_id"), "route_key").select(*cols)
    b = merged.join(dr.select("route_key", "route_id"), "route_key").select(*cols)
    return W.reconcile(a, b)


@register("reconcile_injected", """
WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders),
b AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 101 <> 0 THEN o_custkey END AS o_custkey,
         CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM a WHERE o_orderkey % 97 <> 0
  UNION ALL SELECT * FROM a WHERE o_orderkey % 83 = 0
  UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_totalprice FROM a WHERE o_orderkey % 79 = 0)
SELECT *, 'left_only' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) x
UNION ALL SELECT *, 'right_only' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) y""")
def q_reconcile_injected(spark, sf_dir):
    """D-R1: two copies of a table with deleted, changed, nulled, duplicated and inserted rows, reconciled by digests."""
    from transitlens.operators import warehouse as W
    a = Tables(spark, sf_dir)("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    every = lambda n: F.col("o_orderkey") % n == 0
    b = (a.filter(~every(97)).withColumns({"o_custkey": F.when(~every(101), F.col("o_custkey")),
                                           "o_totalprice": F.when(every(89), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))})
         .unionByName(a.filter(every(83)))
         .unionByName(a.filter(every(79)).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)))
    return W.reconcile_by_digest(a, b, ["o_orderkey"])


# ---------------------------------------------------------------- diagnostics

def _raw(spark, sf_dir):
    from transitlens.sources import fixtures
    return fixtures.raw_feed(Tables(spark, sf_dir)("events"))


def _static(spark, sf_dir):
    from transitlens.sources import feed, fixtures
    T = Tables(spark, sf_dir)
    st, sp, tr, ro = fixtures.static_timetable(T("lineitem"), T("supplier"), T("orders"), T("customer"))
    return tuple(feed.static_frames(stop_times=st, stops=sp, trips=tr, routes=ro).values())


@register("snapshot_profile", with_ctes("raw") + """
SELECT fetched_at AS snapshot_id, CAST(count(*) AS BIGINT) AS records,
       CAST(count(DISTINCT vehicle_id) + max(CASE WHEN vehicle_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_vehicles,
       CAST(count(*) FILTER (WHERE speed IS NOT NULL AND speed <> 0) AS BIGINT) AS speed_nonzero,
       max(speed) AS max_speed,
       CAST(count(DISTINCT speed) + max(CASE WHEN speed IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_speeds
FROM raw GROUP BY fetched_at""")
def q_snapshot_profile(spark, sf_dir):
    """Per-snapshot feed profile."""
    from transitlens.operators import diagnostics
    return diagnostics.snapshot_profile(_raw(spark, sf_dir))


@register("snapshot_diff", with_ctes("raw") + """
, last AS (
  SELECT fetched_at AS snapshot_id, vehicle_id, latitude, longitude FROM (
    SELECT *, row_number() OVER (PARTITION BY fetched_at, vehicle_id
             ORDER BY vehicle_timestamp DESC NULLS LAST, latitude DESC NULLS LAST, longitude DESC NULLS LAST) AS rn
    FROM raw) x WHERE rn = 1
), numbered AS (
  SELECT l.*, s.n FROM last l JOIN (SELECT snapshot_id, dense_rank() OVER (ORDER BY snapshot_id) AS n
                                     FROM (SELECT DISTINCT snapshot_id FROM last) d) s USING (snapshot_id)
)
SELECT c.snapshot_id, p.snapshot_id AS prev_snapshot_id, CAST(count(*) AS BIGINT) AS seen_in_previous,
       CAST(count(*) FILTER (WHERE NOT (c.latitude IS NOT DISTINCT FROM p.latitude
                                        AND c.longitude IS NOT DISTINCT FROM p.longitude)) AS BIGINT) AS position_changed
FROM numbered c JOIN numbered p ON c.n = p.n + 1 AND c.vehicle_id IS NOT DISTINCT FROM p.vehicle_id
GROUP BY c.snapshot_id, p.snapshot_id""")
def q_snapshot_diff(spark, sf_dir):
    """Consecutive-snapshot overlap and moved vehicles."""
    from transitlens.operators import diagnostics
    return diagnostics.snapshot_diff(_raw(spark, sf_dir))


@register("id_overlap", with_static() + """
, ft AS (SELECT DISTINCT trim(trip_id) AS id FROM raw WHERE trip_id IS NOT NULL),
fr AS (SELECT DISTINCT trim(route_id) AS id FROM raw WHERE route_id IS NOT NULL),
st AS (SELECT DISTINCT trim(trip_id) AS id FROM trips WHERE trip_id IS NOT NULL),
sr AS (SELECT DISTINCT trim(route_id) AS id FROM trips WHERE route_id IS NOT NULL)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM ft) AS feed_trip_ids, (SELECT CAST(count(*) AS BIGINT) FROM fr) AS feed_route_ids,
       (SELECT CAST(count(*) AS BIGINT) FROM st) AS static_trip_ids,
       (SELECT CAST(count(*) AS BIGINT) FROM ft WHERE id IN (SELECT id FROM st)) AS trip_id_matches,
       (SELECT CAST(count(*) AS BIGINT) FROM fr WHERE id IN (SELECT id FROM sr)) AS route_id_matches""")
def q_id_overlap(spark, sf_dir):
    """Feed vs timetable id reconciliation counts."""
    from transitlens.operators import diagnostics
    _, _, trips, _ = _static(spark, sf_dir)
    return diagnostics.id_overlap(_raw(spark, sf_dir), trips)


@register("id_samples", with_static() + """
, ft AS (SELECT trim(trip_id) AS id, trim(route_id) AS route FROM raw WHERE trip_id IS NOT NULL),
st AS (SELECT trim(trip_id) AS id, trim(route_id) AS route FROM trips WHERE trip_id IS NOT NULL),
r0 AS (SELECT min(route) AS r0 FROM (SELECT DISTINCT route FROM ft WHERE route IS NOT NULL) a
       WHERE route IN (SELECT route FROM st)),
s AS (
  SELECT 'feed_trips' AS sample, id FROM (SELECT DISTINCT id FROM ft ORDER BY id LIMIT 8) a
  UNION ALL SELECT 'static_trips', id FROM (SELECT DISTINCT id FROM st ORDER BY id LIMIT 8) b
  UNION ALL SELECT 'feed_trips_of_first_common_route', id FROM (SELECT DISTINCT id FROM ft, r0
            WHERE starts_with(id, r0.r0 || '_') ORDER BY id LIMIT 8) c
  UNION ALL SELECT 'static_trips_of_first_common_route', id FROM (SELECT DISTINCT id FROM st, r0
            WHERE route = r0.r0 ORDER BY id LIMIT 8) d
)
SELECT sample, CAST(row_number() OVER (PARTITION BY sample ORDER BY id) AS INTEGER) AS pos, id FROM s""")
def q_id_samples(spark, sf_dir):
    """Sorted id samples on both sides (a sampling report: limit is the feature)."""
    from transitlens.operators import diagnostics
    _, _, trips, _ = _static(spark, sf_dir)
    return diagnostics.id_samples(_raw(spark, sf_dir), trips)


# ---------------------------------------------------------------- schedule delay

def _delays(spark, sf_dir, **kw):
    from transitlens.operators import delays
    from transitlens.sources import feed, fixtures
    st, sp, tr, ro = _static(spark, sf_dir)
    pos = feed.positions_for_delay(fixtures.delay_positions(Tables(spark, sf_dir)("events")))
    return delays.build_delays(pos, st, sp, tr, ro, **kw)


@register("stop_candidates", with_static() + """
SELECT vehicle_id, obs_epoch, stop_id, stop_sequence, sched_arrival_sec,
       CAST(round(CAST(dist_to_stop_m AS DECIMAL(38,6)), 1) AS DOUBLE) AS dist_to_stop_m FROM cand""")
def q_stop_candidates(spark, sf_dir):
    """Every ping x every scheduled stop of its trip."""
    from transitlens.operators import delays
    from transitlens.sources import feed, fixtures
    st, sp, _, _ = _static(spark, sf_dir)
    pos = delays.clean_positions(feed.positions_for_delay(fixtures.delay_positions(Tables(spark, sf_dir)("events"))))
    c = delays.candidates(pos, st, sp)
    return c.select("vehicle_id", "obs_epoch", "stop_id", "stop_sequence", "sched_arrival_sec",
                    F.round(F.col("dist_to_stop_m").cast("decimal(38,6)"), 1).cast("double").alias("dist_to_stop_m"))


DELAY_OUT_SQL = """vehicle_id, trip_id, route_id, route_short_name, route_long_name, stop_id, stop_name, stop_sequence,
       lat, lon, speed, CAST(round(CAST(dist_to_stop_m AS DECIMAL(38,6)), 1) AS DOUBLE) AS dist_to_stop_m,
       obs_epoch, service_date, hour_of_day, day_of_week, delay_sec, delay_min, is_near_stop, is_outlier"""


@register("schedule_delay", with_static() + f"SELECT {DELAY_OUT_SQL} FROM delays")
def q_schedule_delay(spark, sf_dir):
    """The vehicle_delays table (obs_ts as epoch seconds)."""
    d = _delays(spark, sf_dir)
    return d.drop("obs_ts").withColumn(
        "dist_to_stop_m", F.round(F.col("dist_to_stop_m").cast("decimal(38,6)"), 1).cast("double")).select(
        "vehicle_id", "trip_id", "route_id", "route_short_name", "route_long_name", "stop_id", "stop_name",
        "stop_sequence", "lat", "lon", "speed", "dist_to_stop_m", "obs_epoch", "service_date", "hour_of_day",
        "day_of_week", "delay_sec", "delay_min", "is_near_stop", "is_outlier")


_NEAREST_SQL = """
WITH stop_times AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE CAST(l_orderkey AS VARCHAR) END AS trip_id,
         CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS stop_id, CAST(l_linenumber AS INTEGER) AS stop_sequence,
         CASE WHEN (l_orderkey * 10 + l_linenumber) % 77 <> 0 THEN CAST((l_partkey * 37) % 108000 AS BIGINT) END AS sched_arrival_sec,
         CASE WHEN (l_orderkey * 10 + l_linenumber) % 50 <> 0
              THEN 28.5::DOUBLE + CAST(((l_orderkey * 10 + l_linenumber) * 7919) % 20011 AS DOUBLE) / 100000.0::DOUBLE END AS stop_lat,
         77.0::DOUBLE + CAST(((l_orderkey * 10 + l_linenumber) * 104729) % 20021 AS DOUBLE) / 100000.0::DOUBLE AS stop_lon
  FROM lineitem),
pos AS (
  SELECT CAST(event_id AS VARCHAR) AS vehicle_id, CAST(event_id AS BIGINT) AS obs_epoch,
         CASE WHEN event_id % 3 = 0 THEN 'HOT' ELSE CAST(user_id AS VARCHAR) END AS trip_id,
         28.5::DOUBLE + CAST((event_id * 37) % 20000 AS DOUBLE) / 100000.0::DOUBLE AS lat,
         77.0::DOUBLE + CAST((event_id * 7877) % 20000 AS DOUBLE) / 100000.0::DOUBLE AS lon
  FROM events),
cand AS (
  SELECT p.*, s.stop_id, s.stop_sequence, s.sched_arrival_sec, 12742000.0::DOUBLE * asin(sqrt(
           sin(radians(s.stop_lat - p.lat) / 2) * sin(radians(s.stop_lat - p.lat) / 2)
           + cos(radians(p.lat)) * cos(radians(s.stop_lat)) * sin(radians(s.stop_lon - p.lon) / 2) * sin(radians(s.stop_lon - p.lon) / 2))) AS dist_m
  FROM pos p JOIN stop_times s USING (trip_id) WHERE s.stop_lat IS NOT NULL AND s.sched_arrival_sec IS NOT NULL),
best AS (
  SELECT vehicle_id, obs_epoch, trip_id, min(ROW(CAST(round(CAST(dist_m AS DECIMAL(38,6)), 1) AS DOUBLE), stop_sequence, stop_id, sched_arrival_sec)) AS b
  FROM cand GROUP BY ALL),
bad AS (SELECT trip_id, count(*) AS n FROM stop_times WHERE stop_lat IS NULL OR sched_arrival_sec IS NULL GROUP BY ALL)
SELECT vehicle_id, obs_epoch, b[3] AS stop_id, b[2] AS stop_sequence, b[4] AS sched_arrival_sec, b[1] AS dist_to_stop_m,
       CAST(coalesce(n, 0) AS BIGINT) AS n_malformed
FROM best LEFT JOIN bad USING (trip_id)"""


@register("nearest_stop", _NEAREST_SQL)
def q_nearest_stop(spark, sf_dir):
    """Nearest stop by growing rings; a third of all pings and stops share one trip, some stops are malformed."""
    from transitlens.operators import nearest
    T = Tables(spark, sf_dir)
    no, eid = F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.col("event_id")
    hot = lambda key, other: F.when(F.col(key) % 3 == 0, "HOT").otherwise(F.col(other).cast("string")).alias("trip_id")
    at = lambda base, n: F.lit(base) + n.cast("double") / 100000.0
    line = T("lineitem")
    stop_times = line.select(hot("l_orderkey", "l_orderkey"), no.cast("string").alias("stop_id"), F.col("l_linenumber").cast("int").alias("stop_sequence"),
                             F.when(no % 77 != 0, (F.col("l_partkey") * 37) % 108000).cast("long").alias("sched_arrival_sec"))
    stops = line.select(no.cast("string").alias("stop_id"), F.lit(None).cast("string").alias("stop_name"),
                        F.when(no % 50 != 0, at(28.5, (no * 7919) % 20011)).alias("stop_lat"), at(77.0, (no * 104729) % 20021).alias("stop_lon")).distinct()
    pos = T("events").select(eid.cast("string").alias("vehicle_id"), eid.cast("long").alias("obs_epoch"), hot("event_id", "user_id"),
                             F.lit(None).cast("string").alias("route_id_rt"), at(28.5, (eid * 37) % 20000).alias("lat"),
                             at(77.0, (eid * 7877) % 20000).alias("lon"), F.lit(None).cast("double").alias("speed"))
    near = nearest.nearest_by_rings(pos, stop_times, stops)
    return (near.join(nearest.malformed_stops(stop_times, stops), "trip_id", "left")
            .select("vehicle_id", "obs_epoch", "stop_id", "stop_sequence", "sched_arrival_sec",
                    F.round(F.col("dist_to_stop_m").cast("decimal(38,6)"), 1).cast("double").alias("dist_to_stop_m"),
                    F.coalesce("n_malformed", F.lit(0)).cast("long").alias("n_malformed")))


@register("delay_quantiles", with_static() + """
, qs AS (
  SELECT quantile_cont(delay_min, [0.0, 0.25, 0.5, 0.75, 1.0]) AS dq,
         quantile_cont(CAST(round(CAST(dist_to_stop_m AS DECIMAL(38,6)), 1) AS DOUBLE), [0.0, 0.25, 0.5, 0.75, 1.0]) AS mq
  FROM delays)
SELECT statistic, CAST(round(CAST(dq[i] AS DECIMAL(38,6)), 4) AS DOUBLE) AS delay_min,
       CAST(round(CAST(mq[i] AS DECIMAL(38,6)), 4) AS DOUBLE) AS dist_to_stop_m
FROM qs CROSS JOIN (VALUES ('min', 1), ('25%', 2), ('50%', 3), ('75%', 4), ('max', 5)) v(statistic, i)""")
def q_delay_quantiles(spark, sf_dir):
    """A4: exact quartile summary of delay and stop distance."""
    from transitlens.operators import delays
    return delays.delay_quantiles(_delays(spark, sf_dir))


# ---------------------------------------------------------------- model

def _model_data(spark, sf_dir):
    from transitlens.operators import model
    from transitlens.plans import reports
    from pyspark import StorageLevel
    wh = _wh(spark, sf_dir)
    # the prepared rows feed several aggregates (split counts, encodings, metrics)
    return wh, model.prepared(reports.route_hour_view(wh)).persist(StorageLevel.MEMORY_AND_DISK)


_MODEL_CTE = with_ctes("warehouse") + """
, tr AS (
  SELECT route_id, route_key, date_key, full_date, CAST(hour_key AS INTEGER) AS hour_key,
         CAST(day_of_week AS INTEGER) AS day_of_week, n_moving,
         CAST(avg_moving_speed_kmph AS DOUBLE) AS avg_moving_speed_kmph,
         CAST(hour_key IN (8, 9, 18, 19, 20) AS INTEGER) AS is_peak_hour,
         CAST(day_of_week IN (1, 7) AS INTEGER) AS is_weekend,
         ((CAST(date_key AS BIGINT) * 31 + hour_key) * 1000003 + CAST(route_key AS BIGINT) * 7919 + 42) % 100 < 80 AS is_train
  FROM rh_view WHERE n_moving >= 3
), ravg AS (SELECT route_id, avg(avg_moving_speed_kmph) AS r FROM tr WHERE is_train GROUP BY route_id),
gavg AS (SELECT avg(avg_moving_speed_kmph) AS g FROM tr WHERE is_train),
enc AS (SELECT tr.*, coalesce(ravg.r, gavg.g) AS route_avg_speed FROM tr LEFT JOIN ravg USING (route_id) CROSS JOIN gavg)
"""


@register("model_features", _MODEL_CTE + """
SELECT route_id, full_date, hour_key, day_of_week, is_peak_hour, is_weekend, is_train,
       CAST(round(CAST(route_avg_speed AS DECIMAL(38,6)), 4) AS DOUBLE) AS route_avg_speed, avg_moving_speed_kmph FROM enc""")
def q_model_features(spark, sf_dir):
    """Training rows with features, split flag and route-mean encoding."""
    from transitlens.functions.fmt import dec_round as dr
    _, d = _model_data(spark, sf_dir)
    return d.select("route_id", "full_date", "hour_key", "day_of_week", "is_peak_hour", "is_weekend", "is_train",
                    dr("route_avg_speed", 4).alias("route_avg_speed"), "avg_moving_speed_kmph")


@register("model_baseline_metrics", _MODEL_CTE + """
, t AS (SELECT * FROM enc WHERE NOT is_train),
ybar AS (SELECT avg(avg_moving_speed_kmph) AS y FROM t)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM enc WHERE is_train) AS n_train,
       (SELECT CAST(count(*) AS BIGINT) FROM enc WHERE NOT is_train) AS n_test,
       (SELECT CAST(count(DISTINCT full_date) AS BIGINT) FROM enc) AS n_dates,
       CAST(round(CAST(avg(abs(avg_moving_speed_kmph - route_avg_speed)) AS DECIMAL(38,6)), 4) AS DOUBLE) AS baseline_mae,
       CAST(round(CAST(1.0 - sum((avg_moving_speed_kmph - route_avg_speed) ^ 2)
                  / sum((avg_moving_speed_kmph - ybar.y) ^ 2) AS DECIMAL(38,6)), 4) AS DOUBLE) AS baseline_r2
FROM t CROSS JOIN ybar""")
def q_model_baseline_metrics(spark, sf_dir):
    """Route-mean baseline MAE and R^2 on the held-out split."""
    from transitlens.operators import model
    _, d = _model_data(spark, sf_dir)
    return model.baseline_metrics(d)


@register("stored_model_features", ORACLE["model_features"])
def q_stored_model_features(spark, sf_dir):
    """Training rows from the published tables."""
    return _stored_features(_stored(spark, sf_dir))


def _trained(spark, sf_dir):
    from transitlens.operators import model
    wh, d = _model_data(spark, sf_dir)
    return wh, d, model.train(d)


@register("model_forest_metrics")
def q_model_forest_metrics(spark, sf_dir):
    """M5 M6 M8: random forest (200 trees, depth 8, min leaf 3) vs baseline (rows-only check)."""
    from transitlens.operators import model
    _, d, m = _trained(spark, sf_dir)
    return model.evaluate(m, d)


@register("model_importance")
def q_model_importance(spark, sf_dir):
    """Feature importances, descending (rows-only check)."""
    from transitlens.operators import model
    _, _, m = _trained(spark, sf_dir)
    return model.importances(m)


@register("model_predict")
def q_model_predict(spark, sf_dir):
    """Batch scoring of every (route, hour, weekday) seen in the
    facts, through a saved-and-reloaded model (rows-only check)."""
    from transitlens.operators import model
    from transitlens.plans import reports
    from transitlens.session import scratch_path
    import uuid
    wh, _, m = _trained(spark, sf_dir)
    path = scratch_path(spark, f"models/speed-{uuid.uuid4().hex}")
    model.save(m, path)
    view = reports.route_hour_view(wh)
    req = view.select("route_id", F.col("hour_key").cast("int").alias("hour_key"),
                      F.col("day_of_week").cast("int").alias("day_of_week")).distinct()
    return model.score(model.load(path), req, view)


# ---------------------------------------------------------------- streaming (extensions)

def _stream_setup(spark, sf_dir, name):
    """Land the derived raw feed as time-ordered NDJSON chunks in a fresh folder
    under the shared checkpoint directory; returns (input, output, checkpoint)."""
    import uuid
    from transitlens.session import scratch_path
    from transitlens.streaming import stream as S
    root = scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex}")
    raw = _raw(spark, sf_dir).withColumn("_chunk", S.chunk_day())
    S.land_in_time_order(raw, f"{root}/in", "_chunk")
    return f"{root}/in", f"{root}/out", f"{root}/ckpt"


@register("stream_dedup", with_ctes("pings") + "SELECT DISTINCT vehicle_id, obs_epoch FROM valid_pos")
def q_stream_dedup(spark, sf_dir):
    """File stream -> watermark dedup -> idempotent foreachBatch sink."""
    from transitlens.streaming import stream as S
    src, out, ck = _stream_setup(spark, sf_dir, "dedup")
    s = S.dedup_stream(S.positions(S.snapshot_stream(spark, src, max_files=4))).select("vehicle_id", "obs_epoch")
    S.run_available_now(s, S.idempotent_sink(out), ck)
    return spark.read.parquet(out).select("vehicle_id", "obs_epoch")


@register("stream_speed", with_ctes("pings") + """
SELECT vehicle_id, obs_epoch, gap_s, CAST(round(CAST(dist_m AS DECIMAL(38,6)), 1) AS DOUBLE) AS dist_m,
       speed_kmph, is_speed_valid, is_moving
FROM pings""")
def q_stream_speed(spark, sf_dir):
    """Derived speed with keyed state (applyInPandasWithState) equals the batch result."""
    from transitlens.streaming import stream as S
    src, out, ck = _stream_setup(spark, sf_dir, "speed")
    # a vehicle's reports of one time chunk sit in one file and files are read in
    # modification order, so any batch size keeps each vehicle's reports ordered
    s = S.speed_stream(S.positions(S.snapshot_stream(spark, src, max_files=4)))
    S.run_available_now(s, S.idempotent_sink(out), ck)
    r = spark.read.parquet(out)
    return r.select("vehicle_id", "obs_epoch", "gap_s",
                    F.round(F.col("dist_m").cast("decimal(38,6)"), 1).cast("double").alias("dist_m"),
                    "speed_kmph", "is_speed_valid", "is_moving")


def _land_closing_report(raw: DataFrame, path: str) -> None:
    """A last report of a vehicle "~close", months after all others, which moves the stream's clock past them."""
    values = {"vehicle_id": F.lit("~close"), "route_id": F.lit("0"), "trip_id": F.lit("0"), "entity_id": F.lit("0"),
              "latitude": F.lit(28.6), "longitude": F.lit(77.2), "speed": F.lit(0.0),
              "vehicle_timestamp": (F.col("m") + 24 * 90) * 3600, "fetched_at": (F.col("m") + 24 * 90).cast("string")}
    last = raw.agg(F.max(F.col("fetched_at").cast("long")).alias("m")).filter("m is not null")
    last.select(*(values[c].alias(c) for c in raw.columns)).write.mode("append").json(path)


# Every thirteenth report is fetched nine hours after its snapshot, every fifth two hours after it.
_LATE_SHIFT = "CASE WHEN CAST(entity_id AS BIGINT) % 13 = 0 THEN 9 WHEN CAST(entity_id AS BIGINT) % 5 = 0 THEN 2 ELSE 0 END"
_LATE_BOUND_S = 14_400


def _late_sql() -> str:
    from transitlens.plans.oracle import CTE
    shifted = f"shifted AS (SELECT * REPLACE (CAST(CAST(fetched_at AS BIGINT) + {_LATE_SHIFT} AS VARCHAR) AS fetched_at) FROM raw)"
    lateness = "CAST(snapshot_id AS BIGINT) * 3600 - obs_epoch"
    chain = CTE["pings"].strip().replace("FROM raw", "FROM shifted").replace("valid_pos AS (", "all_valid AS (", 1).replace(
        "dedup AS (", f"valid_pos AS (SELECT * FROM all_valid WHERE {lateness} <= {_LATE_BOUND_S}),\ndedup AS (", 1)
    return with_ctes("raw") + ", " + shifted + ", " + chain + f"""
SELECT 'on_time' AS kind, vehicle_id, obs_epoch, snapshot_id, n_reports, gap_s, CAST(round(CAST(dist_m AS DECIMAL(38,6)), 1) AS DOUBLE) AS dist_m
FROM dist JOIN (SELECT vehicle_id, obs_epoch, CAST(count(*) AS BIGINT) AS n_reports FROM valid_pos GROUP BY ALL) n USING (vehicle_id, obs_epoch)
UNION ALL SELECT 'late', vehicle_id, obs_epoch, snapshot_id, 1, NULL, NULL FROM all_valid WHERE {lateness} > {_LATE_BOUND_S}"""


@register("stream_late", _late_sql())
def q_stream_late(spark, sf_dir):
    """Reports landed out of order and late; reordered in keyed state, late ones in a side output, none lost."""
    import uuid
    from transitlens.session import scratch_path
    from transitlens.streaming import late, stream as S
    root = scratch_path(spark, f"streams/late-{uuid.uuid4().hex}")
    raw = _raw(spark, sf_dir).withColumn("fetched_at", (F.col("fetched_at").cast("long") + F.expr(_LATE_SHIFT)).cast("string"))
    arrived = F.col("snapshot_id").cast("long") * 3600
    chunk = F.floor(F.col("fetched_at").cast("long") / 24).alias("_chunk")
    S.land_in_time_order(raw.select("*", chunk), f"{root}/in", "_chunk")
    _land_closing_report(raw, f"{root}/in")
    s = late.reordered(S.positions(S.snapshot_stream(spark, f"{root}/in", max_files=16)), arrived, _LATE_BOUND_S)
    S.run_available_now(s, S.idempotent_sink(f"{root}/out"), f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out").filter("vehicle_id <> '~close'").select(
        "kind", "vehicle_id", "obs_epoch", "snapshot_id", "n_reports", "gap_s", F.round(F.col("dist_m").cast("decimal(38,6)"), 1).cast("double").alias("dist_m"))


@register("stream_route_hour", with_ctes("pings") + """
SELECT route_id, DATE '1970-01-01' + CAST((obs_epoch + 19800) // 86400 AS INTEGER) AS service_date,
       CAST(((obs_epoch + 19800) // 3600) % 24 AS INTEGER) AS hour_of_day, CAST(count(*) AS BIGINT) AS n_reports
FROM valid_pos GROUP BY ALL""")
def q_stream_route_hour(spark, sf_dir):
    """Reports per route and local hour from a windowed streaming
    aggregate (update mode) merged by a foreachBatch upsert."""
    from transitlens.functions.timefn import local_date, local_hour
    from transitlens.streaming import stream as S
    src, out, ck = _stream_setup(spark, sf_dir, "route-hour")
    agg = S.local_hour_counts(S.positions(S.snapshot_stream(spark, src, max_files=2)))
    start = F.unix_seconds(F.col("w.start"))
    shaped = agg.select("route_id", local_date(start, DEFAULT.time_zone).alias("service_date"),
                        local_hour(start, DEFAULT.time_zone).alias("hour_of_day"), "n_reports")
    S.run_available_now(shaped, S.upsert_sink(spark, out, ["route_id", "service_date", "hour_of_day"], "service_date"),
                        ck, mode="update")
    return spark.read.parquet(out).select("route_id", "service_date", "hour_of_day", "n_reports")


@register("stream_route_hour_vehicles", with_ctes("pings") + """
SELECT route_id, DATE '1970-01-01' + CAST((obs_epoch + 19800) // 86400 AS INTEGER) AS service_date,
       CAST(((obs_epoch + 19800) // 3600) % 24 AS INTEGER) AS hour_of_day, CAST(count(DISTINCT vehicle_id) AS BIGINT) AS n_vehicles
FROM valid_pos GROUP BY ALL""")
def q_stream_route_hour_vehicles(spark, sf_dir):
    """Exact distinct vehicles per route and local hour, by two chained stateful operators."""
    from transitlens.functions.timefn import local_date, local_hour
    from transitlens.streaming import stream as S
    src, out, ck = _stream_setup(spark, sf_dir, "route-hour-vehicles")
    _land_closing_report(_raw(spark, sf_dir), src)
    counts = S.local_hour_vehicles(S.positions(S.snapshot_stream(spark, src, max_files=8)))
    S.run_available_now(counts, S.idempotent_sink(out), ck)
    start = F.unix_seconds(F.col("w.start"))
    return spark.read.parquet(out).select("route_id", local_date(start, DEFAULT.time_zone).alias("service_date"),
                                          local_hour(start, DEFAULT.time_zone).alias("hour_of_day"), "n_vehicles")


@register("stream_totals_replayed", with_ctes("pings") + """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, route_id, n_reports, sum_epoch, 'failed after commit, replayed' AS second_batch
FROM (SELECT DATE '1970-01-01' + CAST((obs_epoch + 19800) // 86400 AS INTEGER) AS d, route_id, CAST(count(*) AS BIGINT) AS n_reports,
             CAST(sum(obs_epoch) AS BIGINT) AS sum_epoch FROM valid_pos GROUP BY ALL) t""")
def q_stream_totals_replayed(spark, sf_dir):
    """E5: sums per date and route kept by a stream whose second batch fails between its commit and the
    checkpoint; the restarted stream sends it again, and it counts once."""
    from transitlens.functions.fmt import date_key
    from transitlens.functions.timefn import local_date
    from transitlens.plans import published
    from transitlens.streaming import stream as S
    src, out, ck = _stream_setup(spark, sf_dir, "totals")
    rows = S.positions(S.snapshot_stream(spark, src, max_files=2)).select(
        date_key(local_date(F.col("obs_epoch"), DEFAULT.time_zone)).alias("date_key"), "route_id",
        F.lit(1).alias("n_reports"), F.col("obs_epoch").alias("sum_epoch"))
    sink = S.additive_sink(spark, out, "totals", ["route_id"], ["n_reports", "sum_epoch"], "feed")
    seen = []

    def failing(batch, batch_id):
        sink(batch, batch_id)
        seen.append(batch_id)
        if seen == [0, 1]:
            raise RuntimeError("stopped after the commit")
    try:
        S.run_available_now(rows, failing, ck)
    except Exception:  # noqa: BLE001 -- the planned failure; anything else shows in ``seen``
        if seen != [0, 1]:
            raise
    S.run_available_now(rows, failing, ck)
    story = "failed after commit, replayed" if seen[:3] == [0, 1, 1] else str(seen)
    return published.read_table(spark, out, "totals").select("date_key", "route_id", "n_reports", "sum_epoch",
                                                             F.lit(story).alias("second_batch"))


# ---------------------------------------------------------------- sources / sinks round trips

@register("feed_damaged_lines", with_ctes("raw") + """
SELECT 'record' AS kind, entity_id, vehicle_id, route_id, latitude, vehicle_timestamp, fetched_at, CAST(1 AS BIGINT) AS n
FROM raw WHERE CAST(entity_id AS BIGINT) % 50 <> 0
UNION ALL SELECT 'quarantined', NULL, NULL, NULL, NULL, NULL, NULL, CAST(count(*) AS BIGINT) FROM raw WHERE CAST(entity_id AS BIGINT) % 50 = 0""")
def q_feed_damaged_lines(spark, sf_dir):
    """Records landed as JSON lines, every fiftieth cut in half; the rest read back, the damaged ones counted."""
    import uuid
    from transitlens.session import scratch_path
    from transitlens.sources import feed
    path = scratch_path(spark, f"damaged-{uuid.uuid4().hex}")
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("entity_id").cast("long") % 50 == 0, F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))).otherwise(line)
    _raw(spark, sf_dir).select(cut.alias("value")).write.text(path)
    records, bad = feed.split_records(spark.read.text(path))
    cols = ["entity_id", "vehicle_id", "route_id", "latitude", "vehicle_timestamp", "fetched_at"]
    kinds = records.select(F.lit("record").alias("kind"), *cols, F.lit(1).cast("long").alias("n"))
    return kinds.unionByName(bad.agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("quarantined")), allowMissingColumns=True)


@register("feed_damaged_arrays", with_ctes("raw") + """
, marked AS (SELECT *, CAST(fetched_at AS BIGINT) % 10 = 3 AS cut, CAST(entity_id AS BIGINT) % 50 = 0 AS spoilt FROM raw)
SELECT 'record' AS kind, entity_id, vehicle_id, route_id, latitude, vehicle_timestamp, fetched_at, CAST(1 AS BIGINT) AS n
FROM marked WHERE NOT cut AND NOT spoilt
UNION ALL SELECT 'damaged record', NULL, NULL, NULL, NULL, NULL, NULL, CAST(count(*) AS BIGINT) FROM marked WHERE NOT cut AND spoilt
UNION ALL SELECT 'damaged file', NULL, NULL, NULL, NULL, NULL, NULL, CAST(count(DISTINCT fetched_at) AS BIGINT) FROM marked WHERE cut""")
def q_feed_damaged_arrays(spark, sf_dir):
    """A JSON array per snapshot, every tenth file cut in half, every fiftieth record with a latitude that is no number."""
    import uuid
    from transitlens.session import scratch_path
    from transitlens.sources import feed
    path = scratch_path(spark, f"arrays-{uuid.uuid4().hex}")
    spoilt = F.col("entity_id").cast("long") % 50 == 0
    line = F.to_json(F.struct("*"))
    line = F.when(spoilt, F.regexp_replace(line, '"latitude":[-0-9.E]+', '"latitude":"n/a"')).otherwise(line)
    arrays = _raw(spark, sf_dir).groupBy("fetched_at").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(line), ",\n"), F.lit("]")).alias("value"))
    half = F.substring(F.col("value"), F.lit(1), F.floor(F.length("value") / 2).cast("int"))
    (arrays.select(F.when(F.col("fetched_at").cast("long") % 10 == 3, half).otherwise(F.col("value")).alias("value"))
           .write.option("maxRecordsPerFile", 1).text(path))
    records, bad, files = feed.split_arrays(spark, path)
    cols = ["entity_id", "vehicle_id", "route_id", "latitude", "vehicle_timestamp", "fetched_at"]
    out = records.select(F.lit("record").alias("kind"), *cols, F.lit(1).cast("long").alias("n"))
    for kind, rest in (("damaged record", bad), ("damaged file", files)):
        out = out.unionByName(rest.agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind)), allowMissingColumns=True)
    return out


@register("timetable_damaged_csv", with_static() + """
, marked AS (SELECT *, CAST(trip_id AS BIGINT) % 40 AS m FROM stop_times)
SELECT 'row' AS kind, trip_id, stop_id, CASE WHEN m <> 2 THEN stop_sequence END AS stop_sequence, sched_arrival_sec, CAST(1 AS BIGINT) AS n
FROM marked WHERE m NOT IN (0, 1)
UNION ALL SELECT 'quarantined', NULL, NULL, NULL, NULL, CAST(count(*) AS BIGINT) FROM marked WHERE m IN (0, 1)""")
def q_timetable_damaged_csv(spark, sf_dir):
    """Stop times as CSV behind a byte-order mark, some lines with too few or too many fields, some with
    a stop number that is no number."""
    import uuid
    from transitlens.session import scratch_path
    from transitlens.sources import feed
    t = Tables(spark, sf_dir)
    times = fixtures.static_timetable(t("lineitem"), t("supplier"), t("orders"), t("customer"))[0]
    path, m = scratch_path(spark, f"csv-{uuid.uuid4().hex}"), F.col("trip_id").cast("long") % 40
    number = F.when(m == 2, F.lit("x")).otherwise(F.col("stop_sequence"))
    line = F.when(m == 0, F.concat_ws(",", "trip_id", "arrival_time")).otherwise(
        F.concat_ws(",", "trip_id", "arrival_time", "departure_time", "stop_id", number, F.when(m == 1, F.lit("more"))))
    # one column whose name is the header line, with a separator that no line holds
    times.select(line.alias("\ufeff" + ",".join(times.columns))).write.option("header", True).option("sep", "\u0001").csv(path)
    rows, bad = feed.split_csv(spark, path)
    typed = feed.static_frames(stop_times=rows)["stop_times"]
    kinds = typed.select(F.lit("row").alias("kind"), "trip_id", "stop_id", "stop_sequence",
                         F.col("sched_arrival_sec"), F.lit(1).cast("long").alias("n"))
    return kinds.unionByName(bad.agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("quarantined")), allowMissingColumns=True)


@register("raw_landing_roundtrip", with_ctes("raw") + """
SELECT strftime(make_timestamp(vehicle_timestamp * 1000000), '%Y') AS year,
       strftime(make_timestamp(vehicle_timestamp * 1000000), '%m') AS month,
       strftime(make_timestamp(vehicle_timestamp * 1000000), '%d') AS day,
       CAST(count(*) AS BIGINT) AS n_records, CAST(count(DISTINCT fetched_at) AS BIGINT) AS n_snapshots,
       CAST(count(*) FILTER (WHERE trip_id IS NULL) AS BIGINT) AS n_without_trip
FROM raw GROUP BY ALL""")
def q_raw_landing_roundtrip(spark, sf_dir):
    """Land the decoded feed as NDJSON under year=/month=/day= (UTC fetch
    day), read it back with the declared schema, count per partition."""
    import uuid
    from transitlens.functions.timefn import utc_ntz
    from transitlens.session import scratch_path
    from transitlens.sources import feed
    path = scratch_path(spark, f"raw-landing-{uuid.uuid4().hex}")
    raw = _raw(spark, sf_dir)
    feed.land_raw(raw, path, day=F.to_date(utc_ntz("vehicle_timestamp")))
    from pyspark.sql import types as T
    landed = T.StructType(list(feed.schemas.RAW.fields) + [T.StructField(c, T.StringType()) for c in ("year", "month", "day")])
    back = spark.read.schema(landed).option("multiLine", False).json(path)
    return back.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_distinct("fetched_at").alias("n_snapshots"),
        F.count_if(F.col("trip_id").isNull()).alias("n_without_trip"))


@register("partition_overwrite_roundtrip", _TWO_BATCH_CTES + """
first_day AS (SELECT min(service_date) AS d FROM route_hour),
final AS (
  SELECT * FROM route_hour WHERE service_date <> (SELECT d FROM first_day)
  UNION ALL SELECT * FROM route_hour_b1 WHERE service_date = (SELECT d FROM first_day))
SELECT service_date, CAST(count(*) AS BIGINT) AS n_route_hours, CAST(sum(n_pings) AS BIGINT) AS n_pings,
       CAST(sum(n_moving) AS BIGINT) AS n_moving
FROM final GROUP BY service_date""")
def q_partition_overwrite_roundtrip(spark, sf_dir):
    """Write route-hours by service_date, then overwrite only the first
    date's partition with batch-1 rows (dynamic mode); read back by partition."""
    import uuid
    from transitlens.operators import warehouse as W
    from transitlens.session import scratch_path
    path = scratch_path(spark, f"route-hour-{uuid.uuid4().hex}")
    p1, p2 = _batches(spark, sf_dir)
    rh1, rh2 = metrics.route_hour(p1), metrics.route_hour(p2)
    W.write_partitioned(rh2, path, "service_date")
    first = rh2.agg(F.min("service_date").alias("d"))
    W.write_partitioned(rh1.join(first, rh1["service_date"] == first["d"], "left_semi"), path, "service_date")
    back = spark.read.parquet(path)
    return back.groupBy("service_date").agg(F.count(F.lit(1)).alias("n_route_hours"),
                                            F.sum("n_pings").alias("n_pings"), F.sum("n_moving").alias("n_moving"))


@register("feed_presence", with_ctes("raw") + """
SELECT CAST(count(*) AS BIGINT) AS n_records,
       CAST(count(*) FILTER (WHERE route_id IS NULL AND event_id % 5 = 0) AS BIGINT) AS n_without_trip,
       CAST(count(*) FILTER (WHERE latitude IS NULL) AS BIGINT) AS n_without_position
FROM (SELECT CAST(entity_id AS BIGINT) AS event_id, CASE WHEN CAST(entity_id AS BIGINT) % 5 = 0 THEN NULL ELSE route_id END AS route_id,
             CASE WHEN CAST(entity_id AS BIGINT) % 7 = 0 THEN NULL ELSE latitude END AS latitude
      FROM raw WHERE CAST(entity_id AS BIGINT) % 13 <> 0) x""")
def q_feed_presence(spark, sf_dir):
    """Decoded nested feed entities (some without vehicle, trip or position)
    flattened by the presence rule; entities without a vehicle are dropped."""
    from transitlens.sources import feed
    raw = _raw(spark, sf_dir)
    eid = F.col("entity_id").cast("long")
    nested = raw.select(
        F.col("entity_id").alias("id"),
        F.when(eid % 13 != 0, F.struct(
            F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
            F.when(eid % 5 != 0, F.struct("route_id", "trip_id")).alias("trip"),
            F.when(eid % 7 != 0, F.struct("latitude", "longitude", "speed")).alias("position"),
            F.col("vehicle_timestamp").alias("timestamp"))).alias("vehicle"),
        "fetched_at")
    flat = feed.feed_presence(nested, F.col("fetched_at"))
    return flat.agg(F.count(F.lit(1)).alias("n_records"),
                    F.count_if(F.col("route_id").isNull() & (F.col("entity_id").cast("long") % 5 == 0)).alias("n_without_trip"),
                    F.count_if(F.col("latitude").isNull()).alias("n_without_position"))
