"""The speed-analytics flow as composable stages (3.1 of the survey).

raw feed -> positions -> clean/dedup/speed -> bunching -> route-hour.
Each stage is lazy; callers decide what to persist or write.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from transitlens.config import DEFAULT, Params
from transitlens.operators import bunching, metrics, pings as P
from transitlens.session import delete_path, scratch_path
from transitlens.sources import feed, fixtures


def pings_from_raw(raw: DataFrame, p: Params = DEFAULT, materialize: bool = True) -> DataFrame:
    """Cleaned pings are read by several branches of the bunching plan, so they
    are written once to the shared checkpoint folder; the folder is deleted when
    bunching is done.  (A cache keeps every shuffle partition of its plan as it is, however
    small, and each branch starts a task for each.)  The flagged pings -- the
    vehicle_pings_clean table -- are written there too and read back, so every consumer
    (route-hour, dimensions, facts, checks, reports) starts from a pruned
    columnar scan instead of re-planning and re-running the whole flow."""
    pos = feed.positions_for_speed(raw)
    cleaned = P.clean(pos, p)
    if not materialize:
        return bunching.flag_bunching(cleaned, p)
    spark = cleaned.sparkSession
    path = scratch_path(spark, f"cleaned-{uuid.uuid4().hex}")
    try:
        cleaned.write.mode("errorifexists").parquet(path)
        return write_and_read(bunching.flag_bunching(spark.read.schema(cleaned.schema).parquet(path), p), "vehicle_pings_clean")
    finally:
        delete_path(spark, path)


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    from transitlens.session import materialize
    return materialize(df, name)


def fixture_raw(tables: fixtures.Tables) -> DataFrame:
    return fixtures.raw_feed(tables("events"))


def fixture_pings(tables: fixtures.Tables, p: Params = DEFAULT) -> DataFrame:
    return pings_from_raw(fixture_raw(tables), p)


def fixture_route_hour(tables: fixtures.Tables, p: Params = DEFAULT) -> DataFrame:
    return metrics.route_hour(fixture_pings(tables, p))


def run_speed_job(spark, raw: DataFrame, output: str, p: Params = DEFAULT) -> dict:
    """The batch job (R14, K1, K9): pings and route-hours written as Parquet by
    service_date with dynamic partition overwrite.  Row counts come back through
    observe() on the writes, so no extra pass runs just to print a number."""
    from pyspark.sql import Observation, functions as F
    from transitlens.operators import warehouse as W
    pings = pings_from_raw(raw, p)
    rh = metrics.route_hour(pings)
    o1, o2 = Observation("pings"), Observation("route_hour")
    W.write_partitioned(pings.observe(o1, F.count(F.lit(1)).alias("rows"),
                                      F.count_if("is_speed_valid").alias("valid_speed")),
                        f"{output}/vehicle_pings_clean", "service_date")
    W.write_partitioned(rh.observe(o2, F.count(F.lit(1)).alias("rows")), f"{output}/route_hour_speed", "service_date")
    return {"pings": o1.get["rows"], "valid_speed": o1.get["valid_speed"], "route_hours": o2.get["rows"]}
