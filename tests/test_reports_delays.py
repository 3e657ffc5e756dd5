import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from transitlens.operators import delays, warehouse as W
from transitlens.plans import reports
from transitlens.plans.warehouse_build import Warehouse


def small_wh(spark):
    dr = spark.createDataFrame([(1, "r1"), (2, "r2"), (3, "r3")], "route_key int, route_id string")
    rh = spark.createDataFrame([
        (20260101, 8, 1, 10, 3, 9, 5, 4.0, 4.86, 2), (20260101, 8, 2, 10, 3, 9, 5, 4.0, 4.86, 1),
        (20260101, 9, 3, 10, 3, 9, 0, None, None, 0), (20260103, 8, 1, 10, 3, 9, 6, 5.0, 6.00, 0),
        (20260101, 22, 3, 10, 3, 9, 4, 7.0, 7.50, 9)],
        "date_key int, hour_key int, route_key int, n_pings int, n_vehicles int, n_speed_obs int, n_moving int, "
        "avg_speed_kmph double, avg_moving_speed_kmph double, n_bunched int")
    rh = rh.withColumn("hour_key", F.col("hour_key").cast("short")) \
           .withColumn("avg_speed_kmph", F.col("avg_speed_kmph").cast("decimal(7,2)")) \
           .withColumn("avg_moving_speed_kmph", F.col("avg_moving_speed_kmph").cast("decimal(7,2)"))
    wh = Warehouse(spark, None, None, fact_route_hour=rh)
    wh.__dict__["dim_route"] = dr
    return wh


def test_slowest_ties_and_floor(spark):
    got = reports.slowest_route_hours(small_wh(spark), limit=10).collect()
    assert [(r["route_id"], str(r["full_date"])) for r in got] == [
        ("r1", "2026-01-01"), ("r2", "2026-01-01"), ("r1", "2026-01-03"), ("r3", "2026-01-01")]


def test_day_part_nulls_last_and_trend_uses_previous_observed_day(spark):
    wh = small_wh(spark)
    parts = reports.by_day_part(wh).collect()
    assert parts[-1]["avg_speed_kmph"] is None and parts[-1]["day_part"] == "Morning peak" or \
        [p["avg_speed_kmph"] for p in parts][-1] is not None
    assert all(parts[i]["avg_speed_kmph"] is not None for i in range(len(parts) - 1)) or parts[-1]["avg_speed_kmph"] is None
    trend = [r for r in reports.day_over_day(wh).collect() if r["route_id"] == "r1"]
    assert [(str(r["full_date"]), r["prev_day_speed"], r["change_vs_prev_day"]) for r in trend] == [
        ("2026-01-01", None, None), ("2026-01-03", 4.86, 1.14)]


def test_bunching_rate_floor_and_bar_scale(spark):
    wh = small_wh(spark)
    b = reports.bunching_rate(wh).collect()
    assert [(r["route_id"], r["total_moving_pings"], r["bunching_pct"]) for r in b] == [("r1", 11, 18.2)]
    bars = reports.bar_scale(reports.slowest_route_hours(wh)).collect()
    assert max(r["bar_pct"] for r in bars) == 100.0 and min(r["bar_pct"] for r in bars) >= 6.0


def test_route_speed_not_found(spark):
    import pytest
    wh = small_wh(spark)
    with pytest.raises(reports.NotFound):
        reports.require_rows(reports.route_speed(wh, "nope"), "no data")
    with pytest.raises(ValueError):
        reports.route_speed(wh, "r1", hour=24)


def test_delay_midnight_crossing(spark):
    # observed 00:30 local on 2026-01-02, nearest stop scheduled 24:20:00 of the previous day's trip
    obs = 1767225600 + 86400 - 19800 + 30 * 60
    pos = spark.createDataFrame([("v", "t1", "r", 28.5, 77.0, 0.0, obs)],
                                "vehicle_id string, trip_id string, route_id_rt string, lat double, lon double, speed double, obs_epoch long")
    st = spark.createDataFrame([("t1", "s1", 1, 24 * 3600 + 20 * 60), ("t1", "s2", 2, None)],
                               "trip_id string, stop_id string, stop_sequence int, sched_arrival_sec int")
    stops = spark.createDataFrame([("s1", "Stop 1", 28.5, 77.0), ("s2", "Stop 2", 28.6, 77.0)],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double")
    trips = spark.createDataFrame([("t1", "R")], "trip_id string, route_id string")
    routes = spark.createDataFrame([("R", "S", "Long")], "route_id string, route_short_name string, route_long_name string")
    r = delays.build_delays(pos, st, stops, trips, routes).first()
    assert (r["stop_id"], r["delay_sec"], str(r["service_date"]), r["is_near_stop"]) == ("s1", 600, "2026-01-01", True)
    legacy = delays.build_delays(pos, st, stops, trips, routes, legacy_service_date=True).first()
    assert str(legacy["service_date"]) == "2026-01-03"


def test_nearest_stop_tie_break(spark):
    pos = spark.createDataFrame([("v", "t1", None, 28.5, 77.0, 0.0, 1767250000)],
                                "vehicle_id string, trip_id string, route_id_rt string, lat double, lon double, speed double, obs_epoch long")
    st = spark.createDataFrame([("t1", "b", 3, 100), ("t1", "a", 3, 50), ("t1", "c", 2, 10)],
                               "trip_id string, stop_id string, stop_sequence int, sched_arrival_sec int")
    stops = spark.createDataFrame([("a", "A", 28.51, 77.0), ("b", "B", 28.51, 77.0), ("c", "C", 28.52, 77.0)],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double")
    near = delays.nearest_stop(delays.candidates(delays.clean_positions(pos), st, stops)).first()
    assert near["stop_id"] == "a"


def test_snapshot_diff_semantics(spark):
    from transitlens import schemas
    from transitlens.operators import diagnostics
    recs = [
        ("e1", "A", "1", None, 28.50, 77.0, 0.0, 100, "s1"), ("e2", "B", "1", None, 28.60, 77.0, 0.0, 100, "s1"),
        ("e3", None, "1", None, 28.70, 77.0, None, 100, "s1"),
        ("e4", "A", "1", None, 28.50, 77.0, 0.0, 200, "s2"),                 # A did not move
        ("e5", "B", "1", None, 28.61, 77.0, 0.0, 150, "s2"),
        ("e6", "B", "1", None, 28.62, 77.0, 0.0, 250, "s2"),                 # B's latest report wins: moved
        ("e7", None, "1", None, 28.70, 77.0, None, 200, "s2"),               # missing id counts as one value
        ("e8", "C", "1", None, 28.80, 77.0, 5.0, 200, "s2")]                 # new vehicle
    raw = spark.createDataFrame(recs, schemas.RAW)
    got = [tuple(r) for r in diagnostics.snapshot_diff(raw).collect()]
    assert got == [("s2", "s1", 3, 1)]
    prof = {r["snapshot_id"]: r for r in diagnostics.snapshot_profile(raw).collect()}
    assert (prof["s2"]["records"], prof["s2"]["distinct_vehicles"], prof["s2"]["speed_nonzero"],
            prof["s2"]["max_speed"], prof["s2"]["distinct_speeds"]) == (5, 4, 1, 5.0, 3)


def test_insight_prompt_format(spark):
    text = reports.insight_prompt(small_wh(spark)).first()["prompt"]
    lines = text.split("\n")
    assert lines[0] == reports.PROMPT_SLOW_HEADER
    assert lines[1] == "- Route r1 on 2026-01-01 at 08:00-08:59: 5 buses, 4.86 km/h"
    assert lines[2] == "- Route r2 on 2026-01-01 at 08:00-08:59: 5 buses, 4.86 km/h"
    assert "- Route r1: 18.2% bunched (2 of 11 moving pings)" in lines
    assert text.endswith("beyond one short suggestion.")
    assert lines.index("- Route r1: 18.2% bunched (2 of 11 moving pings)") > lines.index(
        "Routes with the highest bus-bunching rate (same route, buses within 300m):")


def test_malformed_stops_are_no_candidates(spark):
    from transitlens.operators import delays
    rows = [("v", 1, "t", None, 10, 1, "s1"), ("v", 1, "t", 5.0, 20, 2, "s2"), ("v", 1, "t", 1.0, None, 3, "s3")]
    cand = spark.createDataFrame([(*r, "n", "r", 28.5, 77.0, 0.0) for r in rows],
                                 "vehicle_id string, obs_epoch long, trip_id string, dist_to_stop_m double, sched_arrival_sec long, "
                                 "stop_sequence int, stop_id string, stop_name string, route_id_rt string, lat double, lon double, speed double")
    assert [r["stop_id"] for r in delays.nearest_stop(cand).collect()] == ["s2"]
    assert [tuple(r) for r in delays.unusable_stops(cand).collect()] == [("t", 2)]


def test_nearest_run_folds_to_the_nearest_day(spark):
    from pyspark.sql import functions as F
    from transitlens.operators.delays import nearest_run
    midnight = 1767225600 - 19_800                    # of 2026-01-01 in +05:30
    cases = [(s, o) for s in (0, 1, 43_200, 86_399, 90_000, 108_000, 200_000) for o in (0, 1, 43_199, 43_200, 46_800, 64_800, 70_400, 86_399)]
    df = spark.createDataFrame([(s, midnight + o) for s, o in cases], "due int, epoch long")
    got = {(r.due, r.epoch - midnight): r for r in df.select("due", "epoch", nearest_run(F.col("epoch"), F.col("due"), "Asia/Kolkata").alias("r")).select("due", "epoch", "r.*").collect()}
    for s, o in cases:
        raw = o - s
        days = (1 if raw >= 0 else -1) * ((abs(raw) * 2 + 86_400) // 172_800)     # nearest whole day, halves away from zero
        r = got[(s, o)]
        assert (r.days, r.late) == (days, raw - days * 86_400), (s, o)
        assert (r.day - __import__("datetime").date(2026, 1, 1)).days == days
