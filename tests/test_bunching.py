import math
import random

from tests.conftest import rows
from transitlens.config import Params
from transitlens.operators import bunching

SCHEMA = "snapshot_id string, route_id string, vehicle_id string, lat double, lon double, is_moving boolean"
M_PER_DEG = 6371000.0 * 3.141592653589793 / 180.0


def brute(df, p=Params()):
    """All pairs of a snapshot and route, in plain Python."""
    pts = [r for r in df.select("snapshot_id", "route_id", "vehicle_id", "lat", "lon", "is_moving").collect()
           if r["is_moving"] and r["snapshot_id"] is not None and r["route_id"] is not None]

    def metres(a, b):
        x, y = (a, b) if a["vehicle_id"] < b["vehicle_id"] else (b, a)
        f, g = math.radians(x["lat"]), math.radians(y["lat"])
        h = math.sin((g - f) / 2) ** 2 + math.cos(f) * math.cos(g) * math.sin(math.radians(y["lon"] - x["lon"]) / 2) ** 2
        return 2 * 6371000.0 * math.asin(min(1.0, math.sqrt(h)))
    groups = {}
    for r in pts:
        groups.setdefault((r["snapshot_id"], r["route_id"]), []).append(r)
    return sorted({(*k, a["vehicle_id"]) for k, g in groups.items() for a in g for b in g
                   if a["vehicle_id"] != b["vehicle_id"] and metres(a, b) < p.bunch_m})


def test_threshold_is_strict(spark):
    d299, d301 = 299.0 / M_PER_DEG, 301.0 / M_PER_DEG
    df = spark.createDataFrame([
        ("s", "1", "a", 28.5, 77.0, True), ("s", "1", "b", 28.5 + d299, 77.0, True),
        ("s", "1", "c", 28.6, 77.0, True), ("s", "1", "d", 28.6 + d301, 77.0, True),
        ("s", "2", "e", 28.5, 77.0, True),                      # other route: not a partner
        ("t", "1", "f", 28.5 + d299 / 2, 77.0, True),           # other snapshot
        ("s", "1", "g", 28.5, 77.0001, False)], SCHEMA)          # not moving
    got = rows(bunching.close_vehicles(df))
    assert got == [("s", "1", "a"), ("s", "1", "b")]


def test_same_vehicle_twice_is_not_a_pair_but_flag_fans_out(spark):
    df = spark.createDataFrame([
        ("s", "1", "a", 28.5, 77.0, True), ("s", "1", "a", 28.5001, 77.0, True),
        ("s", "1", "b", 28.7, 77.0, True), ("s", "1", "c", 28.7001, 77.0, True),
        ("s", "1", "c", 28.9, 77.0, False)], SCHEMA)
    assert rows(bunching.close_vehicles(df)) == [("s", "1", "b"), ("s", "1", "c")]
    flagged = bunching.flag_bunching(df)
    assert flagged.filter("is_bunched AND NOT is_moving").count() == 1          # trap 2, as the reference
    strict = bunching.flag_bunching(df, Params(strict_bunching=True))
    assert strict.filter("is_bunched AND NOT is_moving").count() == 0


def test_grid_method_equals_all_pairs(spark):
    rnd = random.Random(7)
    recs = []
    for s in range(3):
        for i in range(400):
            if i < 120:     # a dense clump (many buses inside ~100 m)
                lat, lon = 28.6 + rnd.uniform(0, 0.001), 77.2 + rnd.uniform(0, 0.001)
            else:           # sparse spread, with pairs near cell edges
                lat, lon = 28.5 + rnd.uniform(0, 0.05), 77.0 + rnd.uniform(0, 0.05)
            recs.append((f"s{s}", str(i % 3), f"v{i:04d}", lat, lon, rnd.random() < 0.8))
    df = spark.createDataFrame(recs, SCHEMA)
    assert rows(bunching.close_vehicles(df)) == brute(df)


def test_grid_method_on_fixture(spark):
    from transitlens.operators import pings as P
    from transitlens.sources import feed, fixtures
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    cleaned = P.clean(feed.positions_for_speed(fixtures.raw_feed(ev)))
    assert rows(bunching.close_vehicles(cleaned)) == brute(cleaned)


def test_null_snapshot_never_pairs(spark):
    df = spark.createDataFrame([
        (None, "1", "a", 28.5, 77.0, True), (None, "1", "b", 28.5, 77.0, True),
        ("s", "1", "c", 28.5, 77.0, True), ("s", "1", "d", 28.5, 77.0, True)], SCHEMA)
    assert rows(bunching.close_vehicles(df)) == [("s", "1", "c"), ("s", "1", "d")]
    flagged = {r["vehicle_id"]: r["is_bunched"] for r in bunching.flag_bunching(df).collect()}
    assert flagged == {"a": False, "b": False, "c": True, "d": True}


def test_salted_hot_cells_equal_all_pairs(spark):
    rnd = random.Random(11)
    recs = []
    for i in range(300):
        # everything inside one coarse cell: with salt_rows=20 it is split over many salts
        lat, lon = 28.6 + rnd.uniform(0, 0.008), 77.2 + rnd.uniform(0, 0.008)
        recs.append(("s", "1", f"v{i:04d}", lat, lon, True))
    df = spark.createDataFrame(recs, SCHEMA)
    p = Params(salt_rows=20)
    assert rows(bunching.close_vehicles(df, p)) == brute(df)


def test_flags_join_without_sorting_the_pings(spark):
    """The flags, one narrow row per key, are hashed; pings without snapshot, route or partner keep one row each."""
    recs = [("s", "1", "a", 28.6, 77.2, True), ("s", "1", "b", 28.6, 77.2, True), ("s", "1", "b", 28.7, 77.2, False),
            (None, "1", "a", 28.6, 77.2, True), ("s", None, "b", 28.6, 77.2, True), ("s", "2", "c", 28.6, 77.2, True)]
    out = bunching.flag_bunching(spark.createDataFrame(recs, SCHEMA))
    assert "strategy=shuffle_hash" in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["is_bunched"] for r in out.collect()) == [False] * 3 + [True] * 3
