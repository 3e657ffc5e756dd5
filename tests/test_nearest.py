"""Nearest stop by rings against the full fan-out, quantiles by rank against numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from transitlens.operators import delays, nearest

POS = "vehicle_id string, obs_epoch long, trip_id string, route_id_rt string, lat double, lon double, speed double"
TIMES = "trip_id string, stop_id string, stop_sequence int, sched_arrival_sec long"
STOPS = "stop_id string, stop_name string, stop_lat double, stop_lon double"


def both(spark, pos, times, stops, **kw):
    pos, times, stops = spark.createDataFrame(pos, POS), spark.createDataFrame(times, TIMES), spark.createDataFrame(stops, STOPS)
    cols = ["vehicle_id", "obs_epoch", "trip_id", "stop_id", "stop_sequence", "sched_arrival_sec", "stop_name", "dist_to_stop_m"]
    full = delays.nearest_stop(delays.candidates(pos, times, stops)).select(*cols).collect()
    ring = nearest.nearest_by_rings(pos, times, stops, **kw).select(*cols).collect()
    return sorted(map(str, full)), sorted(map(str, ring))


@pytest.mark.parametrize("centre,spread", [((28.6, 77.2), 0.05), ((0.0, 179.99), 0.05), ((89.9, 10.0), 0.2), ((28.6, 77.2), 0.0005)])
def test_rings_find_what_the_fan_out_finds(spark, centre, spread):
    rng = np.random.default_rng(int(centre[0] * 10) + int(spread * 1e4))
    def point():
        lat, lon = centre[0] + spread * rng.normal(), centre[1] + spread * rng.normal()
        return float(lat), float((lon + 180) % 360 - 180)
    stops = [(f"s{i}", f"n{i}", *point()) for i in range(120)] + [("far", "f", -centre[0], 5.0), ("no", "x", None, 1.0), ("twin", "t", 28.6, 77.2), ("twin2", "t", 28.6, 77.2)]
    times = [(f"t{i % 3}", s[0], int(i % 40), int(i) if i % 11 else None) for i, s in enumerate(stops)] + [("t1", "s0", 3, 9), ("lone", "far", 1, 5), ("none", "no", 1, 5)]
    pos = [(f"v{i}", i, f"t{(i % 5) % 3}", "r", *point(), 0.0) for i in range(150)]
    pos += [("v", 900, "lone", None, *point(), None), ("v", 901, "none", None, *point(), None), ("v", 902, "unknown", None, 1.0, 1.0, 0.0),
            ("v", 903, "t1", None, 28.6, 77.2, 0.0), ("v", 904, "t0", None, 95.0, 10.0, 0.0)]
    full, ring = both(spark, pos, times, stops)
    assert len(full) >= 152 and ring == full


def test_candidates_of_a_ping_do_not_grow_with_its_trip(spark, monkeypatch):
    rng = np.random.default_rng(5)
    def run(n):
        at = [(28.6 + 0.01 * float(y), 77.2 + 0.01 * float(x)) for y, x in rng.random((n, 2))]
        stops = [(f"s{i}", "n", *q) for i, q in enumerate(at)]
        times = [("t", f"s{i}", i % 7, i) for i in range(n)]
        pos = [(f"v{i}", i, "t", "r", 28.6 + 0.01 * float(y), 77.2 + 0.01 * float(x), 0.0) for i, (y, x) in enumerate(rng.random((30, 2)))]
        pos, times, stops = spark.createDataFrame(pos, POS), spark.createDataFrame(times, TIMES), spark.createDataFrame(stops, STOPS)
        full = delays.nearest_stop(delays.candidates(pos, times, stops)).select("obs_epoch", "stop_id").collect()
        most = []
        with monkeypatch.context() as m:
            m.setattr(nearest.delays, "nearest_stop", lambda cand, *a: (most.append(cand.count()), nearest_stop(cand, *a))[1])
            ring = nearest.nearest_by_rings(pos, times, stops).select("obs_epoch", "stop_id").collect()
        assert sorted(ring) == sorted(full) and len(ring) == 30
        return max(most)
    nearest_stop = delays.nearest_stop
    small, large = run(2000), run(20000)
    assert large < 3 * small and large < 30 * 40


def test_reports_of_one_key_that_differ_are_one_row(spark):
    stops = [(f"s{i}", "n", 28.6 + 0.00002 * i, 77.2) for i in range(300)] + [(f"z{i}", "n", 28.7 + 0.001 * i, 77.2) for i in range(40)] + [("q", "n", 28.6001, 77.2001)]
    times = [("long", f"s{i}", 1, 5) for i in range(300)] + [("wide", f"z{i}", 2, 6) for i in range(40)] + [("short", "q", 3, 7)]
    pos = [("v", 1, t, "r", lat, 77.2001, 0.0) for t in ("long", "wide", "short") for lat in (28.6001, 28.65, 28.7)]
    pos += [("w", 2, "long", "r", 28.63, 77.2, 0.0), ("w", 2, "wide", "r", 28.7001, 77.2, 0.0), (None, 3, "long", "r", 28.6, 77.2, 0.0),
            ("x", 4, "short", "r", 28.6, 77.2, 0.0), ("x", 4, "long", "r", 28.6, 77.2, 0.0), ("x", 4, "long", "r", 28.6, 77.2, 0.0)]
    full, ring = both(spark, pos, times, stops)
    assert ring == full and len(ring) == 4


def test_rings_with_a_stop_beyond_the_pole_and_empty_inputs(spark):
    pos = [(f"v{i}", i, "t", "r", 80.0, 10.0 + i, 0.0) for i in range(5)]
    times, stops = [("t", "a", 1, 5), ("t", "b", 2, 6)], [("a", "a", 100.0, 10.0), ("b", "b", 80.0, 12.0)]
    full, ring = both(spark, pos, times, stops)
    assert ring == full and len(ring) == 5
    for empty in ((pos, [], stops), ([], times, stops), (pos, times, [])):
        full, ring = both(spark, *empty)
        assert full == ring == []


def test_settled_pings_leave_after_their_ring(spark):
    pos = spark.createDataFrame([("v", 1, "t", "r", 28.5, 77.0, 0.0), ("v", 2, "t", "r", 29.5, 77.0, 0.0)], POS)
    table = spark.createDataFrame([("t", "a", 1, 5, "a", 28.501, 77.0)], "trip_id string, stop_id string, stop_sequence int, sched_arrival_sec long, stop_name string, stop_lat double, stop_lon double")
    assert [r["obs_epoch"] for r in nearest._ring(pos, table, 250.0).collect()] == [1]
    bad = nearest.malformed_stops(spark.createDataFrame([("t", "a", 1, None), ("t", "b", 1, 5), ("u", "b", 1, 5)], TIMES),
                                  spark.createDataFrame([("a", "a", 1.0, 1.0), ("b", "b", None, 1.0)], STOPS))
    assert sorted(map(tuple, bad.collect())) == [("t", 2), ("u", 1)]


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_quantiles_by_rank(spark, n):
    rng = np.random.default_rng(n)
    x = np.round(np.concatenate([rng.normal(0, 500, n), np.full(n // 3, 12.5), rng.normal(1e7, 5, n // 5)]), 2)
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    got = delays.quantiles_by_rank(df, F.col("x"), qs, dp=2, bins=16)
    assert np.allclose(got, np.quantile(x, qs), atol=1e-6, rtol=0)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, None)], "delay_min double, dist_to_stop_m double")
    assert [tuple(r) for r in delays.delay_quantiles(df).select("delay_min", "dist_to_stop_m").collect()] == [(None, None)] * 5
