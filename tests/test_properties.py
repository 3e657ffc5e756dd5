"""Property tests (hypothesis): the grid bunching method equals the all-pairs
definition, and the haversine expression is symmetric, on generated inputs."""
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_bunching import brute
from transitlens.functions import geo
from transitlens.operators import bunching

SCHEMA = "snapshot_id string, route_id string, vehicle_id string, lat double, lon double, is_moving boolean"

# points inside a ~1.5 km square so that close pairs, dense cells and cell edges all occur
point = st.tuples(st.sampled_from(["s1", "s2"]), st.sampled_from(["1", "2"]),
                  st.integers(0, 25).map(lambda i: f"v{i:02d}"),
                  st.floats(28.60, 28.614, allow_nan=False), st.floats(77.20, 77.214, allow_nan=False),
                  st.booleans())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(point, min_size=2, max_size=60))
def test_grid_equals_all_pairs(spark, pts):
    df = spark.createDataFrame(pts, SCHEMA)
    assert rows(bunching.close_vehicles(df)) == brute(df)


coord = st.tuples(st.floats(-80, 80, allow_nan=False), st.floats(-179, 179, allow_nan=False))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(coord, coord), min_size=1, max_size=40))
def test_haversine_symmetric_and_zero(spark, pairs):
    df = spark.createDataFrame([(a[0], a[1], b[0], b[1]) for a, b in pairs], "a double, b double, c double, d double")
    out = df.select(geo.haversine_m("a", "b", "c", "d").alias("x"), geo.haversine_m("c", "d", "a", "b").alias("y"),
                    geo.haversine_m("a", "b", "a", "b").alias("z")).collect()
    assert all(r["x"] == r["y"] and r["z"] == 0.0 and r["x"] >= 0 for r in out)
