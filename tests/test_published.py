import pytest
from pyspark.sql import functions as F

from transitlens.operators import quality
from transitlens.plans import flow, published
from transitlens.sources.fixtures import Tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def pings(spark):
    return flow.fixture_pings(Tables(spark, SF_SMALL)).filter("is_speed_valid")


def test_failed_gate_writes_nothing(spark, pings, tmp_path):
    root = f"file://{tmp_path}/w"
    with pytest.raises(quality.QualityGateError):
        published.gated_load(spark, root, pings.withColumn("lat", F.lit(-90.0)))
    assert published.current(spark, root) is None and not (tmp_path / "w").exists()
    with pytest.raises(LookupError):
        published.read_table(spark, root, "dim_route")


def test_route_hours_are_computed_once_per_load(spark, pings, tmp_path, monkeypatch):
    """Checks, route dimension, fact and quarantine read the route-hours; none of them may aggregate the pings again."""
    plans, load = [], published.warehouse_build.load

    def loaded(spark, pings, rh, *a):
        plans.append(rh._jdf.queryExecution().optimizedPlan().toString())
        return load(spark, pings, rh, *a)
    monkeypatch.setattr(published.warehouse_build, "load", loaded)
    root = f"file://{tmp_path}/w"
    published.gated_load(spark, root, pings)
    assert len(plans) == 1 and "Aggregate" not in plans[0]
    assert published.read_table(spark, root, "fact_route_hour_speed").agg(F.sum("n_pings")).first()[0] == pings.count()


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_untouched_dates_keep_their_folders(spark, pings, tmp_path, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        root = f"file://{tmp_path}/w"
        published.gated_load(spark, root, pings)
        v1 = published.current(spark, root)
        one = published.read_table(spark, root, "fact_vehicle_ping").agg(F.min("date_key")).first()[0]
        day = pings.filter(F.date_format("service_date", "yyyyMMdd").cast("int") == one)
        out = published.gated_load(spark, root, day.withColumn("trip_id", F.lit("again")))
        v2 = published.current(spark, root)
        assert out["version"] == v2["version"] == v1["version"] + 1
        a, b = (v["tables"]["fact_vehicle_ping"]["paths"] for v in (v1, v2))
        assert {d for d in b if a[d] != b[d]} == {str(one)} and len(a) > 1
        now = published.read_table(spark, root, "fact_vehicle_ping")
        assert now.count() == pings.count()
        assert {r.date_key for r in now.filter("trip_id = 'again'").select("date_key").distinct().collect()} == {one}
        old = published.read_table(spark, root, "fact_vehicle_ping", v1)
        assert old.filter("trip_id = 'again'").count() == 0
        plan = now.filter(F.col("date_key") == one)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(date_key" in plan
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def test_second_of_two_racing_loads_fails_and_torn_commit_counts_as_none(spark, pings, tmp_path):
    root = f"file://{tmp_path}/w"
    published.gated_load(spark, root, pings)
    before = published.current(spark, root)
    published._commit(spark, root, before, before["tables"])
    with pytest.raises(published.LoadConflict):
        published._commit(spark, root, before, before["tables"])
    (tmp_path / "w" / "_commits" / "0000000003").write_text('{"version": 3, "tab')
    assert published.current(spark, root)["version"] == 2
    assert published._commit(spark, root, published.current(spark, root), before["tables"])["version"] == 4


def test_a_writer_stopped_before_its_commit_is_published_loses_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/w"
    first = published._commit(spark, root, None, {"t": "one"})
    # A has written its commit and stops; B, from the same version, goes on and publishes
    a = published._written_commit(spark, root, 2, {"t": "of A"})
    assert published.current(spark, root) == first
    b = published._commit(spark, root, first, {"t": "of B"})
    assert b["version"] == 2 and published.current(spark, root) == b
    with pytest.raises(published.LoadConflict):
        published._published_commit(spark, root, first, 2, a)
    assert published.current(spark, root) == b
    # a number that is taken can't be taken again, even by a writer that saw no newer version
    c = published._written_commit(spark, root, 2, {"t": "of C"})
    with pytest.raises(published.LoadConflict):
        published._published_commit(spark, root, b, 2, c)
    assert published.current(spark, root) == b
    # the other way round: B finds the number free as long as A has not published
    assert published._commit(spark, root, b, {"t": "next"})["version"] == 3


def test_a_batch_of_sums_counts_once(spark, tmp_path):
    root = f"file://{tmp_path}/w"

    def batch(*some):
        return spark.createDataFrame(list(some), "date_key int, route_id string, n long, spare string")

    def add(rows, batch_id, source="s"):
        return published.add_batch(spark, root, "totals", rows, ["route_id"], ["n"], source, batch_id)
    one = add(batch((20260101, "a", 1, "x"), (20260101, "a", 2, "y"), (20260102, None, 4, None)), 0)
    two = add(batch((20260101, "a", 5, "x"), (20260101, "b", None, "x")), 1)
    for again in (0, 1):
        assert add(batch((20260101, "a", 100, "x")), again) == two
    assert {d for d, p in two["tables"]["totals"]["paths"].items() if one["tables"]["totals"]["paths"].get(d) != p} == {"20260101"}
    assert add(batch(), 2)["applied"] == {"s": 2}
    assert add(batch((20260102, None, 1, "x")), 0, "other")["applied"] == {"s": 2, "other": 0}
    got = {(r.date_key, r.route_id): r.n for r in published.read_table(spark, root, "totals").collect()}
    assert got == {(20260101, "a"): 8, (20260101, "b"): 0, (20260102, None): 5}


def test_lookup_of_a_route_reads_its_dates_and_row_groups(spark, pings, tmp_path):
    from transitlens.plans import reports
    root = f"file://{tmp_path}/w"
    published.gated_load(spark, root, pings)
    days = sorted(int(d) for d in published.current(spark, root)["tables"]["fact_vehicle_ping"]["paths"])
    wh = published.open_route(spark, root, "1", 18, first=days[1], last=days[1])
    for fact in (wh.fact_ping, wh.fact_route_hour):
        assert fact.inputFiles() and all(f"date_key={days[1]}/" in f for f in fact.inputFiles())
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(route_key," in plan and "EqualTo(hour_key,18)" in plan
    whole = published.open_warehouse(spark, root)
    some = published.open_route(spark, root, "1")

    def of(w, **kw):
        return sorted(map(tuple, reports.route_speed(w, "1", **kw).collect()))
    assert of(some) == of(whole) and of(some)
    assert of(wh, hour=18, min_moving=1) == [r for r in of(whole, hour=18, min_moving=1) if r[1].replace("-", "") == str(days[1])]
    assert reports.route_speed(published.open_route(spark, root, "no such route"), "no such route").count() == 0
