import pytest

from transitlens.operators import quality as Q


def test_suite_semantics(spark):
    df = spark.createDataFrame(
        [(1, 10.0, "a", True), (2, None, "a", False), (3, 90.0, "b", True), (3, 50.0, None, None)],
        "k int, speed double, g string, f boolean")
    checks = [Q.row_count_at_least(1), Q.not_null("g"), Q.between("speed", 0, 80), Q.between("speed", 0, 80, mostly=0.6),
              Q.in_set("f", (True, False)), Q.unique("k"), Q.pair_ge("speed", "k")]
    res = {r["check_no"]: r for r in Q.run_suite(df, "t", checks).collect()}
    assert res[0]["success"] and res[0]["element_count"] == 4
    assert not res[1]["success"] and res[1]["unexpected_count"] == 1 and res[1]["unexpected_pct"] == 25.0
    assert not res[2]["success"] and res[2]["unexpected_count"] == 1
    assert abs(res[2]["unexpected_pct"] - 33.3333) < 1e-9       # relative to non-null values
    assert res[3]["success"]                                      # 2/3 >= 0.6
    assert res[4]["success"]                                      # null ignored
    assert not res[5]["success"] and res[5]["unexpected_count"] == 2   # both members of the duplicate
    assert res[6]["success"]


def test_gate_raises_and_passes(spark):
    ok = spark.createDataFrame([(1,)], "k int")
    assert len(Q.gate(Q.run_suite(ok, "t", [Q.row_count_at_least(1), Q.unique("k")]))) == 2
    empty = spark.createDataFrame([], "k int")
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.run_suite(empty, "t", [Q.row_count_at_least(1)]))


def test_fixture_speed_check_fails_by_design(spark):
    from transitlens.plans import flow
    from transitlens.sources.fixtures import Tables
    pings = flow.fixture_pings(Tables(spark, "/root/testdata/sf0.01"))
    res = Q.run_suite(pings, "p", Q.pings_suite())
    failed = [r["check_id"] for r in res.collect() if not r["success"]]
    assert failed == ["speed_kmph_between_0_80.0_mostly_0.95"]
    assert all(r["success"] for r in Q.run_suite(pings.filter("is_speed_valid"), "p", Q.pings_suite()).collect())


def test_failing_keys_are_the_smallest_and_bounded(spark):
    rows = [(f"v{i:03d}" if i % 4 else None, float(i), i // 2) for i in range(100)] + [("v001", 1.0, 0)] * 50
    df = spark.createDataFrame(rows, "a string, x double, g int")
    checks = [Q.row_count_at_least(1), Q.not_null("a"), Q.between("x", 5, 90), Q.pair_ge("x", "g"), Q.unique("a", "x")]
    got = {r["check_no"]: r["keys"] for r in Q.failing_keys(df, checks, ["g", "x"], k=3).collect()}
    bad = {1: {f"{g}|{x}" for a, x, g in rows if a is None}, 2: {f"{g}|{x}" for _, x, g in rows if not 5 <= x <= 90}}
    assert got == {1: ",".join(sorted(bad[1])[:3]), 2: ",".join(sorted(bad[2])[:3]), 4: "v001|1.0"}
    out = Q.run_suite_with_keys(df, "d", checks, ["g", "x"], 3)
    assert out.count() == 5 and out.filter("keys is not null").count() == 3
    assert Q.failing_keys(df.limit(0), checks, ["g", "x"]).collect() == []
