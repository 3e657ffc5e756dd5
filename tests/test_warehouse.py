import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from transitlens.operators import warehouse as W


def test_dim_date_and_hour(spark):
    d = W.dim_date(spark)
    assert d.count() == 1096
    r = d.filter(F.col("full_date") == F.lit(dt.date(2026, 9, 19))).first()
    assert (r["date_key"], r["day_of_week"], r["day_name"], r["is_weekend"]) == (20260919, 7, "Saturday", True)
    h = W.dim_hour(spark).orderBy("hour_key").collect()
    assert len(h) == 24 and h[18]["hour_label"] == "18:00-18:59" and h[18]["day_part"] == "Evening peak"


def test_assign_keys_consecutive_across_partitions(spark):
    ids = spark.range(0, 5000, numPartitions=7).select(F.format_string("id%05d", "id").alias("x"))
    out = W.assign_keys(ids, "x", "k", base=10).orderBy("x").collect()
    assert [r["k"] for r in out] == list(range(11, 5011))
    assert [r["x"] for r in out] == sorted(r["x"] for r in out)


def test_upsert_dim_keeps_keys_and_appends(spark):
    dim = W.upsert_dim(W.empty_dim_vehicle(spark), spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "vehicle_id string"),
                       "vehicle_id", "vehicle_key")
    assert rows(dim, "vehicle_key", "vehicle_id") == [(1, "a"), (2, "b")]
    dim2 = W.upsert_dim(dim, spark.createDataFrame([("c",), ("a",), ("0",)], "vehicle_id string"), "vehicle_id", "vehicle_key")
    assert rows(dim2, "vehicle_key", "vehicle_id") == [(1, "a"), (2, "b"), (3, "0"), (4, "c")]


def test_merge_partial_columns_and_idempotence(spark):
    t = spark.createDataFrame([(1, "x", 10.0, "old"), (2, "y", 20.0, "old")], "k int, keep string, upd double, tag string")
    s = spark.createDataFrame([(2, "Y", 21.0, "new"), (3, "z", 30.0, "new")], "k int, keep string, upd double, tag string")
    m = W.merge(t, s, ["k"], update_cols=["upd", "tag"])
    assert rows(m) == [(1, "x", 10.0, "old"), (2, "y", 21.0, "new"), (3, "z", 30.0, "new")]
    assert rows(W.merge(m, s, ["k"], update_cols=["upd", "tag"])) == rows(m)
    full = W.merge(t, s, ["k"])
    assert rows(full) == [(1, "x", 10.0, "old"), (2, "Y", 21.0, "new"), (3, "z", 30.0, "new")]


def test_upsert_table_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    a = spark.createDataFrame([(1, "d1", 1.0), (2, "d1", 2.0), (3, "d2", 3.0)], "k int, day string, v double")
    W.upsert_table(spark, path, a, ["k"], "day")
    b = spark.createDataFrame([(2, "d1", 20.0), (4, "d3", 4.0)], "k int, day string, v double")
    n = W.upsert_table(spark, path, b, ["k"], "day")
    assert n == 3  # d1 (2 rows) and d3 (1 row) were rewritten, d2 untouched
    got = rows(spark.read.parquet(path), "k", "day", "v")
    assert got == [(1, "d1", 1.0), (2, "d1", 20.0), (3, "d2", 3.0), (4, "d3", 4.0)]
    W.upsert_table(spark, path, b, ["k"], "day")
    assert rows(spark.read.parquet(path), "k", "day", "v") == got          # idempotent


def test_fact_quarantine_for_unknown_keys(spark):
    rh = spark.createDataFrame([("r1", dt.date(2026, 1, 2), 5, 6, 1, 1, 1, 1, 5.0, 5.0, 0),
                                ("r9", dt.date(2026, 1, 2), 5, 6, 1, 1, 1, 1, 5.0, 5.0, 0),
                                ("r1", dt.date(1970, 1, 1), 5, 6, 1, 1, 1, 1, 5.0, 5.0, 0)],
                               "route_id string, service_date date, hour_of_day int, day_of_week int, n_pings long, "
                               "n_vehicles long, n_speed_obs long, n_moving long, avg_speed_kmph double, "
                               "avg_moving_speed_kmph double, n_bunched long")
    dr = W.upsert_dim(W.empty_dim_route(spark), spark.createDataFrame([("r1",)], "route_id string"), "route_id", "route_key")
    facts, q = W.fact_route_hour(rh, dr, W.dim_date(spark))
    assert facts.count() == 1 and q.count() == 2


def test_reconcile_detects_differences(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    assert rows(W.reconcile(a, b)) == [(2, "y", "left_only"), (3, "z", "right_only")]
    assert W.reconcile(a, a).count() == 0


def test_write_partitioned_clusters_and_keeps_rows(spark, tmp_path):
    df = spark.range(0, 2000, numPartitions=5).select(
        (F.col("id") % 3).alias("d"), (F.col("id") % 24).alias("h"), F.col("id").alias("v"))
    W.write_partitioned(df, str(tmp_path / "t"), "d", ["h"])
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 2000 and back.select("d").distinct().count() == 3


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_upsert_keeps_what_other_writers_did(spark, tmp_path, mode):
    was = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        path, schema = str(tmp_path / "t"), "k int, v int, day string"
        W.upsert_table(spark, path, spark.createDataFrame([(1, 1, "d1"), (2, 1, "d2")], schema), ["k"], "day")
        W.upsert_table(spark, path, spark.createDataFrame([(1, 5, "d1")], schema), ["k"], "day")
        (spark.createDataFrame([(1, 99, "d1")], schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").parquet(path))                                        # another writer
        n = W.upsert_table(spark, path, spark.createDataFrame([(2, 7, "d2"), (3, 8, "d2")], schema), ["k"], "day")
        assert n == 2
        assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, 99), (2, 7), (3, 8)]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", was)


def test_reconcile_by_digest_equals_reconcile(spark):
    import random
    rng = random.Random(5)
    a = [(i, rng.choice([None, 1, 2]), rng.choice([None, 0.5, -0.0])) for i in range(3000)] + [(7, 1, 0.5)] * 40 + [(None, None, 1.0)]
    b = [r for r in a if r[0] is None or r[0] % 301] + [(7, 1, 0.5)] * 2 + [(5000, 1, 1.0)] + [(11, None, 9.0), (None, 1, None)]
    schema = "k long, x int, y double"
    l, r = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    want = sorted(map(str, W.reconcile(l, r).collect()))
    for levels in ((2, 3), (8, 8, 8)):
        assert sorted(map(str, W.reconcile_by_digest(l, r, ["k"], levels).collect())) == want
    assert len(want) > 10
    swapped = spark.createDataFrame([(1, None, 2.0)], schema), spark.createDataFrame([(1, 2, None)], schema)
    assert W.reconcile_by_digest(*swapped, ["k"]).count() == 2
    assert W.reconcile_by_digest(l, l, ["k"]).count() == 0 and W.reconcile_by_digest(l.limit(0), r, ["k"]).count() == len(b)
