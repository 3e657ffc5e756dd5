import math

from pyspark.sql import functions as F

from transitlens.functions import fmt, geo, timefn


def test_haversine_zero_symmetry_and_meridian(spark):
    df = spark.createDataFrame([(28.5, 77.1, 28.5, 77.1), (28.5, 77.1, 28.6, 77.2), (28.6, 77.2, 28.5, 77.1),
                                (28.0, 77.0, 29.0, 77.0)], "a double, b double, c double, d double")
    out = [r[0] for r in df.select(geo.haversine_m("a", "b", "c", "d")).collect()]
    assert out[0] == 0.0
    assert out[1] == out[2]
    assert math.isclose(out[3], 6371000.0 * math.radians(1.0), rel_tol=1e-12)


def test_fine_cell_members_are_close(spark):
    g = geo.fine_cell_deg(300.0)
    # opposite corners of one cell, at the box's southern edge (widest cells)
    df = spark.createDataFrame([(28.0, 76.5, 28.0 + g * 0.999999, 76.5 + g * 0.999999)], "a double, b double, c double, d double")
    d = df.select(geo.haversine_m("a", "b", "c", "d")).first()[0]
    assert d < 300.0 * 0.96


def test_reach_bounds_cover_300m(spark):
    df = spark.createDataFrame([(28.5,), (60.0,), (-45.0,)], "lat double")
    dlat, dlon = geo.reach_deg(F.col("lat"), 300.0)
    for lat, a, b in df.select("lat", dlat, dlon).collect():
        assert a >= math.degrees(300.0 / 6371000.0)
        # a point due east at exactly the lon reach is at least 300 m away
        east = math.radians(b)
        hav = math.cos(math.radians(lat)) ** 2 * math.sin(east / 2) ** 2
        assert 2 * 6371000.0 * math.asin(math.sqrt(hav)) >= 300.0


def test_gtfs_seconds_tolerant(spark):
    df = spark.createDataFrame([("25:10:00",), ("00:00:01",), ("",), (None,), ("7:5",), ("aa:00:00",)], "t string")
    out = [r[0] for r in df.select(timefn.gtfs_seconds("t")).collect()]
    assert out == [25 * 3600 + 600, 1, None, None, None, None]


def test_trip_part(spark):
    df = spark.createDataFrame([("10",), ("10_5",), ("10_aa_30",), (None,), ("3_08_45_2",)], "t string")
    out = df.select(timefn.trip_part("t", 1), timefn.trip_part("t", 2)).collect()
    assert [tuple(r) for r in out] == [(None, None), (5, None), (None, 30), (None, None), (8, 45)]


def test_local_time_is_session_zone_independent(spark):
    epoch = 1767225600 + 18 * 3600 + 45 * 60   # 2026-01-01 18:45Z = 2026-01-02 00:15 +05:30
    df = spark.createDataFrame([(epoch,)], "e long")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        r = df.select(timefn.local_date("e", "Asia/Kolkata").cast("string"), timefn.local_hour("e", "Asia/Kolkata"),
                      timefn.local_dow("e", "Asia/Kolkata")).first()
        assert tuple(r) == ("2026-01-02", 0, 6)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    m = spark.createDataFrame([("2026-01-02",)], "d string").select(
        timefn.local_midnight_epoch(F.to_date("d"), "Asia/Kolkata")).first()[0]
    assert m == 1767225600 + 86400 - 19800


def test_formatting(spark):
    df = spark.range(24).select(fmt.hour_label("id").alias("l"), fmt.day_part("id").alias("p"))
    got = df.collect()
    assert got[0]["l"] == "00:00-00:59" and got[18]["l"] == "18:00-18:59"
    assert [r["p"] for r in got][:7] == ["Night"] * 6 + ["Morning peak"]
    assert got[11]["p"] == "Midday" and got[20]["p"] == "Evening peak" and got[21]["p"] == "Late evening"


def test_dec_round_half_up(spark):
    df = spark.createDataFrame([(3.015,), (3.0149999999999997,), (1.005,), (None,)], "x double")
    out = [r[0] for r in df.select(fmt.dec_round("x", 2)).collect()]
    assert out == [3.02, 3.02, 1.01, None]
