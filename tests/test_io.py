import json

from pyspark.sql import functions as F

from transitlens import schemas
from transitlens.operators import quality as Q
from transitlens.sources import feed


def test_bom_header_is_stripped(spark, tmp_path):
    p = tmp_path / "trips.txt"
    p.write_bytes("﻿route_id,trip_id\n 7 ,T1\n8,T2\n".encode("utf-8"))
    df = feed.read_csv_bom_safe(spark, str(p))
    assert df.columns == ["route_id", "trip_id"]
    assert sorted(r["trip_id"] for r in df.collect()) == ["T1", "T2"]


def test_json_array_snapshots_and_static_reader(spark, tmp_path):
    snap = tmp_path / "raw" / "vehicle_positions_1.json"
    snap.parent.mkdir()
    recs = [{"entity_id": "e1", "vehicle_id": "V1", "route_id": " 12 ", "trip_id": "12_08_30", "latitude": 28.6,
             "longitude": 77.2, "speed": 0.0, "vehicle_timestamp": 1767250000, "fetched_at": "2026-01-01T06:00:00+00:00"},
            {"entity_id": "e2", "vehicle_id": "V2", "vehicle_timestamp": 1767250001, "fetched_at": "2026-01-01T06:00:00+00:00"}]
    snap.write_text(json.dumps(recs, indent=2))
    pos = feed.positions_for_speed(feed.read_snapshots(spark, str(snap.parent)))
    got = {r["vehicle_id"]: r for r in pos.collect()}
    assert got["V1"]["route_id"] == "12" and got["V2"]["lat"] is None
    st = tmp_path / "static"
    st.mkdir()
    (st / "stop_times.txt").write_text("trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT1,25:10:00,25:10:00,S1,1\nT1,,,S2,x\n")
    (st / "stops.txt").write_text("stop_id,stop_name,stop_lat,stop_lon\nS1,One,28.6,77.2\n")
    (st / "trips.txt").write_text("﻿route_id,trip_id\nR1,T1\n", encoding="utf-8")
    (st / "routes.txt").write_text("route_id,route_short_name,route_long_name\nR1,1,Route One\n")
    stop_times, stops, trips, routes = (feed.read_static(spark, str(st))[t] for t in ("stop_times", "stops", "trips", "routes"))
    assert sorted((r["stop_id"], r["stop_sequence"], r["sched_arrival_sec"]) for r in stop_times.collect()) == [
        ("S1", 1, 90600), ("S2", None, None)]
    assert trips.first()["trip_id"] == "T1"


def test_land_raw_rejects_empty_and_partitions(spark, tmp_path):
    import pytest
    empty = spark.createDataFrame([], schemas.RAW)
    with pytest.raises(feed.EmptyBatchError):
        feed.land_raw(empty, str(tmp_path / "x"))
    one = spark.createDataFrame([("e", "V", "1", "1_00_00", 28.6, 77.2, 0.0, 1767250000, "2026-09-19T10:00:00+00:00")], schemas.RAW)
    assert feed.land_raw(one, str(tmp_path / "raw")) == 1
    assert (tmp_path / "raw" / "year=2026" / "month=09" / "day=19").is_dir()
    assert len(schemas.RAW.fields) == 9


def test_quality_report_and_prompt_sinks(spark, tmp_path):
    res = Q.run_suite(spark.createDataFrame([(1,)], "k int"), "t", [Q.row_count_at_least(1)])
    Q.write_report(res, str(tmp_path / "reports"))
    back = spark.read.json(str(tmp_path / "reports"))
    assert back.count() == 1 and back.first()["success"]
    from transitlens.plans import reports
    reports.save_prompt(spark.createDataFrame([("line 1\nline 2",)], "prompt string"), str(tmp_path / "prompt"))
    assert spark.read.text(str(tmp_path / "prompt")).count() == 2


def test_run_speed_job_writes_partitions_with_observed_counts(spark, tmp_path):
    from transitlens.plans import flow
    from transitlens.sources import fixtures
    raw = fixtures.raw_feed(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    m = flow.run_speed_job(spark, raw, str(tmp_path / "out"))
    assert m == {"pings": 978, "valid_speed": 236, "route_hours": 379}
    back = spark.read.parquet(str(tmp_path / "out" / "route_hour_speed"))
    assert dict(back.dtypes)["service_date"] == "date" and back.count() == 379


def test_publish_stages_then_replaces(spark, tmp_path):
    from transitlens.operators import warehouse as W
    t = {"dim_x": spark.createDataFrame([(1, "a")], "k int, v string"),
         "fact_route_hour_speed": spark.createDataFrame([(20260101, 1), (20260102, 2)], "date_key int, n int")}
    assert W.publish(spark, t, str(tmp_path), "run1") == {"dim_x": 1, "fact_route_hour_speed": 2}
    t2 = {"fact_route_hour_speed": spark.createDataFrame([(20260102, 5)], "date_key int, n int")}
    W.publish(spark, t2, str(tmp_path), "run2")
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "fact_route_hour_speed")).select("date_key", "n").collect())
    assert got == [(20260101, 1), (20260102, 5)]
    nan = spark.createDataFrame([(float("nan"), 1.0)], "a double, b double")
    assert W.nan_to_null(nan).first()["a"] is None


def test_split_records_keeps_every_line_on_one_side(spark):
    from transitlens.sources import feed
    good = ['{"entity_id": "1", "vehicle_id": "v", "latitude": 28.5}', '{"entity_id": "2"}']
    bad = ['{"entity_id": "3", "vehi', 'no json', '{"entity_id": "4", "latitude": "north"}', '[1, 2']
    lines = spark.createDataFrame([(x,) for x in [*good, *bad, "", "  "]], "value string")
    records, quarantine = feed.split_records(lines)
    assert sorted(r["entity_id"] for r in records.collect()) == ["1", "2"]
    assert sorted(r["line"] for r in quarantine.collect()) == sorted(bad)
    assert quarantine.count() == 4 and records.columns == [f.name for f in __import__("transitlens.schemas", fromlist=["RAW"]).RAW.fields]


def test_arrays_keep_whole_records_and_name_what_is_damaged(spark, tmp_path):
    good = '{"entity_id":"1","vehicle_id":"V1","latitude":28.5,"vehicle_timestamp":5}'
    (tmp_path / "a.json").write_text(f'[{good},\n {{"entity_id":"2","latitude":"n/a"}}, {{"entity_id":"3","vehicle_timestamp":1.5}}, {{}}]')
    (tmp_path / "b.json").write_text(f'[{good}, {{"entity_id":"4", "lat')
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_bytes(b"\xef\xbb\xbf" + f"[{good}]".encode())
    records, bad, files = feed.split_arrays(spark, str(tmp_path))
    assert records.schema.names == feed.schemas.RAW.names
    assert sorted((r.entity_id or "", r.latitude, r.vehicle_timestamp) for r in records.collect()) == [
        ("", None, None), ("1", 28.5, 5), ("1", 28.5, 5)]
    assert sorted((r.entity_id, r.file.rsplit("/", 1)[1]) for r in bad.collect()) == [("2", "a.json"), ("3", "a.json")]
    assert [r.file.rsplit("/", 1)[1] for r in files.collect()] == ["b.json"]


def test_arrays_are_read_once_whatever_numbers_they_hold(spark, tmp_path):
    record = '{"entity_id":"%d","vehicle_id":"V1","route_id":7.10,"latitude":28.5,"longitude":77.25,"speed":0.0,"vehicle_timestamp":%d}'
    (tmp_path / "a.json").write_text("[" + ",\n".join(record % (i, i) for i in range(2000)) + "]")
    size = (tmp_path / "a.json").stat().st_size
    read = lambda: sum(x.getBytesRead() for x in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    records, bad, files = feed.split_arrays(spark, str(tmp_path))
    before = read()
    got = records.collect()
    assert read() - before < 3 * size                 # a file opened again for every number gives many times its size
    assert sorted(r.vehicle_timestamp for r in got) == list(range(2000)) and {r.route_id for r in got} == {"7.10"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size // 5)      # the splits of a file do not cut its array
    try:
        assert [x.count() for x in feed.split_arrays(spark, str(tmp_path))] == [2000, 0, 0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_lines_of_another_width_are_quarantined(spark, tmp_path):
    for i, bom in enumerate((b"\xef\xbb\xbf", b"")):
        (tmp_path / f"{i}.txt").write_bytes(bom + f'a,b\n{i},"x, y"\n\n1,2,3\n4\n5,\n'.encode())
    rows_, bad = feed.split_csv(spark, str(tmp_path))
    assert rows_.columns == ["a", "b"]
    assert sorted((r.a, r.b) for r in rows_.collect()) == [("0", "x, y"), ("1", "x, y"), ("5", None), ("5", None)]
    assert sorted(r.line for r in bad.collect()) == ["1,2,3", "1,2,3", "4", "4"]
