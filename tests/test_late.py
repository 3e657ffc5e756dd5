"""Late and out-of-order reports in a stream."""
import json

import pytest
from pyspark.sql import functions as F

from transitlens.streaming import late, stream as S


def run(spark, tmp_path, files, **kw):
    """files: lists of (vehicle, epoch, fetched seconds), landed one file after the other."""
    import os
    src = tmp_path / "in"
    src.mkdir()
    for i, rows in enumerate(files):
        path = src / f"f{i:03d}.json"
        path.write_text("\n".join(json.dumps({
            "vehicle_id": v, "route_id": "r", "trip_id": "t", "latitude": 28.5 + (e % 100) / 1000, "longitude": 77.0, "speed": 0.0,
            "vehicle_timestamp": e, "fetched_at": str(a), "entity_id": "x"}) for v, e, a in rows))
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
    s = late.reordered(S.positions(S.snapshot_stream(spark, str(src), max_files=1)), F.col("snapshot_id").cast("long"), clock_delay="0 seconds", **kw)
    S.run_available_now(s, S.idempotent_sink(str(tmp_path / "out")), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out")).filter("vehicle_id <> 'end'")
    return sorted(tuple(r) for r in got.select("kind", "vehicle_id", "obs_epoch", "n_reports", "gap_s").fillna(-1).collect())


T0 = 1_800_000_000
END = [[("end", T0 + 9_000_000, T0 + 9_000_000)]]


def test_reports_leave_in_order_and_late_ones_are_counted(spark, tmp_path):
    files = [[("a", T0, T0), ("b", T0 + 5, T0 + 10)],
             [("a", T0 + 300, T0 + 310)],
             [("a", T0 + 100, T0 + 311), ("a", T0 + 300, T0 + 312)],      # out of order, within the bound, and a copy
             [("a", T0 + 50, T0 + 2000), ("b", T0 + 1990, T0 + 2001)],       # late
             [("b", T0 + 1500, T0 + 2100)]] + END
    got = run(spark, tmp_path, files, bound_s=1000)
    assert got == [("late", "a", T0 + 50, 1, -1), ("on_time", "a", T0, 1, -1), ("on_time", "a", T0 + 100, 1, 100), ("on_time", "a", T0 + 300, 2, 200),
                   ("on_time", "b", T0 + 5, 1, -1), ("on_time", "b", T0 + 1500, 1, 1495), ("on_time", "b", T0 + 1990, 1, 490)]


@pytest.mark.parametrize("expire,gap", [(10_000, 4000), (1000, -1)])
def test_state_of_silent_vehicles_expires(spark, tmp_path, expire, gap):
    files = [[("a", T0, T0)], [("c", T0 + 3000, T0 + 3000)], [("c", T0 + 3500, T0 + 3500)], [("a", T0 + 4000, T0 + 4000)]] + END
    got = run(spark, tmp_path, files, bound_s=100, expire_s=expire)
    assert ("on_time", "a", T0 + 4000, 1, gap) in got and len(got) == 4


def test_vehicles_of_a_group_keep_their_own_state(spark, tmp_path):
    files = [[(f"v{i}", T0 + 7 * i + 60 * k, T0 + 600 * n) for i in range(20)] for n, k in enumerate((0, 3, 1, 2))] + END
    got = []
    for groups in (1, 3, 1024):
        (tmp_path / str(groups)).mkdir()
        got.append(run(spark, tmp_path / str(groups), files, bound_s=1700, expire_s=5000, groups=groups))
    assert got[0] == got[1] == got[2]
    assert got[0] == sorted(("on_time", f"v{i}", T0 + 7 * i + 60 * k, 1, 60 if k else -1) for i in range(20) for k in range(4))


def test_more_records_of_a_chunk_give_no_more_files_than_asked(spark, tmp_path):
    raw = spark.range(400).select((F.col("id") % 40).cast("string").alias("vehicle_id"), F.col("id"), F.floor(F.col("id") / 200).alias("c"))
    assert S.land_in_time_order(raw, str(tmp_path / "in"), "c", most_files=3, file_rows=20) == 2
    files = sorted((tmp_path / "in").glob("*.json"))
    assert len(files) <= 6
    rows = [[json.loads(x) for x in f.read_text().splitlines()] for f in files]
    assert sorted(r["id"] for f in rows for r in f) == list(range(400))
    assert len({(r["vehicle_id"], r["id"] // 200) for f in rows for r in f}) == sum(len({(r["vehicle_id"], r["id"] // 200) for r in f}) for f in rows)
