"""The incremental job against one run over all reports."""
import random

from transitlens import schemas
from transitlens.operators import metrics
from transitlens.plans import flow, incremental, published
from tests.conftest import rows

START = 1767225600
DAY = 86_400


def reports(seed, n=260):
    """Few vehicles on two routes over five days, close together, many of them repeated in later snapshots."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        epoch = START + r.randrange(0, 5 * DAY // 60) * 60
        lat, lon = 28.60 + r.randrange(0, 8) * 0.001, 77.20 + r.randrange(0, 8) * 0.001
        route, vehicle = r.choice(["1", "2", None]), f"V{r.randrange(6)}"
        for later in range(1 + (i % 5 == 0)):
            out.append((str(i), vehicle, route, f"{route}_08_15", lat, lon, 0.0, epoch, r.choice([str(epoch // 1800 + later), str(epoch // 1800 + later), None])))
    return out


def frame(spark, some):
    return spark.createDataFrame(some, schemas.RAW)


def both(spark, root, everything):
    stored = published.read_table(spark, root, "pings").drop("date_key")
    full = flow.pings_from_raw(frame(spark, everything))
    cols = sorted(full.columns)

    def plain(df):
        return sorted(map(repr, (tuple(x) for x in df.select(*cols).collect())))
    assert plain(stored) == plain(full)
    rh, want = published.read_table(spark, root, "route_hours").drop("date_key"), metrics.route_hour(full)
    cols = sorted(want.columns)
    assert plain(rh) == plain(want)


def test_batches_in_any_order_equal_one_run(spark, tmp_path, seed=1):
    root, all_reports = f"file://{tmp_path}/w", reports(seed)
    mixed = all_reports[:]
    random.Random(seed + 10).shuffle(mixed)
    for part in (mixed[:150], mixed[150:290], mixed[290:]):
        incremental.load_batch(spark, root, frame(spark, part))
    both(spark, root, all_reports)


def test_a_late_report_rewrites_its_date_and_what_follows_from_it(spark, tmp_path):
    root = f"file://{tmp_path}/w"
    # one ping a day; V1 at noon of five days, V2 beside it, in snapshots of their own hour
    base = [(f"{v}{d}", f"V{v}", "1", "1_08_15", 28.6 + 0.001 * v, 77.2, 0.0, START + d * DAY + 6 * 3600 + v, str(d)) for d in range(5) for v in (1, 2)]
    first = incremental.load_batch(spark, root, frame(spark, base))
    late = [("x", "V1", "1", "1_08_15", 28.605, 77.2, 0.0, START + DAY + 8 * 3600, "late")]
    second = incremental.load_batch(spark, root, frame(spark, late))
    both(spark, root, base + late)
    # the report's own date, and the next date, where V1 has another predecessor
    assert incremental.written_dates(first, second, "pings") == [20260102, 20260103]
    assert rows(incremental.changed_dates(spark, root, "pings", first, second)) == [(20260102,), (20260103,)]
    assert incremental.written_dates(first, second, "day_edges") == [20260102]


def test_a_snapshot_over_midnight_is_judged_whole(spark, tmp_path):
    root = f"file://{tmp_path}/w"
    midnight = START - 19_800 + DAY          # local midnight
    near = [("a", "V1", "1", "t", 28.600, 77.2, 0.0, midnight - 120, "s0"), ("b", "V1", "1", "t", 28.605, 77.2, 0.0, midnight - 60, "s1"),
            ("c", "V2", "1", "t", 28.6001, 77.2, 0.0, midnight + 60, "s2")]
    first = incremental.load_batch(spark, root, frame(spark, near))
    partner = [("d", "V2", "1", "t", 28.6051, 77.2, 0.0, midnight + 120, "s1")]
    second = incremental.load_batch(spark, root, frame(spark, partner))
    both(spark, root, near + partner)
    assert incremental.written_dates(first, second, "pings") == [20260101, 20260102]
    flags = {(r.vehicle_id, r.obs_epoch - midnight): r.is_bunched for r in published.read_table(spark, root, "pings").collect()}
    assert flags[("V1", -60)] and flags[("V2", 120)] and not flags[("V1", -120)]


def test_known_reports_and_empty_batches_write_nothing(spark, tmp_path):
    root, some = f"file://{tmp_path}/w", reports(3, 60)
    empty = incremental.load_batch(spark, root, frame(spark, []))
    assert published.read_table(spark, root, "pings").count() == 0 and empty["version"] == 1
    incremental.load_batch(spark, root, frame(spark, some))
    before = published.current(spark, root)
    assert incremental.load_batch(spark, root, frame(spark, some)) == before
    assert incremental.load_batch(spark, root, frame(spark, [])) == before
    both(spark, root, some)


def test_a_replayed_batch_is_recognised(spark, tmp_path):
    root, some = f"file://{tmp_path}/w", reports(4, 60)
    a = incremental.load_batch(spark, root, frame(spark, some[:40]), source="feed", batch_id=0)
    assert incremental.load_batch(spark, root, frame(spark, some), source="feed", batch_id=0) == a
    b = incremental.load_batch(spark, root, frame(spark, some), source="feed", batch_id=1)
    assert b["applied"] == {"feed": 1} and b["version"] == 2
    both(spark, root, some)


def test_bunching_reads_written_pings(spark, tmp_path, monkeypatch):
    """Bunching reads its input in several branches; none of them may clean the reports again."""
    plans, flag = [], incremental.bunching.flag_bunching

    def flagged(pings, *a):
        plans.append(pings._jdf.queryExecution().optimizedPlan().toString())
        return flag(pings, *a)
    monkeypatch.setattr(incremental.bunching, "flag_bunching", flagged)
    some = reports(7, 60)
    for part in (some[::2], some[1::2]):
        incremental.load_batch(spark, f"file://{tmp_path}/w", frame(spark, part))
    assert len(plans) == 2 and not any("Window" in x or "Join" in x for x in plans)


def test_the_batch_flow_writes_cleaned_pings_for_bunching(spark, monkeypatch):
    """The branches of bunching read written pings, not a cache, whose shuffle partitions each start a task per branch
    however few rows they hold; the written pings go when bunching is done."""
    from transitlens.session import path_exists
    read, flag = [], flow.bunching.flag_bunching

    def flagged(pings, *a):
        read.append((pings._jdf.queryExecution().optimizedPlan().toString(), pings.storageLevel, pings.inputFiles()))
        return flag(pings, *a)
    monkeypatch.setattr(flow.bunching, "flag_bunching", flagged)
    out = flow.pings_from_raw(frame(spark, reports(8, 60)))
    (plan, level, files), = read
    assert not (level.useMemory or level.useDisk) and not any(x in plan for x in ("Window", "Join", "InMemoryRelation"))
    assert files and not any(path_exists(spark, f) for f in files)
    assert out.count() == out.select("vehicle_id", "obs_epoch").distinct().count() > 0
