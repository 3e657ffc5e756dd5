"""Incremental speed job (W1, K1, A1): a batch of raw reports changes only the dates that it touches.

The stored version (commits of ``published``) holds, each by ``date_key``:

* ``pings``          the vehicle_pings_clean rows, clustered by snapshot;
* ``route_hours``    the route-hour rows;
* ``day_edges``      the last kept ping of every vehicle on every date;
* ``snapshot_days``  the dates on which a snapshot has kept pings.

A batch may hold reports of any age, repeated and better ones of known pings included (the smallest report in
``DEDUP_ORDER`` stays, which does not depend on the order of arrival).  What it changes is found in four steps:

1. its own dates: stored reports of those dates and the batch are de-duplicated together;
2. dates whose first ping of some vehicle has another predecessor now (the vehicle's last ping of an earlier date
   changed).  Predecessors on dates that are not read come from ``day_edges``;
3. the snapshots of all rows that differ from the stored ones.  Bunching is decided again for those alone, on all
   their pings, also the ones on other dates (``snapshot_days`` names these);
4. the route-hours of the dates that hold such snapshots.

Only folders of those dates are read, and only dates with a changed snapshot are written; all other folders stay part of the
version as they are.  ``day_edges`` and ``snapshot_days`` are read whole: one row per vehicle and date, and per
snapshot and date.  The driver holds date keys, which the calendar bounds, and never rows.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from transitlens.config import DEFAULT, Params
from transitlens.functions.fmt import date_key
from transitlens.functions.timefn import local_date
from transitlens.operators import bunching, metrics, pings as P
from transitlens.plans import published
from transitlens.session import materialize
from transitlens.sources import feed

POSITION = ["vehicle_id", "obs_epoch", *P.DEDUP_ORDER]
CLUSTERED = {"pings": ["snapshot_id", "route_id"], "route_hours": ["hour_of_day", "route_id"],
             "day_edges": ["vehicle_id"], "snapshot_days": ["snapshot_id"]}


def _dated(positions: DataFrame, p: Params) -> DataFrame:
    return positions.withColumn("date_key", date_key(local_date(F.col("obs_epoch"), p.time_zone)))


def _edges(positions: DataFrame) -> DataFrame:
    """The last ping of each vehicle and date."""
    last = F.max_by(F.struct(*POSITION), "obs_epoch").alias("last")
    return positions.groupBy("date_key", "vehicle_id").agg(last).select("date_key", "last.*")


def _same(a: str, b: str, columns: list[str]):
    return F.struct(*(f"{a}.{c}" for c in columns)).eqNullSafe(F.struct(*(f"{b}.{c}" for c in columns)))


def _followers(edges: DataFrame) -> DataFrame:
    """Every vehicle-date with the vehicle's next date."""
    return edges.withColumn("next_date", F.lead("date_key").over(Window.partitionBy("vehicle_id").orderBy("date_key")))


def _moved_dates(old_edges: DataFrame, new_edges: DataFrame, own: list[int]) -> list[int]:
    """Dates outside ``own`` that follow a changed last ping of one of their vehicles."""
    kept = old_edges.filter(~F.col("date_key").isin(own))
    old_own = old_edges.filter(F.col("date_key").isin(own))
    follow = _followers(kept.unionByName(new_edges)).filter(F.col("date_key").isin(own) & ~F.col("next_date").isin(own))
    changed = follow.alias("n").join(old_own.alias("o"), ["date_key", "vehicle_id"], "left").filter(
        ~_same("n", "o", ["obs_epoch", "lat", "lon"]))
    return published.dates_of(changed.select(F.col("next_date").alias("date_key")))


def _entries(before: dict | None, staged: dict) -> dict:
    """The tables of the next version: staged dates replace stored ones."""
    old = (before or {"tables": {}})["tables"]
    return old | {n: e | {"paths": (old[n]["paths"] if n in old else {}) | e["paths"]} for n, e in staged.items()}


def load_batch(spark: SparkSession, root: str, raw: DataFrame, p: Params = DEFAULT, source: str | None = None,
               batch_id: int | None = None) -> dict:
    """Bring the stored pings and route-hours up to date with a batch of raw reports, and return the commit.

    After any sequence of batches the tables equal those of one run over all reports.  A batch without news, an empty
    one included, writes no rows.  With ``source`` and ``batch_id`` a batch that the version already holds is skipped.
    """
    before = published.current(spark, root)
    if source is not None and published.already_applied(before, source, batch_id):
        return before
    run = uuid.uuid4().hex
    valid = P.valid_positions(feed.positions_for_speed(raw), p)
    batch = materialize(_dated(P.dedup(valid), p), "batch-positions")
    own = published.dates_of(batch)

    def stored(name, dates=None):
        return published.read_table(spark, root, name, before, dates)

    def stage(name, df):
        return published._stage(spark, df, root, name, run, CLUSTERED[name])

    if before is None:
        cleaned = materialize(P.clean(batch.select(*POSITION), p), "read-dates")       # bunching reads it several times
        flagged = materialize(_dated(bunching.flag_bunching(cleaned, p), p), "pings")
        staged = {"pings": flagged, "route_hours": _by_date(metrics.route_hour(flagged)), "day_edges": _edges(batch),
                  "snapshot_days": batch.select("date_key", "snapshot_id").distinct()}
        return published._commit(spark, root, None, {n: stage(n, d) for n, d in staged.items()}, source, batch_id)

    # 1. the batch's own dates
    merged = P.dedup(stored("pings", own).select(*POSITION).unionByName(batch.select(*POSITION)))
    best = materialize(_dated(merged, p), "own-dates")
    new_edges, old_edges = _edges(best), stored("day_edges")
    # 2. dates with another predecessor; the predecessors that lie on dates not read
    read = sorted({*own, *_moved_dates(old_edges, new_edges, own)})
    moved = [d for d in read if d not in own]
    before_read = _followers(old_edges.filter(~F.col("date_key").isin(own)).unionByName(new_edges)).filter(
        ~F.col("date_key").isin(read) & F.col("next_date").isin(read))
    positions = best.select(*POSITION).unionByName(stored("pings", moved).select(*POSITION)).unionByName(
        before_read.select(*POSITION))
    cleaned = materialize(_dated(P.clean(positions, p), p).filter(F.col("date_key").isin(read)), "read-dates")
    # 3. snapshots of rows that differ; all their dates
    plain = cleaned.columns
    differ = cleaned.alias("n").join(stored("pings", read).select(*plain).alias("o"), ["vehicle_id", "obs_epoch"], "full").filter(
        ~_same("n", "o", [c for c in plain if c not in ("vehicle_id", "obs_epoch")]))
    snapshots = materialize(differ.select(F.explode(F.array(
        F.struct(F.col("n.date_key").isNotNull().alias("is"), F.col("n.snapshot_id").alias("snapshot")),
        F.struct(F.col("o.date_key").isNotNull().alias("is"), F.col("o.snapshot_id").alias("snapshot")))).alias("x"))
        .filter("x.is").select("x.snapshot").distinct(), "changed-snapshots")
    known = stored("snapshot_days").unionByName(cleaned.select("date_key", "snapshot_id"))
    changed = F.col("snapshot_id").eqNullSafe(F.col("snapshot"))
    touched = published.dates_of(known.join(snapshots, changed, "left_semi"))
    if touched:
        # every ping of a changed snapshot lies on a touched date; the others are as stored
        outside = stored("pings", [d for d in touched if d not in read]).select(*plain)
        again = materialize(cleaned.unionByName(outside).join(snapshots, changed, "left_semi"), "changed-pings")
        kept = stored("pings", touched).join(snapshots, changed, "left_anti")
        pings = materialize(bunching.flag_bunching(again, p).unionByName(kept), "pings")
        news = best.filter(F.col("date_key").isin(touched))
        staged = {"pings": pings, "route_hours": _by_date(metrics.route_hour(pings)), "day_edges": _edges(news),
                  "snapshot_days": news.select("date_key", "snapshot_id").distinct()}
        tables = _entries(before, {n: stage(n, d) for n, d in staged.items()})
    elif source is None:
        return before
    else:
        tables = before["tables"]
    return published._commit(spark, root, before, tables, source, batch_id)


def _by_date(route_hours: DataFrame) -> DataFrame:
    return route_hours.withColumn("date_key", date_key("service_date"))


def written_dates(a: dict, b: dict, name: str) -> list[int]:
    """Dates of a table whose folder differs between two versions."""
    x, y = (v["tables"][name]["paths"] for v in (a, b))
    return sorted(int(d) for d in x.keys() | y.keys() if x.get(d) != y.get(d))


def changed_dates(spark: SparkSession, root: str, name: str, a: dict, b: dict) -> DataFrame:
    """Dates of a table whose rows differ between two versions, by a digest of the rows of each date."""
    digests = []
    for v in (a, b):
        rows = published.read_table(spark, root, name, v)
        cols = sorted(rows.columns)
        h = F.xxhash64(*cols, *(F.col(c).isNull() for c in cols)).cast("decimal(38,0)")
        digests.append(rows.groupBy("date_key").agg(F.struct(F.count(F.lit(1)), F.sum(h)).alias("d")))
    x, y = digests
    return x.alias("x").join(y.alias("y"), "date_key", "full").filter(~F.col("x.d").eqNullSafe(F.col("y.d"))).select("date_key")
