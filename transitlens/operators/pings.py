"""Clean, de-duplicate and derive speed for vehicle pings.

Scale notes
-----------
* Filtering happens before any shuffle, so it is pushed towards the scan.
* De-duplication is an aggregate with map-side partial aggregation, so
  repeated copies of a report collapse before the shuffle; the previous-ping
  lookup is then one window over (vehicle_id, time bucket), whose partitions
  hold distinct epochs only (at most bucket_s rows per vehicle).
* A vehicle's history is split into time buckets so that a hot vehicle does
  not end up as one unbounded window partition.  The first ping of a bucket
  takes its predecessor from a small "carry" table: the last ping of each
  (vehicle, bucket), looked back over buckets per vehicle.  The carry table
  has one row per vehicle-bucket and comes from a hash aggregate, so its
  shuffles are small; buckets are days, since a bucket of about one ping would
  make it as large as the pings.  The same carry
  lets an incremental run continue from the previous batch (trap 12).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from transitlens.config import DEFAULT, Params
from transitlens.functions.geo import haversine_m
from transitlens.functions.timefn import local_date, local_dow, local_hour, trip_part

# Deterministic survivor among reports of one (vehicle_id, obs_epoch):
# the earliest snapshot wins, then the remaining fields break ties.
DEDUP_ORDER = ["snapshot_id", "route_id", "trip_id", "lat", "lon"]
BUCKET_S = 86400


def valid_positions(pos: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """ids and epoch present, position inside the inclusive bounding box."""
    return pos.filter(
        F.col("route_id").isNotNull()
        & F.col("vehicle_id").isNotNull()
        & F.col("lat").between(p.lat_min, p.lat_max)
        & F.col("lon").between(p.lon_min, p.lon_max)
        & F.col("obs_epoch").isNotNull()
    )


def with_time_columns(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """X5 + X3: instant, local date / hour / weekday, dispatch time from trip id."""
    e = F.col("obs_epoch")
    return df.withColumns({
        "obs_ts": F.timestamp_seconds(e),
        "service_date": local_date(e, p.time_zone),
        "hour_of_day": local_hour(e, p.time_zone),
        "day_of_week": local_dow(e, p.time_zone),
        "dispatch_hour": trip_part("trip_id", 1),
        "dispatch_minute": trip_part("trip_id", 2),
    })


def _bucket(bucket_s: int):
    return F.floor(F.col("obs_epoch") / bucket_s).cast("long")


def dedup(df: DataFrame) -> DataFrame:
    """One report per (vehicle_id, obs_epoch): the smallest
    (snapshot_id, route_id, trip_id, lat, lon), nulls first, i.e. the earliest
    snapshot wins.  An aggregate, so copies collapse map-side (partial
    aggregation) before anything is shuffled: a report repeated in a huge
    number of snapshots never forms a large group."""
    best = df.groupBy("vehicle_id", "obs_epoch").agg(F.min(F.struct(*DEDUP_ORDER)).alias("_b"))
    return best.select("vehicle_id", "obs_epoch", *(F.col(f"_b.{c}").alias(c) for c in DEDUP_ORDER))


def dedup_and_lag(df: DataFrame, bucket_s: int = BUCKET_S, carry: DataFrame | None = None) -> DataFrame:
    """Keep one report per (vehicle_id, obs_epoch) and attach the previous
    report of the same vehicle as prev_lat / prev_lon / prev_epoch.

    ``carry`` (vehicle_id, obs_epoch, lat, lon) optionally supplies the last
    ping per vehicle of an earlier batch, for incremental runs.
    """
    kept = dedup(df).withColumn("_bkt", _bucket(bucket_s))
    part = ["vehicle_id", "_bkt"]
    w_lag = Window.partitionBy(*part).orderBy("obs_epoch")
    lagged = kept.withColumns({
        "prev_lat": F.lag("lat").over(w_lag),
        "prev_lon": F.lag("lon").over(w_lag),
        "prev_epoch": F.lag("obs_epoch").over(w_lag),
    })
    # last ping of every (vehicle, bucket): epochs are distinct, so the three come from one row; numbers only, so a
    # hash aggregate that collapses before its shuffle
    last = kept.groupBy(*part).agg(F.struct(
        F.max("obs_epoch").alias("obs_epoch"), F.max_by("lat", "obs_epoch").alias("lat"),
        F.max_by("lon", "obs_epoch").alias("lon")).alias("_last"))
    if carry is not None:
        last = last.unionByName(carry.select(
            "vehicle_id", F.lit(None).cast("long").alias("_bkt"),
            F.struct("obs_epoch", "lat", "lon").alias("_last")))
    w_b = Window.partitionBy("vehicle_id").orderBy(F.col("_bkt").asc_nulls_first())
    prev_bucket = (last.withColumn("_prev", F.lag("_last").over(w_b))
                       .filter(F.col("_bkt").isNotNull() & F.col("_prev").isNotNull())
                       .select(*part, "_prev"))
    out = lagged.join(prev_bucket, part, "left")
    first = F.col("prev_epoch").isNull()
    return out.withColumns({
        "prev_lat": F.when(first, F.col("_prev.lat")).otherwise(F.col("prev_lat")),
        "prev_lon": F.when(first, F.col("_prev.lon")).otherwise(F.col("prev_lon")),
        "prev_epoch": F.when(first, F.col("_prev.obs_epoch")).otherwise(F.col("prev_epoch")),
    }).drop("_prev", "_bkt")


def speed_columns(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """gap_s, dist_m, speed_kmph (rounded to 2 dp) and the two flags, in one projection."""
    gap = F.col("obs_epoch") - F.col("prev_epoch")
    dist = haversine_m("prev_lat", "prev_lon", "lat", "lon")
    speed = F.round(F.when(gap.between(p.min_gap_s, p.max_gap_s), F.try_divide(dist, gap) * 3.6), 2)
    valid = F.coalesce(speed <= p.max_kmph, F.lit(False))
    moving = F.coalesce(valid & (speed > p.moving_kmph), F.lit(False))
    keep = [c for c in df.columns if c not in ("prev_lat", "prev_lon", "prev_epoch")]
    return df.select(*keep, gap.alias("gap_s"), dist.alias("dist_m"), speed.alias("speed_kmph"),
                     valid.alias("is_speed_valid"), moving.alias("is_moving"))


def clean(pos: DataFrame, p: Params = DEFAULT, bucket_s: int = BUCKET_S, carry: DataFrame | None = None) -> DataFrame:
    """F1 + A11 + W1 + speed: positions -> pings with derived speed (no bunching yet)."""
    df = valid_positions(pos, p)
    df = dedup_and_lag(df, bucket_s, carry)
    return speed_columns(with_time_columns(df, p), p)


def last_ping_per_vehicle(pings: DataFrame) -> DataFrame:
    """Carry table for the next incremental batch (one row per vehicle, partial agg)."""
    return (pings.groupBy("vehicle_id")
                 .agg(F.max_by(F.struct("obs_epoch", "lat", "lon"), F.col("obs_epoch")).alias("c"))
                 .select("vehicle_id", "c.obs_epoch", "c.lat", "c.lon"))
