"""Structured Streaming: snapshot file stream, streaming dedup, per-vehicle
derived speed with keyed state, local-hour windowed counts, and
idempotent foreachBatch sinks (E1-E5).

A ``lag`` window is not allowed on a streaming DataFrame, so the previous
ping of a vehicle is kept in keyed state (applyInPandasWithState); the
function de-duplicates the vehicle's reports of one micro-batch with the
batch rule (earliest snapshot first) and drops reports at or before the last
epoch already emitted.  With snapshot files arriving in time order the
stream equals the batch computation.

The state function sees one vehicle's reports of one micro-batch, copies
included; ``maxFilesPerTrigger`` bounds that group.  A watermark dedup in
front of it would shrink copies but keeps whichever copy arrives first, not
the earliest snapshot, so it is not used: the batch survivor rule stays exact.
"""
from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from transitlens import schemas
from transitlens.config import DEFAULT, EARTH_RADIUS_M, Params
from transitlens.operators import pings as P
from transitlens.sources import feed

# PySpark's grouped-state serializer concatenates batches that may be empty and
# pandas warns about it once per call; the message is specific, nothing else is hidden.
warnings.filterwarnings("ignore", message="The behavior of DataFrame concatenation with empty or all-NA entries")

SPEED_OUT = T.StructType([
    T.StructField("snapshot_id", T.StringType()), T.StructField("route_id", T.StringType()),
    T.StructField("vehicle_id", T.StringType()), T.StructField("trip_id", T.StringType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("obs_epoch", T.LongType()), T.StructField("gap_s", T.LongType()),
    T.StructField("dist_m", T.DoubleType()),
])
STATE = T.StructType([T.StructField("epoch", T.LongType()), T.StructField("lat", T.DoubleType()),
                      T.StructField("lon", T.DoubleType())])


def snapshot_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """NDJSON snapshot files under ``path`` as a stream (explicit schema)."""
    r = spark.readStream.schema(schemas.RAW)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def positions(stream: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """S1 projection + F1 filter + event time column (stateless)."""
    pos = P.valid_positions(feed.positions_for_speed(stream), p)
    return pos.withColumn("obs_ts", F.timestamp_seconds("obs_epoch"))


def dedup_stream(pos: DataFrame, delay: str = "2 days") -> DataFrame:
    """Drop repeated (vehicle_id, obs_epoch) reports within the watermark."""
    return pos.withWatermark("obs_ts", delay).dropDuplicatesWithinWatermark(["vehicle_id", "obs_epoch"])


def _haversine_np(lat1, lon1, lat2, lon2):
    import numpy as np
    r1, r2 = np.radians(lat1), np.radians(lat2)
    s_lat = np.sin(np.radians(lat2 - lat1) / 2)
    s_lon = np.sin(np.radians(lon2 - lon1) / 2)
    a = s_lat * s_lat + np.cos(r1) * np.cos(r2) * s_lon * s_lon
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(a))


def _speed_state(key, batches, state):
    """Keyed by vehicle_id: de-duplicate, attach the previous ping, update state."""
    import numpy as np
    import pandas as pd
    pdf = pd.concat(list(batches), ignore_index=True)
    cols = ["obs_epoch", "snapshot_id", "route_id", "trip_id", "lat", "lon"]
    pdf = pdf.sort_values(cols, na_position="first", kind="mergesort").drop_duplicates("obs_epoch", keep="first")
    last = state.get if state.exists else None
    if last is not None:
        pdf = pdf[pdf["obs_epoch"] > last[0]]
    if pdf.empty:
        return
    prev_epoch = pdf["obs_epoch"].shift(1)
    prev_lat = pdf["lat"].shift(1)
    prev_lon = pdf["lon"].shift(1)
    if last is not None:
        prev_epoch.iloc[0], prev_lat.iloc[0], prev_lon.iloc[0] = last[0], last[1], last[2]
    gap = (pdf["obs_epoch"] - prev_epoch).astype("Int64")
    dist = _haversine_np(prev_lat.to_numpy(dtype=float), prev_lon.to_numpy(dtype=float),
                         pdf["lat"].to_numpy(dtype=float), pdf["lon"].to_numpy(dtype=float))
    tail = pdf.iloc[-1]
    state.update((int(tail["obs_epoch"]), float(tail["lat"]), float(tail["lon"])))
    out = pdf[["snapshot_id", "route_id", "vehicle_id", "trip_id", "lat", "lon", "obs_epoch"]].copy()
    out["gap_s"] = gap
    out["dist_m"] = np.where(np.isnan(dist), None, dist)
    yield out


def speed_stream(pos: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Derived speed per vehicle through keyed state, then the batch flag rules."""
    raw = pos.select("snapshot_id", "route_id", "vehicle_id", "trip_id", "lat", "lon", "obs_epoch")
    lagged = raw.groupBy("vehicle_id").applyInPandasWithState(
        _speed_state, SPEED_OUT, STATE, "append", GroupStateTimeout.NoTimeout)
    gap_ok = F.col("gap_s").between(p.min_gap_s, p.max_gap_s)
    speed = F.round(F.when(gap_ok, F.try_divide(F.col("dist_m"), F.col("gap_s")) * 3.6), 2)
    valid = F.coalesce(F.col("speed_kmph") <= p.max_kmph, F.lit(False))
    return (lagged.withColumn("speed_kmph", speed).withColumn("is_speed_valid", valid)
                  .withColumn("is_moving", F.coalesce(F.col("is_speed_valid") & (F.col("speed_kmph") > p.moving_kmph),
                                                      F.lit(False))))


def local_hour_counts(pos: DataFrame, p: Params = DEFAULT, delay: str = "2 days") -> DataFrame:
    """Reports per route and local clock hour.  Windows are 1 hour long and
    start 30 minutes past the UTC hour, which aligns them to +05:30 local hours."""
    offset_min = _zone_offset_minutes(p.time_zone) % 60
    w = F.window("obs_ts", "1 hour", startTime=f"{offset_min} minutes")
    return (pos.withWatermark("obs_ts", delay).groupBy(w.alias("w"), "route_id")
               .agg(F.count(F.lit(1)).alias("n_reports"), F.approx_count_distinct("vehicle_id").alias("approx_vehicles")))


def local_hour_vehicles(pos: DataFrame, p: Params = DEFAULT, delay: str = "2 days") -> DataFrame:
    """Exact distinct vehicles per route and local clock hour (append mode: an hour leaves when the watermark has
    passed it).  The first report of a (route, hour, vehicle) passes, the hours count what passed; both forget an hour
    with the watermark."""
    w = F.window("obs_ts", "1 hour", startTime=f"{_zone_offset_minutes(p.time_zone) % 60} minutes")
    seen = (pos.withWatermark("obs_ts", delay).select("route_id", "vehicle_id", w.alias("w"))
               .dropDuplicates(["route_id", "w", "vehicle_id"]))
    return seen.groupBy("w", "route_id").agg(F.count(F.lit(1)).alias("n_vehicles"))


def _zone_offset_minutes(zone: str) -> int:
    import datetime as dt
    from zoneinfo import ZoneInfo
    off = dt.datetime(2026, 1, 1, tzinfo=ZoneInfo(zone)).utcoffset()
    return int(off.total_seconds() // 60) if off is not None else 0


def idempotent_sink(path: str, key_cols: list[str] | None = None):
    """E5: foreachBatch writer.  Each micro-batch goes to its own batch_id
    partition with overwrite, so a replayed batch (after a failure) replaces
    its earlier attempt instead of duplicating it."""
    def write(batch: DataFrame, batch_id: int):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
    return write


def upsert_sink(spark: SparkSession, path: str, keys: list[str], part_col: str):
    """E5: foreachBatch upsert of aggregate updates (update output mode): the
    latest value per key wins; touched partitions only are rewritten."""
    from transitlens.operators import warehouse as W

    def write(batch: DataFrame, batch_id: int):
        batch.persist()              # the upsert reads it twice; a stateful batch must run once
        try:
            W.upsert_table(spark, path, batch, keys, part_col)
        finally:
            batch.unpersist()
    return write


def additive_sink(spark: SparkSession, root: str, name: str, keys: list[str], sums: list[str], source: str):
    """E5: foreachBatch writer of sums.  The batch id is committed together with the new totals (published.add_batch),
    so a batch sent again after a failure between that commit and the checkpoint adds nothing."""
    from transitlens.plans import published

    def write(batch: DataFrame, batch_id: int):
        published.add_batch(spark, root, name, batch, keys, sums, source, batch_id)
    return write


def run_available_now(df: DataFrame, sink, checkpoint: str, mode: str = "append") -> None:
    """Run a streaming query over all available input and wait for it."""
    q = (df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def land_in_time_order(raw: DataFrame, path: str, chunk_col: str, most_files: int = 8, file_rows: int = 50_000) -> int:
    """Write raw records as NDJSON, one write per chunk in ascending order, so the
    file stream sees them in event-time order.  Returns the number of chunks.
    The chunk list is a handful of values (e.g. local dates).

    A chunk has a file per ``file_rows`` records, ``most_files`` at most: more records make larger files (which are
    read in splits) and not more micro-batches, each of which costs a pass over the state."""
    sizes = raw.groupBy(chunk_col).agg(F.count(F.lit(1)).alias("n")).orderBy(chunk_col).collect()
    for c, n in sizes:
        # a vehicle's reports of one chunk land in one file, so they are never
        # split across micro-batches out of order
        raw.filter(F.col(chunk_col) == F.lit(c)).drop(chunk_col).repartition(min(most_files, -(-n // file_rows)), "vehicle_id") \
           .write.mode("append").json(path)
    return len(sizes)


def chunk_day(epoch_col: str = "vehicle_timestamp", seconds: int = 86400):
    return F.floor(F.col(epoch_col) / seconds).cast("long")


__all__ = ["snapshot_stream", "positions", "dedup_stream", "speed_stream", "local_hour_counts", "local_hour_vehicles",
           "idempotent_sink", "upsert_sink", "additive_sink", "run_available_now", "land_in_time_order", "chunk_day"]
