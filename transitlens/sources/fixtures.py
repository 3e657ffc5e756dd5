"""Driver tables -> reference-shaped inputs (FIXTURES.md section 2).

The driver's tables carry no positions, so a raw feed is derived from
``events`` arithmetically, and a static timetable from the TPC-H-like
tables.  Everything here is a projection: no shuffle, and Parquet column
pruning reaches the scans.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from transitlens.functions.timefn import epoch_of_ntz

# Fixed values of the fixture mapping.
EPOCH_TARGET = 1767225600      # 2026-01-01T00:00Z
EPOCH_SOURCE = 1704067200      # 2024-01-01T00:00Z
TIME_COMPRESSION = 10          # 30 days of events -> 3 days of pings
SNAPSHOT_SECONDS = 3600
N_ROUTES = 6
NULL_TRIP_EVERY = 89
ZERO_POSITION_EVERY = 97
REPEAT_EVERY = 11
LAT_BASE, LON_BASE = 28.55, 77.10
LAT_MULT, LON_MULT = 7919, 104729
ARRIVAL_MULT, ARRIVAL_MOD = 37, 108000


@dataclass
class Tables:
    """Lazy access to the driver's parquet tables in one scale-factor folder."""
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def obs_epoch_expr(ts_col="ts"):
    e = epoch_of_ntz(F.col(ts_col))
    return F.lit(EPOCH_TARGET) + F.floor((e - F.lit(EPOCH_SOURCE)) / TIME_COMPRESSION).cast("long")


def raw_feed(events: DataFrame, repeats: bool = True, trip_from_user: bool = False) -> DataFrame:
    """Raw snapshot records (RAW schema) derived from ``events``.

    Every event is one vehicle report; a report with event_id % 11 = 0 is
    also present in the following snapshot (same vehicle and timestamp), which
    exercises de-duplication.  The repeat is an explode of a 1- or 2-element
    array, so the events table is scanned once.
    """
    eid = F.col("event_id")
    route = F.when(eid % NULL_TRIP_EVERY != 0, (F.col("user_id") % N_ROUTES).cast("string"))
    trip = F.concat(route, F.lit("_"), F.lpad((eid % 24).cast("string"), 2, "0"),
                    F.lit("_"), F.lpad((eid % 60).cast("string"), 2, "0"))
    if trip_from_user:
        trip = F.col("user_id").cast("string")
    zero = eid % ZERO_POSITION_EVERY == 0
    lat = F.when(zero, F.lit(0.0)).otherwise(F.lit(LAT_BASE) + ((eid * LAT_MULT) % 10) / 100.0)
    lon = F.when(zero, F.lit(0.0)).otherwise(
        F.lit(LON_BASE) + (F.floor((eid * LON_MULT) / 10) % 10) / 100.0)
    base = events.select(
        eid.cast("string").alias("entity_id"),
        F.concat(F.lit("V"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("vehicle_id"),
        route.alias("route_id"),
        trip.alias("trip_id"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.lit(0.0).alias("speed"),
        obs_epoch_expr().alias("vehicle_timestamp"),
        (F.explode(F.when(eid % REPEAT_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
         if repeats else F.lit(0)).alias("_rep"),
    )
    snap = F.floor(F.col("vehicle_timestamp") / SNAPSHOT_SECONDS).cast("long") + F.col("_rep")
    return base.withColumn("fetched_at", snap.cast("string")).drop("_rep")


def delay_positions(events: DataFrame) -> DataFrame:
    """Raw feed for the delay job: trip_id is the user id, which is what the
    timetable's trip ids (order keys) overlap with."""
    return raw_feed(events, trip_from_user=True)


def static_timetable(lineitem: DataFrame, supplier: DataFrame, orders: DataFrame, customer: DataFrame):
    """Text-typed timetable tables (as read from CSV) built from TPC-H-like tables."""
    sec = (F.col("l_partkey") * ARRIVAL_MULT) % ARRIVAL_MOD
    hms = F.concat_ws(":", *(F.lpad(x.cast("string"), 2, "0") for x in
                             (F.floor(sec / 3600), F.floor(sec / 60) % 60, sec % 60)))
    stop_times = lineitem.select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        hms.alias("arrival_time"),
        hms.alias("departure_time"),
        F.col("l_suppkey").cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("string").alias("stop_sequence"),
    )
    stops = supplier.select(
        F.col("s_suppkey").cast("string").alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        (F.lit(LAT_BASE) + (F.col("s_suppkey") % 10) / 100.0).cast("string").alias("stop_lat"),
        (F.lit(LON_BASE) + (F.floor(F.col("s_suppkey") / 10) % 10) / 100.0).cast("string").alias("stop_lon"),
    )
    trips = orders.select(F.col("o_custkey").cast("string").alias("route_id"),
                          F.col("o_orderkey").cast("string").alias("trip_id"))
    routes = customer.select(F.col("c_custkey").cast("string").alias("route_id"),
                             F.col("c_mktsegment").alias("route_short_name"),
                             F.col("c_name").alias("route_long_name"))
    return stop_times, stops, trips, routes
