"""Schedule delay against the static timetable (G4: F2, A11, J1-J4, W2, X4, X6, X10, X11, A4).

Plan shape: the timetable side (stop_times joined with the small stops
table) and the de-duplicated pings are shuffled on trip_id and joined; the
nearest stop per ping is a min over a struct (distance rounded, then
stop_sequence, stop_id, scheduled second) -- an aggregate with map-side
partial aggregation instead of a window over all candidates; the struct holds text, so Spark aggregates it by sorting, so candidate rows are
reduced before they are shuffled.  Neither growing side is broadcast; AQE
picks broadcast for the small dimension tables from runtime sizes and splits
a skewed trip.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from transitlens.config import DEFAULT, Params
from transitlens.functions.fmt import dec_round
from transitlens.functions.geo import haversine_m
from transitlens.functions.timefn import local_date, local_dow, local_hour, local_midnight_epoch
from transitlens.session import materialize

DEDUP_ORDER = ["trip_id", "route_id_rt", "lat", "lon", "speed"]


def clean_positions(pos: DataFrame) -> DataFrame:
    """F2 + A11: trip, position and epoch present; one report per (vehicle, epoch)."""
    pos = pos.filter(F.col("trip_id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
                     & F.col("obs_epoch").isNotNull())
    # deterministic survivor: smallest (trip, route, lat, lon, speed), nulls first
    best = pos.groupBy("vehicle_id", "obs_epoch").agg(F.min(F.struct(*DEDUP_ORDER)).alias("b"))
    return best.select("vehicle_id", "obs_epoch", *(F.col(f"b.{c}").alias(c) for c in DEDUP_ORDER))


def candidates(pos: DataFrame, stop_times: DataFrame, stops: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """J1 + J2: every ping x every scheduled stop of its trip, with the distance."""
    return with_distance(pos.join(stop_times.join(stops, "stop_id"), "trip_id"))


def with_distance(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("dist_to_stop_m", haversine_m("lat", "lon", "stop_lat", "stop_lon"))


USABLE = "dist_to_stop_m is not null and sched_arrival_sec is not null"


def unusable_stops(cand: DataFrame) -> DataFrame:
    """(trip_id, n): candidate rows per trip that nearest_stop passes over."""
    return cand.filter(f"not ({USABLE})").groupBy("trip_id").agg(F.count(F.lit(1)).alias("n"))


def nearest_stop(cand: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Keep the nearest stop per (vehicle_id, obs_epoch) with the full
    tie-break.  Stops without a position or a scheduled time (malformed timetable
    rows; ``unusable_stops`` counts them) are no candidates."""
    cand = cand.filter(USABLE)
    key = F.struct(
        dec_round(F.col("dist_to_stop_m"), p.stop_dist_dp).alias("d"),
        F.col("stop_sequence"), F.col("stop_id"), F.col("sched_arrival_sec"),
        F.col("dist_to_stop_m"), F.col("stop_name"), F.col("trip_id"), F.col("route_id_rt"),
        F.col("lat"), F.col("lon"), F.col("speed"))
    best = cand.groupBy("vehicle_id", "obs_epoch").agg(F.min(key).alias("b"))
    return best.select("vehicle_id", "obs_epoch", "b.*").drop("d")


def nearest_run(epoch, due_second, zone: str):
    """Struct (gap, nearer, days, late, day) of the run of a stop that an observation belongs to.

    A trip runs every day, and its second after midnight may lie whole days past it.  Of the runs due on the date of
    the observation, the date before and the date after, the one with the smallest gap to the observation is
    taken, of two equally near ones that of the farther day.  ``late`` is the signed gap,
    ``day`` the day whose run it is and ``days`` its distance from the observation's date."""
    seen, past = local_date(epoch, zone), F.floor(due_second / 86400).cast("int")

    def run(due_on: int):
        days = F.lit(due_on) - past
        day = F.date_add(seen, days)
        late = epoch - (local_midnight_epoch(day, zone) + due_second)
        return F.struct(F.abs(late).alias("gap"), (-F.abs(days)).alias("nearer"), days.alias("days"), late.alias("late"), day.alias("day"))

    return F.least(run(-1), run(0), run(1))


def build_delays(pos: DataFrame, stop_times: DataFrame, stops: DataFrame, trips: DataFrame, routes: DataFrame,
                 p: Params = DEFAULT, legacy_service_date: bool = False) -> DataFrame:
    """Delay of every ping against the nearest run of its nearest scheduled stop.  The service date is the day of that
    run; ``legacy_service_date`` puts it as many days on the other side of the observation's date (trap 10)."""
    near = nearest_stop(candidates(clean_positions(pos), stop_times, stops, p), p)
    e, run = F.col("obs_epoch"), F.col("run")
    served = F.date_sub(run["day"], 2 * run["days"]) if legacy_service_date else run["day"]
    x = near.withColumn("run", nearest_run(e, F.col("sched_arrival_sec"), p.time_zone)).select(
        "*", F.timestamp_seconds(e).alias("obs_ts"), served.alias("service_date"),
        local_hour(e, p.time_zone).alias("hour_of_day"), local_dow(e, p.time_zone).alias("day_of_week"),
        run["late"].alias("delay_sec"), dec_round(run["late"] / 60.0, 2).alias("delay_min"),
        (F.col("dist_to_stop_m") <= p.near_stop_m).alias("is_near_stop"), (run["gap"] > p.outlier_sec).alias("is_outlier"))
    x = x.join(trips, "trip_id", "left").join(routes, "route_id", "left")
    return x.select(
        "vehicle_id", "trip_id", "route_id", "route_short_name", "route_long_name",
        "stop_id", "stop_name", "stop_sequence", "lat", "lon", "speed", "dist_to_stop_m",
        "obs_ts", "obs_epoch", "service_date", "hour_of_day", "day_of_week",
        "delay_sec", "delay_min", "is_near_stop", "is_outlier")


QUANTILES = (("min", 0.0), ("25%", 0.25), ("50%", 0.5), ("75%", 0.75), ("max", 1.0))


def _narrowed(keys: DataFrame, lo: int, hi: int, ranks: list[int], bins: int) -> dict[int, int]:
    """The values of the given ranks (from 0) of one whole-number column ``v`` whose values lie in [lo, hi].

    Counts per range of values locate the range of each rank; the ranges that hold one
    are divided again.  A round brings back ``bins`` counts per open range at most."""
    open_ = {(lo, hi): (0, set(ranks))}                     # range: rows below it, ranks inside it
    out: dict[int, int] = {}
    while open_:
        n_of = {r: max(1, -(-(r[1] - r[0] + 1) // bins)) for r in open_}       # width of its bins
        where = F.lit(None).cast("long")
        start = F.lit(None).cast("long")
        for (a, b), w in n_of.items():
            inside = F.col("v").between(a, b)
            where = F.when(inside, F.lit(a)).otherwise(where)
            start = F.when(inside, F.lit(a) + F.floor((F.col("v") - a) / F.lit(w)) * w if w > 1 else F.col("v")).otherwise(start)
        counts = (keys.select(where.cast("long").alias("range"), start.cast("long").alias("bin")).filter("range is not null")
                  .groupBy("range", "bin").agg(F.count(F.lit(1)).alias("n")).collect())
        by: dict[int, list] = {}
        for r in counts:
            by.setdefault(r["range"], []).append((r["bin"], r["n"]))
        nxt: dict[tuple[int, int], tuple[int, set]] = {}
        for (a, b), (below, wanted) in open_.items():
            w = n_of[a, b]
            for bin_, n in sorted(by[a]):
                here = {k for k in wanted if below <= k < below + n}
                if here and w == 1:
                    out |= dict.fromkeys(here, bin_)
                elif here:
                    nxt[bin_, min(bin_ + w - 1, b)] = (below, here)
                below += n
        open_ = nxt
    return out


def quantiles_by_rank(df: DataFrame, column, probabilities: list[float], dp: int = 4, bins: int = 1024) -> list[float | None]:
    """Exact quantiles (linear between neighbours) of a numeric column on a decimal grid of ``dp`` places.

    The values become whole numbers of grid steps; the ranks that the quantiles need are
    found by counting per value range, round by round, so no task and not the driver ever
    holds the values: only counts of at most ``bins`` ranges per wanted rank."""
    step = 10 ** dp
    keys = df.select(F.round(column.cast("double") * step).cast("long").alias("v")).filter("v is not null")
    lo, hi, n = keys.agg(F.min("v"), F.max("v"), F.count(F.lit(1))).first()
    if not n:
        return [None] * len(probabilities)
    at = [q * (n - 1) for q in probabilities]
    ranks = sorted({k for x in at for k in (math.floor(x), math.ceil(x))})
    value = _narrowed(keys, lo, hi, ranks, bins)
    return [(value[math.floor(x)] + (value[math.ceil(x)] - value[math.floor(x)]) * (x - math.floor(x))) / step for x in at]


def delay_quantiles(delays: DataFrame) -> DataFrame:
    """A4: exact min / quartiles / max of delay_min (2 decimals) and dist_to_stop_m (metres at
    0.1 m, the warehouse scale), by rank selection over the written values."""
    values = materialize(delays.select("delay_min", dec_round(F.col("dist_to_stop_m"), 1).alias("dist_to_stop_m")), "delay-values")
    qs = [q for _, q in QUANTILES]
    d, m = (quantiles_by_rank(values, F.col(c), qs, dp) for c, dp in (("delay_min", 2), ("dist_to_stop_m", 1)))
    rows = [(name, a, b) for (name, _), a, b in zip(QUANTILES, d, m)]
    out = delays.sparkSession.createDataFrame(rows, "statistic string, delay_min double, dist_to_stop_m double")
    return out.select("statistic", dec_round(F.col("delay_min"), 4).alias("delay_min"), dec_round(F.col("dist_to_stop_m"), 4).alias("dist_to_stop_m"))
