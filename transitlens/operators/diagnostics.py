"""Feed diagnostics (G1-G3): per-snapshot profile, consecutive-snapshot
overlap, and feed vs timetable id reconciliation with sorted samples."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def _distinct_with_null(c: str):
    """Number of distinct values counting null as one value (set semantics)."""
    return F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))


def snapshot_profile(raw: DataFrame) -> DataFrame:
    """Records, vehicles, non-zero and maximum speed, distinct speeds per snapshot."""
    s = F.col("speed")
    return raw.groupBy(F.col("fetched_at").alias("snapshot_id")).agg(
        F.count(F.lit(1)).alias("records"),
        _distinct_with_null("vehicle_id").alias("distinct_vehicles"),
        F.count_if(s.isNotNull() & (s != 0)).alias("speed_nonzero"),
        F.max(s).alias("max_speed"),
        _distinct_with_null("speed").alias("distinct_speeds"),
    )


def snapshot_diff(raw: DataFrame) -> DataFrame:
    """For each snapshot, vehicles also seen in the previous snapshot
    and how many of them changed position.  A vehicle's position in a snapshot
    is its latest report (ties: larger coordinates), decided by an aggregate."""
    last = raw.groupBy(F.col("fetched_at").alias("snapshot_id"), "vehicle_id").agg(
        F.max(F.struct(F.col("vehicle_timestamp"), F.col("latitude"), F.col("longitude"))).alias("p"))
    # number the snapshots 1..n in id order with the distributed key allocator
    # (no single-partition window: the snapshot list grows with every fetch)
    from transitlens.operators.warehouse import assign_keys
    snaps = assign_keys(last.select("snapshot_id"), "snapshot_id", "n")
    cur = last.join(snaps, "snapshot_id")
    prev = cur.select(F.col("vehicle_id").alias("pv"), (F.col("n") + 1).alias("n"),
                      F.col("p").alias("pp"), F.col("snapshot_id").alias("prev_snapshot_id"))
    both = cur.join(prev, (cur["n"] == prev["n"]) & cur["vehicle_id"].eqNullSafe(prev["pv"]))
    moved = ~(F.col("p.latitude").eqNullSafe(F.col("pp.latitude")) & F.col("p.longitude").eqNullSafe(F.col("pp.longitude")))
    return both.groupBy("snapshot_id", "prev_snapshot_id").agg(
        F.count(F.lit(1)).alias("seen_in_previous"), F.count_if(moved).alias("position_changed"))


def id_overlap(feed_raw: DataFrame, trips: DataFrame) -> DataFrame:
    """Distinct trip and route ids on both sides and how many match
    (ids trimmed; missing ids are excluded rather than counted as text)."""
    ft = feed_raw.select(F.trim("trip_id").alias("id")).filter(F.col("id").isNotNull()).distinct()
    fr = feed_raw.select(F.trim("route_id").alias("id")).filter(F.col("id").isNotNull()).distinct()
    st = trips.select(F.trim("trip_id").alias("id")).filter(F.col("id").isNotNull()).distinct()
    sr = trips.select(F.trim("route_id").alias("id")).filter(F.col("id").isNotNull()).distinct()

    def n(df, name):
        return df.agg(F.count(F.lit(1)).alias(name))
    parts = [n(ft, "feed_trip_ids"), n(fr, "feed_route_ids"), n(st, "static_trip_ids"),
             n(ft.join(st, "id", "left_semi"), "trip_id_matches"), n(fr.join(sr, "id", "left_semi"), "route_id_matches")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # single-row aggregates
    return out


def id_samples(feed_raw: DataFrame, trips: DataFrame, k: int = 8) -> DataFrame:
    """The first ``k`` sorted ids of each side, and for the smallest
    route present on both sides, its first ``k`` trips on each side."""
    ft = feed_raw.select(F.trim("trip_id").alias("id"), F.trim("route_id").alias("route")).filter(F.col("id").isNotNull())
    st = trips.select(F.trim("trip_id").alias("id"), F.trim("route_id").alias("route")).filter(F.col("id").isNotNull())

    def first_k(df, label):
        ids = df.select("id").distinct().orderBy("id").limit(k)
        return ids.select(F.lit(label).alias("sample"), F.row_number().over(Window.orderBy("id")).alias("pos"), "id")
    common = (ft.select("route").filter(F.col("route").isNotNull()).distinct()
                .join(st.select("route").distinct(), "route", "left_semi")
                .agg(F.min("route").alias("r0")))
    feed_r0 = ft.crossJoin(common).filter(F.col("id").startswith(F.concat(F.col("r0"), F.lit("_"))))
    static_r0 = st.crossJoin(common).filter(F.col("route") == F.col("r0"))
    return (first_k(ft, "feed_trips").unionByName(first_k(st, "static_trips"))
            .unionByName(first_k(feed_r0, "feed_trips_of_first_common_route"))
            .unionByName(first_k(static_r0, "static_trips_of_first_common_route")))
