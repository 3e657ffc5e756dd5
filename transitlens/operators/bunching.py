"""Bus bunching (J5, J6, U1): a moving bus with another moving bus of the same
route closer than ``bunch_m`` in the same snapshot.

The plain formulation is a self-join on (snapshot, route) that tests every
pair of a group, which is quadratic in the size of a group.  This operator
is exact but never enumerates all pairs:

1. Fine cells.  Points are put on a lat/lon grid whose cells are so small
   that two points of one cell are always closer than ``bunch_m``
   (functions.geo.fine_cell_deg).  A cell holding two or more distinct
   vehicles therefore bunches every vehicle in it; that is decided by a
   min/max aggregate with map-side partial aggregation, so a dense cell costs
   no pairs at all (min/max of a 64-bit hash of the id, so the aggregate is
   a hash aggregate).
2. Probes.  Only points that are alone (one vehicle) in their fine cell still
   need a test.  Each probe is sent to the coarse cells that its
   ``bunch_m`` bounding box touches (at most 4 for the default sizes), and is
   joined with the points of those coarse cells, with the exact haversine
   test as the join condition.  Probes per coarse cell are bounded by the
   number of fine cells that can reach it, so the join does work linear in
   the number of points; a coarse cell with many points is dealt over salts.
3. The flag is joined back on (snapshot, route, vehicle), like the reference,
   so every ping of a flagged vehicle in that snapshot is flagged (trap 2);
   ``strict_bunching`` additionally requires the ping itself to be moving.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from transitlens.config import DEFAULT, Params
from transitlens.functions.geo import fine_cell_deg, haversine_m, reach_deg

KEY = ["snapshot_id", "route_id"]


def _moving_points(pings: DataFrame) -> DataFrame:
    return (pings.filter(F.col("is_moving") & F.col("snapshot_id").isNotNull() & F.col("route_id").isNotNull())
                 .select(*KEY, "vehicle_id", "lat", "lon"))


def close_vehicles(pings: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Distinct (snapshot_id, route_id, vehicle_id) that have a close moving partner."""
    g = fine_cell_deg(p.bunch_m)
    pts = _moving_points(pings).withColumns({
        "fy": F.floor(F.col("lat") / g).cast("long"),
        "fx": F.floor(F.col("lon") / g).cast("long"),
    })
    fkey = KEY + ["fy", "fx"]
    # two distinct hashes prove two distinct vehicles; a hash collision can only
    # hide density, which sends the cell down the exact probe path instead
    vh = F.xxhash64("vehicle_id")
    cells = pts.groupBy(*fkey).agg((F.min(vh) < F.max(vh)).alias("dense"))
    tagged = pts.join(cells, fkey)

    dense = tagged.filter("dense").select(*KEY, "vehicle_id")

    cg = p.coarse_cell_deg
    dlat, dlon = reach_deg(F.col("lat"), p.bunch_m)
    cy = F.sequence(F.floor((F.col("lat") - dlat) / cg).cast("long"), F.floor((F.col("lat") + dlat) / cg).cast("long"))
    cx = F.sequence(F.floor((F.col("lon") - dlon) / cg).cast("long"), F.floor((F.col("lon") + dlon) / cg).cast("long"))
    probes = (tagged.filter(~F.col("dense"))
                    .select(*KEY, F.col("vehicle_id").alias("pv"), F.col("lat").alias("plat"),
                            F.col("lon").alias("plon"), cy.alias("_cy"), cx.alias("_cx"))
                    .withColumn("cy", F.explode("_cy"))
                    .withColumn("cx", F.explode("_cx"))
                    .drop("_cy", "_cx"))
    targets = pts.select(*KEY, F.col("vehicle_id").alias("tv"), F.col("lat").alias("tlat"),
                         F.col("lon").alias("tlon"),
                         F.floor(F.col("lat") / cg).cast("long").alias("cy"),
                         F.floor(F.col("lon") / cg).cast("long").alias("cx"))
    # evaluate the distance in the reference's argument order (smaller vehicle first)
    first = F.col("pv") < F.col("tv")
    dist = F.when(first, haversine_m("plat", "plon", "tlat", "tlon")).otherwise(
        haversine_m("tlat", "tlon", "plat", "plon"))
    ckey = KEY + ["cy", "cx"]
    probes, targets = _salted(probes, targets, ckey, p)
    cond = [probes[c] == targets[c] for c in ckey + ["_salt"]] + [F.col("pv") != F.col("tv"), dist < F.lit(p.bunch_m)]
    # the first hit of a probe settles it
    matched = probes.join(targets, cond, "left_semi").select(*KEY, F.col("pv").alias("vehicle_id"))
    return dense.unionByName(matched).distinct()


def _salted(probes: DataFrame, targets: DataFrame, ckey: list[str], p: Params) -> tuple[DataFrame, DataFrame]:
    """Deal the targets of a coarse cell over ceil(n / salt_rows) salts, n being
    the cell's own count, and send every probe of the cell to each of them, so
    a pair meets exactly once however many points a cell holds."""
    salts = (targets.groupBy(*ckey).agg(F.ceil(F.count(F.lit(1)) / F.lit(p.salt_rows)).alias("_s")).filter("_s > 1"))
    n = F.coalesce(F.col("_s"), F.lit(1))
    dealt = targets.join(salts, ckey, "left").withColumn("_salt", F.pmod(F.xxhash64("tv", "tlat", "tlon"), n)).drop("_s")
    every = probes.join(salts, ckey, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), n - 1))).drop("_s")
    return every, dealt


def flag_bunching(pings: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Add is_bunched to every ping (left join on snapshot, route, vehicle).  The
    flagged side holds one narrow row per key at most: it is hashed, so the pings need no sort."""
    flagged = close_vehicles(pings, p).withColumn("_b", F.lit(True)).hint("shuffle_hash")
    out = pings.join(flagged, KEY + ["vehicle_id"], "left")
    b = F.coalesce(F.col("_b"), F.lit(False))
    if p.strict_bunching:
        b = b & F.col("is_moving")
    return out.withColumn("is_bunched", b).drop("_b")
