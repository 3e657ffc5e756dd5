"""Nearest scheduled stop by a search over growing rings (J1, J3, W2 without the fan-out).

``delays.candidates`` joins a ping with every stop of its trip.  So does this search for trips of at most ``FEW_STOPS``
stops.  The stops of longer trips lie in a grid, and a ping meets only the cells that its box of
half-side ``radius`` touches.  A hit closer than that radius (less a metre, far
more than the rounding of the tie-break) can't be beaten from outside the box,
so the ping is settled; the others go on to the next, larger ring, and after the
last one to the whole trip.  The join key is (trip, cell), so a trip with a third
of all pings is dealt by cell.

The first ring of a ping depends on how many stops of its trip lie in its cell of the smallest given ring: the radius
is halved until that cell would hold one to four stops if they lay evenly, so a trip with more stops gets smaller
rings and not more candidates per ping.  Hits beyond the radius settle nothing and are left out before the minimum.

Cells are 360 degrees / n on a side with whole n, so the grid closes at the date
line.  Where a box spans more than ``MOST_CELLS`` cells (close to the poles), and
for trips with a stop beyond a pole (malformed, but the reference measures it),
a ping waits for the last step.  Stops without a position or a scheduled time
are no candidates; ``malformed_stops`` counts them.

Each ring's open pings are written, so a lost executor repeats one ring at most,
and the search ends with the first ring that leaves none open.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from transitlens.config import DEFAULT, EARTH_RADIUS_M, Params
from transitlens.functions.geo import reach_deg
from transitlens.operators import delays
from transitlens.session import materialize

RINGS_M = (250.0, 1_000.0, 4_000.0, 16_000.0)
MOST_CELLS = 9
FEW_STOPS = 16
LEAST_RADIUS_M = 2.0        # a ring settles within a metre less
REPORT = ["vehicle_id", "obs_epoch", "trip_id", "lat", "lon"]
WHOLE = "stop_lat is not null and stop_lon is not null and sched_arrival_sec is not null"


def malformed_stops(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """(trip_id, n_malformed): stops of a trip that no search can return."""
    return (stop_times.join(stops, "stop_id").filter(f"not ({WHOLE})")
            .groupBy("trip_id").agg(F.count(F.lit(1)).alias("n_malformed")))


def _side(radius: float) -> tuple[float, int]:
    """(side in degrees, cells round the globe): no side is shorter than the radius."""
    n = int(360.0 // math.degrees(radius / EARTH_RADIUS_M))
    return 360.0 / n, n


def _column_of(lon, side: float):
    return F.floor((lon + 180.0) / side)


def _ring(open_: DataFrame, timetable: DataFrame, radius: float) -> DataFrame:
    """Pings with the stops in the cells of their box."""
    side, n = _side(radius)
    dlat, dlon = reach_deg("lat", radius)
    lat, lon = F.col("lat"), F.col("lon")
    west, east = _column_of(lon - dlon, side), _column_of(lon + dlon, side)
    probes = (open_.filter((east - west < MOST_CELLS) & (F.abs(lat) <= 90))
              .withColumn("cy", F.explode(F.sequence(F.floor((lat - dlat) / side), F.floor((lat + dlat) / side))))
              .withColumn("cx", F.explode(F.sequence(west, east))).withColumn("cx", F.pmod("cx", F.lit(n))))
    cells = timetable.withColumns({"cy": F.floor(F.col("stop_lat") / side), "cx": F.pmod(_column_of(F.col("stop_lon"), side), F.lit(n))})
    return probes.join(cells, ["trip_id", "cy", "cx"]).drop("cy", "cx")


def _started(pings: DataFrame, timetable: DataFrame, smallest: float) -> DataFrame:
    """Pings with ``halvings``: how often the smallest given radius is halved for their first ring."""
    side, n = _side(smallest)
    cell = lambda lat, lon: {"cy": F.floor(F.col(lat) / side), "cx": F.pmod(_column_of(F.col(lon), side), F.lit(n))}
    dense = (timetable.withColumns(cell("stop_lat", "stop_lon")).groupBy("trip_id", "cy", "cx")
             .agg(F.floor(F.log2(F.count(F.lit(1))) / 2).cast("int").alias("h")).filter("h > 0"))
    most = max(0, math.floor(math.log2(smallest / LEAST_RADIUS_M)))
    return (pings.withColumns(cell("lat", "lon")).join(dense, ["trip_id", "cy", "cx"], "left")
            .withColumn("halvings", F.least(F.coalesce("h", F.lit(0)), F.lit(most))).drop("cy", "cx", "h"))


def nearest_by_rings(pos: DataFrame, stop_times: DataFrame, stops: DataFrame, p: Params = DEFAULT,
                     rings: tuple[float, ...] = RINGS_M) -> DataFrame:
    """What ``delays.nearest_stop(delays.candidates(pos, ...))`` returns, a row per (vehicle_id, obs_epoch)."""
    asked = stop_times.join(pos.select("trip_id").distinct(), "trip_id", "left_semi")
    timetable = materialize(asked.join(stops, "stop_id").filter(WHOLE), "trip-stops")
    sizes = timetable.groupBy("trip_id").agg((F.count(F.lit(1)) <= FEW_STOPS).alias("few"),
                                             F.max(F.abs("stop_lat") > 90).alias("beyond"))
    whole = F.col("few") | F.col("beyond")
    stops_of_long = timetable.join(sizes.filter(~whole), "trip_id", "left_semi")
    open_ = materialize(_started(pos.join(sizes.select("trip_id", whole.alias("whole")), "trip_id"), stops_of_long, rings[0]), "ring-0")
    columns = [*pos.columns, "halvings"]
    last = open_.filter("whole").select(*columns)
    open_ = open_.filter("not whole").select(*columns)
    halvings = sorted((r[0] for r in open_.select("halvings").distinct().collect()), reverse=True)
    found = []
    for i, radius in enumerate([*(rings[0] / 2 ** h for h in halvings if h > 0), *rings]):
        now = open_.filter(F.lit(rings[0]) / F.pow(F.lit(2.0), "halvings") <= radius)
        pairs = delays.with_distance(_ring(now, stops_of_long, radius)).filter(F.col("dist_to_stop_m") <= radius)
        settled = materialize(delays.nearest_stop(pairs, p).filter(F.col("dist_to_stop_m") <= radius - 1.0), f"settled-{i}")
        found.append(settled)
        open_ = materialize(open_.join(settled.select(*REPORT), REPORT, "left_anti"), f"ring-{i + 1}")
        if open_.isEmpty():
            break
    rest = delays.with_distance(open_.unionByName(last).drop("halvings").join(timetable, "trip_id")).drop("stop_lat", "stop_lon")
    # reports of one (vehicle_id, obs_epoch) may differ and be settled apart; the nearest of their stops stays
    for f in found:
        rest = rest.unionByName(f.select(*rest.columns))
    return delays.nearest_stop(rest, p)
