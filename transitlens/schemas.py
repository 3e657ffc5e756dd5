"""Declared schemas and layouts.  Snapshots are read with RAW; text tables with
their own header, every column as text.  ``typed`` then gives the columns of a
layout, so a missing field is null rather than an analysis error."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from transitlens.functions.timefn import gtfs_seconds

# Raw vehicle-position record as landed by the ingestion job (flat object).
RAW = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("vehicle_timestamp", T.LongType()),
    T.StructField("fetched_at", T.StringType()),
])


@dataclass(frozen=True)
class Field:
    """A typed column: ``name`` is read from ``source`` as ``type``; text is
    trimmed unless it is kept as it came.  Values that do not fit are null."""
    name: str
    source: str
    type: str = "string"
    trimmed: bool = True

    def of(self, present: set[str]) -> Column:
        if self.source not in present:
            return F.lit(None).cast("long" if self.type == "clock" else self.type).alias(self.name)
        value = F.col(self.source)
        if self.type == "clock":
            return gtfs_seconds(value).alias(self.name)
        value = value.try_cast(self.type)
        return (F.trim(value) if self.type == "string" and self.trimmed else value).alias(self.name)


def typed(df: DataFrame, layout: list[Field]) -> DataFrame:
    """The columns of ``layout``, whatever the order or number of the input's."""
    present = set(df.columns)
    return df.select(*(f.of(present) for f in layout))


_POSITION = {f.name: f for f in (
    Field("vehicle_id", "vehicle_id", trimmed=False), Field("trip_id", "trip_id"), Field("obs_epoch", "vehicle_timestamp", "long"),
    Field("lat", "latitude", "double"), Field("lon", "longitude", "double"))}
# What each job adds to a position.
SPEED_POSITIONS = [*_POSITION.values(), Field("route_id", "route_id"), Field("snapshot_id", "fetched_at", trimmed=False)]
DELAY_POSITIONS = [*_POSITION.values(), Field("route_id_rt", "route_id", trimmed=False), Field("speed", "speed", "double")]

TIMETABLE = {
    "stop_times": [Field("trip_id", "trip_id"), Field("stop_id", "stop_id"), Field("stop_sequence", "stop_sequence", "int"),
                   Field("sched_arrival_sec", "arrival_time", "clock")],
    "stops": [Field("stop_id", "stop_id"), Field("stop_name", "stop_name", trimmed=False), Field("stop_lat", "stop_lat", "double"),
              Field("stop_lon", "stop_lon", "double")],
    "trips": [Field("trip_id", "trip_id"), Field("route_id", "route_id", trimmed=False)],
    "routes": [Field(c, c, trimmed=False) for c in ("route_id", "route_short_name", "route_long_name")],
}
