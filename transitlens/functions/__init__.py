"""Column -> Column expressions.  All are built from Spark built-ins so they
stay inside whole-stage codegen; none is a Python UDF."""
from transitlens.functions.geo import haversine_m
from transitlens.functions.timefn import (
    epoch_of_ntz, local_ntz, local_date, local_hour, local_dow, local_midnight_epoch,
    gtfs_seconds, trip_part,
)
from transitlens.functions.fmt import hour_label, day_part, date_key, day_name, round_avg, dec_round

__all__ = [
    "haversine_m", "epoch_of_ntz", "local_ntz", "local_date",
    "local_hour", "local_dow", "local_midnight_epoch", "gtfs_seconds", "trip_part",
    "hour_label", "day_part", "date_key", "day_name", "round_avg", "dec_round",
]
