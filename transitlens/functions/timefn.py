"""Epoch / local-time helpers that never depend on the session time zone.

Local wall-clock values are obtained with convert_timezone on TIMESTAMP_NTZ,
so a job gives the same dates and hours whatever spark.sql.session.timeZone
is set to; the zone is always an explicit argument.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_of_ntz(ts) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), _c(ts))


def utc_ntz(epoch) -> Column:
    return F.timestamp_add("SECOND", _c(epoch), F.expr(_EPOCH_NTZ))


def local_ntz(epoch, zone: str) -> Column:
    """Local wall-clock TIMESTAMP_NTZ of an epoch-seconds value in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ntz(epoch))


def local_date(epoch, zone: str) -> Column:
    return F.to_date(local_ntz(epoch, zone))


def local_hour(epoch, zone: str) -> Column:
    return F.hour(local_ntz(epoch, zone))


def local_dow(epoch, zone: str) -> Column:
    """Day of week 1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(local_ntz(epoch, zone))


def local_midnight_epoch(day, zone: str) -> Column:
    """Epoch seconds of 00:00 local time on ``day`` (a DATE column)."""
    midnight_local = _c(day).cast("timestamp_ntz")
    return epoch_of_ntz(F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight_local))


def gtfs_seconds(hms) -> Column:
    """'HH:MM:SS' -> seconds after midnight; HH may exceed 23.  Malformed or
    blank input gives null instead of failing the job (ANSI mode is on)."""
    parts = F.split(F.trim(_c(hms)), ":")
    h, m, s = (F.get(parts, F.lit(i)).try_cast("int") for i in range(3))
    return h * 3600 + m * 60 + s


def trip_part(trip_id, index: int) -> Column:
    """Integer field ``index`` of an underscore-separated trip id (route_HH_MM[_seq])."""
    return F.get(F.split(_c(trip_id), "_"), F.lit(index)).try_cast("int")
