"""Warehouse integrity checks and post-load audits.

Each table is checked in one aggregate pass: facts are left-joined to the
dimensions they reference (dimensions are small; AQE broadcasts them from
runtime sizes) and every constraint becomes a conditional count.  Nothing is
collected.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from transitlens.operators.warehouse import duplicate_count


def _nulls(cols):
    return F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def _long(table: str, agg_row: DataFrame, names: list[str]) -> DataFrame:
    items = [F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("constraint_name"),
                      F.col(n).cast("long").alias("violations")) for n in names]
    return agg_row.select(F.inline(F.array(*items)))


def _with_fk(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return fact.join(dim.select(key, F.lit(True).alias(f"_in_{key}")).dropDuplicates([key]), key, "left")


def check_warehouse(wh) -> DataFrame:
    frh = wh.fact_route_hour
    for d, k in ((wh.dim_date, "date_key"), (wh.dim_hour, "hour_key"), (wh.dim_route, "route_key")):
        frh = _with_fk(frh, d, k)
    rh_row = frh.agg(
        duplicate_count(frh, ["date_key", "hour_key", "route_key"]).alias("pk"),
        F.count_if(F.col("_in_date_key").isNull()).alias("fk_date"),
        F.count_if(F.col("_in_hour_key").isNull()).alias("fk_hour"),
        F.count_if(F.col("_in_route_key").isNull()).alias("fk_route"),
        _nulls(["n_pings", "n_vehicles", "n_speed_obs", "n_moving", "n_bunched"]).alias("not_null"))
    fp = wh.fact_ping
    for d, k in ((wh.dim_date, "date_key"), (wh.dim_hour, "hour_key"), (wh.dim_route, "route_key"),
                 (wh.dim_vehicle, "vehicle_key")):
        fp = _with_fk(fp, d, k)
    fp_row = fp.agg(
        duplicate_count(fp, ["vehicle_key", "obs_ts"]).alias("unique_vehicle_obs"),
        F.count_if(F.col("_in_date_key").isNull()).alias("fk_date"),
        F.count_if(F.col("_in_hour_key").isNull()).alias("fk_hour"),
        F.count_if(F.col("_in_route_key").isNull()).alias("fk_route"),
        F.count_if(F.col("_in_vehicle_key").isNull()).alias("fk_vehicle"),
        _nulls(["lat", "lon", "is_speed_valid", "is_moving", "is_bunched"]).alias("not_null"))
    parts = [
        _long("fact_route_hour_speed", rh_row, ["pk", "fk_date", "fk_hour", "fk_route", "not_null"]),
        _long("fact_vehicle_ping", fp_row, ["unique_vehicle_obs", "fk_date", "fk_hour", "fk_route", "fk_vehicle", "not_null"]),
        _long("dim_hour", wh.dim_hour.agg(F.count_if(~F.col("hour_key").between(0, 23)).alias("check_hour_range")),
              ["check_hour_range"]),
        _long("dim_date", wh.dim_date.agg(duplicate_count(wh.dim_date, ["full_date"]).alias("unique_full_date")),
              ["unique_full_date"]),
        _long("dim_route", wh.dim_route.agg(duplicate_count(wh.dim_route, ["route_id"]).alias("unique_route_id")),
              ["unique_route_id"]),
        _long("dim_vehicle", wh.dim_vehicle.agg(duplicate_count(wh.dim_vehicle, ["vehicle_id"]).alias("unique_vehicle_id")),
              ["unique_vehicle_id"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicate_audit(wh) -> DataFrame:
    """One row: duplicate natural keys of route-hour facts, ping facts, routes, vehicles."""
    parts = [
        wh.fact_route_hour.agg(duplicate_count(wh.fact_route_hour, ["date_key", "hour_key", "route_key"]).alias("dup_route_hour")),
        wh.fact_ping.agg(duplicate_count(wh.fact_ping, ["vehicle_key", "obs_ts"]).alias("dup_ping")),
        wh.dim_route.agg(duplicate_count(wh.dim_route, ["route_id"]).alias("dup_route")),
        wh.dim_vehicle.agg(duplicate_count(wh.dim_vehicle, ["vehicle_id"]).alias("dup_vehicle")),
    ]
    return reduce(lambda a, b: a.crossJoin(b), parts)  # single-row aggregates
