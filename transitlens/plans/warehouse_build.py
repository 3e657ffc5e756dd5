"""Build (or upsert) the star schema from pings and route-hour rows.

Tables are built lazily on first access, so a report that only reads the
route-hour fact never allocates vehicle keys.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from transitlens.operators import metrics, warehouse as W


class Warehouse:
    def __init__(self, spark: SparkSession, pings: DataFrame | None, rh: DataFrame | None,
                 dim_route: DataFrame | None = None, dim_vehicle: DataFrame | None = None,
                 materialize_keys: bool = True, **tables: DataFrame):
        self._spark, self._pings, self._rh = spark, pings, rh
        self._dr0, self._dv0, self._mat = dim_route, dim_vehicle, materialize_keys
        for k, v in tables.items():       # pre-built tables (tests, readers)
            self.__dict__[k] = v

    @cached_property
    def dim_date(self) -> DataFrame:
        return W.dim_date(self._spark)

    @cached_property
    def dim_hour(self) -> DataFrame:
        return W.dim_hour(self._spark)

    @cached_property
    def dim_route(self) -> DataFrame:
        ids = self._pings.select("route_id").unionByName(self._rh.select("route_id"))
        base = self._dr0 if self._dr0 is not None else W.empty_dim_route(self._spark)
        return W.upsert_dim(base, ids, "route_id", "route_key", materialize=self._mat)

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        base = self._dv0 if self._dv0 is not None else W.empty_dim_vehicle(self._spark)
        return W.upsert_dim(base, self._pings.select("vehicle_id"), "vehicle_id", "vehicle_key", materialize=self._mat)

    @cached_property
    def _frh(self):
        return W.fact_route_hour(self._rh, self.dim_route, self.dim_date)

    @cached_property
    def _fp(self):
        return W.fact_ping(self._pings, self.dim_route, self.dim_vehicle, self.dim_date)

    @cached_property
    def fact_route_hour(self) -> DataFrame:
        return self._frh[0]

    @cached_property
    def quarantine_route_hour(self) -> DataFrame:
        return self._frh[1]

    @cached_property
    def fact_ping(self) -> DataFrame:
        return self._fp[0]

    @cached_property
    def quarantine_ping(self) -> DataFrame:
        return self._fp[1]

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_date": self.dim_date, "dim_hour": self.dim_hour, "dim_route": self.dim_route,
                "dim_vehicle": self.dim_vehicle, "fact_route_hour_speed": self.fact_route_hour,
                "fact_vehicle_ping": self.fact_ping}


def load(spark: SparkSession, pings: DataFrame, rh: DataFrame | None = None,
         dim_route: DataFrame | None = None, dim_vehicle: DataFrame | None = None,
         materialize_keys: bool = True) -> Warehouse:
    """Dimensions first (route ids from pings and route-hours, U4), then facts.
    Existing dimensions keep their keys; new ids are appended."""
    rh = rh if rh is not None else metrics.route_hour(pings)
    return Warehouse(spark, pings, rh, dim_route, dim_vehicle, materialize_keys)
