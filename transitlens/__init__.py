"""transitlens: fleet-telemetry analytics expressed as Spark DataFrame plans.

Sub-packages
------------
functions   Column -> Column expressions (geo, time, formatting)
sources     readers: raw snapshot feed, static timetable, driver-table fixtures
operators   DataFrame -> DataFrame building blocks (pings, bunching, metrics,
            warehouse, quality, delays, diagnostics, model)
plans       composed reports, lookups and the query catalogue
streaming   Structured Streaming variants of the core path
"""
from transitlens.config import Params, DEFAULT

__all__ = ["Params", "DEFAULT"]
