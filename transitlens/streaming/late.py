"""Out-of-order and late reports in a stream (E2, E3): keyed state with a reorder
buffer, event-time timers, state expiry and a side output.

The clock of the stream is the fetch time of the snapshots, which only moves
forward; a report's own epoch may lie behind it.  A report is on time if it was
fetched at most ``bound_s`` seconds after its epoch.  On-time reports wait in
their vehicle's buffer until the clock has passed epoch + bound: by then every
on-time report of that epoch has come, so they leave in exact epoch order, one
per (vehicle, epoch) by the batch survivor rule, with the gap and distance to
the previous one: what the batch computes over the on-time reports, whatever the
order of arrival and however the input is cut into micro-batches.  A late report
leaves at once, as a row of kind ``late``.  ``n_reports`` counts the copies a row
stands for, so rows of both kinds add up to all valid reports.

A buffer holds one entry per distinct epoch of one vehicle within the bound.  A
timer wakes vehicles that fall silent; after ``expire_s`` seconds without a
report a vehicle's state is removed, and its next report starts anew (no gap).

Vehicles are dealt into groups by a hash, and a group is one key of the state: the function is called per group and
micro-batch, since a call costs far more than the few reports of a vehicle.  Each vehicle of a group has its own
buffer, clock position and expiry.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from transitlens.streaming.stream import _haversine_np

OUT = T.StructType([T.StructField(n, t) for n, t in (
    ("kind", T.StringType()), ("vehicle_id", T.StringType()), ("obs_epoch", T.LongType()), ("snapshot_id", T.StringType()),
    ("route_id", T.StringType()), ("trip_id", T.StringType()), ("lat", T.DoubleType()), ("lon", T.DoubleType()),
    ("n_reports", T.LongType()), ("gap_s", T.LongType()), ("dist_m", T.DoubleType()))])
STATE = T.StructType([T.StructField("vehicles", T.StringType())])
REPORT = ["vehicle_id", "obs_epoch", "snapshot_id", "route_id", "trip_id", "lat", "lon", "arrived_s"]

FLUSH = 20_000              # rows put out together


def _nulls_first(fields) -> tuple:
    return tuple((x is not None, x) for x in fields)


def _frame(rows: list):
    import pandas as pd
    pdf = pd.DataFrame(rows, columns=OUT.names)
    for c in ("gap_s", "n_reports"):
        pdf[c] = pdf[c].astype("Int64")
    pdf["dist_m"] = pdf["dist_m"].astype(float)
    return pdf


def _reorder(bound_s: int, expire_s: int):
    def reorder(key, batches, state):
        # vehicle: [epoch, lat, lon of the last row out, {epoch: [snapshot, route, trip, lat, lon, copies]}]
        vehicles = {v: [e, y, x, {int(t): row for t, row in held.items()}]
                    for v, e, y, x, held in json.loads(state.get[0] if state.exists else "[]")}
        out = []
        if not state.hasTimedOut:
            for pdf in batches:
                columns = ([None if x != x else x for x in pdf[c].tolist()] for c in REPORT)
                for vehicle, e, snapshot, route, trip, y, x, arrived in zip(*columns):
                    e = int(e)
                    if arrived is None or arrived - e > bound_s:
                        out.append(("late", vehicle, e, snapshot, route, trip, y, x, 1, None, None))
                        continue
                    buffer = vehicles.setdefault(vehicle, [None, None, None, {}])[3]
                    row, known = [snapshot, route, trip, y, x], buffer.get(e)
                    if known is None:
                        buffer[e] = [*row, 1]
                    else:
                        buffer[e] = [*min(row, known[:5], key=_nulls_first), known[5] + 1]
                if len(out) >= FLUSH:
                    yield _frame(out)
                    out = []
        clock_ms = state.getCurrentWatermarkMs()
        kept, first = [], None
        for vehicle, (epoch, lat, lon, buffer) in vehicles.items():
            for e in sorted(e for e in buffer if (e + bound_s) * 1000 <= clock_ms):
                snapshot, route, trip, y, x, copies = buffer.pop(e)
                gap = dist = None
                if epoch is not None:
                    gap, dist = e - epoch, float(_haversine_np(lat, lon, y, x))
                out.append(("on_time", vehicle, e, snapshot, route, trip, y, x, copies, gap, dist))
                epoch, lat, lon = e, y, x
            if len(out) >= FLUSH:
                yield _frame(out)
                out = []
            wake = min(buffer) + bound_s if buffer else epoch + bound_s + expire_s
            if buffer or wake * 1000 > clock_ms:
                kept.append((vehicle, epoch, lat, lon, buffer))
                first = wake if first is None else min(first, wake)
        if kept:
            state.update((json.dumps(kept),))
            state.setTimeoutTimestamp(max(first * 1000, clock_ms + 1))
        elif state.exists:
            state.remove()
        if out:
            yield _frame(out)
    return reorder


def reordered(pos: DataFrame, arrived_s, bound_s: int = 7200, expire_s: int = 30 * 86400, clock_delay: str = "1 day",
              groups: int = 1024) -> DataFrame:
    """On-time reports in order, with gap and distance, and late ones.  ``arrived_s``: the fetch time of a report in
    epoch seconds; ``clock_delay``: how far fetch times may lie apart among files that are read side by side;
    ``groups``: into how many groups vehicles are dealt."""
    raw = (pos.withColumn("arrived_s", arrived_s.cast("long")).withColumn("arrived", F.timestamp_seconds("arrived_s"))
           .withWatermark("arrived", clock_delay).select(F.pmod(F.xxhash64("vehicle_id"), F.lit(groups)).alias("group"), *REPORT, "arrived"))
    return raw.groupBy("group").applyInPandasWithState(
        _reorder(bound_s, expire_s), OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
