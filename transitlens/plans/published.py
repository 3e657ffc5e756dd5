"""The stored warehouse: a gated load job and a reader of what it published.

A load runs transform -> checks -> gate -> stage -> count check -> commit.
Every load writes its rows once, under ``<root>/<table>/run_id=<id>/``; a fact
is partitioned by ``date_key`` and clustered by its lookup columns.  A commit
names, per table, the folders that make up the new version: those of the load
for the dates it touched, those of earlier loads for all other dates.  So no
untouched partition is rewritten, readers see either the old version or the new
one, and a failed load leaves only folders that no commit names.

A commit is written under a hidden name and published by a rename to its number
that fails if the number exists, so a number never stands for an unfinished file:
of two loads that started from the same version the second fails instead of
losing the first one's rows, wherever either of them stopped in between.
The driver holds one path per table and date (dim_date bounds the dates), never
rows.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from transitlens.operators import metrics, quality, warehouse as W
from transitlens.plans import warehouse_build
from transitlens.session import materialize

# fact -> (merge keys, columns an update sets (None: all), clustering inside a date)
FACTS = {
    "fact_route_hour_speed": (["date_key", "hour_key", "route_key"], None, ["hour_key", "route_key"]),
    "fact_vehicle_ping": (["vehicle_key", "obs_ts"], W.PING_UPDATED, ["hour_key", "route_key"]),
}
DIMS = ["dim_date", "dim_hour", "dim_route", "dim_vehicle"]


class LoadConflict(RuntimeError):
    """Another load committed first."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def current(spark: SparkSession, root: str) -> dict | None:
    """The newest complete commit, or None before the first.  A damaged commit
    file does not parse and counts as none."""
    for name in reversed([n for n in _names(spark, f"{root}/_commits") if n.isdigit()]):
        fs, p = _fs(spark, f"{root}/_commits/{name}")
        stream = fs.open(p)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            continue
    return None


def _content(version: int, tables: dict, applied: dict | None) -> dict:
    return {"version": version, "tables": tables} | ({"applied": applied} if applied else {})


def _written_commit(spark: SparkSession, root: str, version: int, tables: dict, applied: dict | None = None) -> str:
    """A complete commit file under a name that no reader looks at."""
    path = f"{root}/_commits/.{version:010d}-{uuid.uuid4().hex}"
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps(_content(version, tables, applied)), "utf-8"))
    finally:
        out.close()
    return path


def _published_commit(spark: SparkSession, root: str, before: dict | None, version: int, written: str) -> None:
    """Give a written commit its number, unless another load has published since ``before``.  The rename fails if the
    number is taken, and a numbered file is complete from the moment it exists."""
    now = current(spark, root)
    if (now or {}).get("version") != (before or {}).get("version"):
        raise LoadConflict(f"{root} moved on to version {now['version']} during the load")
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    _, source = _fs(spark, written)
    _, target = _fs(spark, f"{root}/_commits/{version:010d}")
    files = hadoop.FileContext.getFileContext(source.toUri(), sc._jsc.hadoopConfiguration())
    try:
        files.rename(source, target, sc._gateway.new_array(hadoop.Options.Rename, 0))
    except Exception as e:
        raise LoadConflict(f"version {version} of {root} is taken") from e


def already_applied(version: dict | None, source: str, batch_id: int) -> bool:
    """Whether the version holds this batch of a source whose batch ids only grow."""
    return ((version or {}).get("applied") or {}).get(source, -1) >= batch_id


def _commit(spark: SparkSession, root: str, before: dict | None, tables: dict, source: str | None = None,
            batch_id: int | None = None) -> dict:
    """Publish the next version.  The last batch of every source is part of it: rows and batch id appear together."""
    applied = dict((before or {}).get("applied") or {}) | ({source: batch_id} if source is not None else {})
    version = max((int(n) for n in _names(spark, f"{root}/_commits") if n.isdigit()), default=0) + 1
    _published_commit(spark, root, before, version, _written_commit(spark, root, version, tables, applied))
    return _content(version, tables, applied)


def read_table(spark: SparkSession, root: str, name: str, version: dict | None = None,
               dates: list[int] | None = None) -> DataFrame:
    """One table of the current (or a given) version.  Only the folders of that
    version are listed; a filter on date_key prunes them, and ``dates`` leaves
    the folders of all other dates unlisted."""
    version = version or current(spark, root)
    if version is None:
        raise LookupError(f"nothing has been published under {root}")
    entry = version["tables"][name]
    schema = T.StructType.fromJson(entry["schema"])
    wanted = None if dates is None else {str(d) for d in dates}
    paths = [f"{root}/{name}/{p}" for d, p in entry["paths"].items() if wanted is None or d in wanted]
    if not paths:
        return spark.createDataFrame([], schema)
    typed = T.StructType(schema.fields + [T.StructField("run_id", T.StringType())])
    return spark.read.schema(typed).option("basePath", f"{root}/{name}").parquet(*paths).select(*schema.names)


def open_warehouse(spark: SparkSession, root: str) -> warehouse_build.Warehouse:
    """The published tables, for reports, lookups, model and prompt."""
    version = current(spark, root)
    read = {n: read_table(spark, root, n, version) for n in [*DIMS, *FACTS]}
    wh = warehouse_build.Warehouse(spark, None, None, dim_date=read["dim_date"], dim_hour=read["dim_hour"],
                                   fact_route_hour=read["fact_route_hour_speed"], fact_ping=read["fact_vehicle_ping"])
    # the constructor's dimensions are those to extend; these are final
    wh.dim_route, wh.dim_vehicle = read["dim_route"], read["dim_vehicle"]
    return wh


def open_route(spark: SparkSession, root: str, route_id: str, hour: int | None = None, first: int | None = None,
               last: int | None = None) -> warehouse_build.Warehouse:
    """The published tables of one route, for lookups (R6): facts of other dates than first..last (date keys) are not
    even listed, and row groups of other routes and hours are skipped by their statistics, since facts are clustered
    by hour and route.  The route's key, one integer, is looked up first; an unknown route has no facts."""
    version = current(spark, root)
    wh = open_warehouse(spark, root)
    found = wh.dim_route.filter(F.col("route_id") == F.lit(route_id)).select("route_key").limit(1).collect()
    wanted = F.col("route_key") == F.lit(found[0][0] if found else None).cast("int")
    if hour is not None:
        wanted = wanted & (F.col("hour_key") == F.lit(hour).cast("short"))
    for name, fact in (("fact_route_hour_speed", "fact_route_hour"), ("fact_vehicle_ping", "fact_ping")):
        dates = [int(d) for d in version["tables"][name]["paths"] if (first is None or int(d) >= first) and (last is None or int(d) <= last)]
        setattr(wh, fact, read_table(spark, root, name, version, dates).filter(wanted))
    return wh


def _stage(spark: SparkSession, df: DataFrame, root: str, name: str, run: str, cluster: list[str] | None) -> dict:
    """Write the rows of one table of this load and count what arrived (K6)."""
    path = f"{root}/{name}/run_id={run}"
    seen = Observation(f"staged_{name}")
    schema = df.schema
    if cluster:
        df = df.repartitionByRange("date_key", *cluster).sortWithinPartitions("date_key", *cluster)
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))   # after the exchange: its sampling reads the input too
    if cluster:
        df.write.mode("errorifexists").partitionBy("date_key").parquet(path)
        dates = [n for n in _names(spark, path) if n.startswith("date_key=")]
        paths = {n.removeprefix("date_key="): f"run_id={run}/{n}" for n in dates}
    else:
        df.write.mode("errorifexists").parquet(path)
        paths = {"": f"run_id={run}"}
    written, found = int(seen.get["rows"]), spark.read.schema(schema).parquet(path).count()
    if found != written:
        raise RuntimeError(f"staged {found} of {written} rows of {name}")
    return {"schema": schema.jsonValue(), "paths": paths}


def add_batch(spark: SparkSession, root: str, name: str, rows: DataFrame, keys: list[str], sums: list[str],
              source: str, batch_id: int) -> dict:
    """E5: add the ``sums`` of a batch to an aggregate table, once however often the batch arrives.

    ``rows`` hold date_key, ``keys`` and ``sums``, any number of rows per key; a null in a sum counts as 0, null keys
    are keys.  The batch id is part of the commit, so a batch replayed after its commit is recognised, and one that
    failed before it left nothing that a version names.  Only the touched dates are read and written."""
    before = current(spark, root)
    if already_applied(before, source, batch_id):
        return before
    key = ["date_key", *keys]
    total = [F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0))).alias(c) for c in sums]
    part = materialize(rows.groupBy(*key).agg(*total), f"{name}-batch")
    tables = dict((before or {"tables": {}})["tables"])
    old = tables.get(name)
    touched = dates_of(part)
    if old:
        part = read_table(spark, root, name, before, touched).select(*key, *sums).unionByName(part).groupBy(*key).agg(*total)
    new = _stage(spark, part, root, name, uuid.uuid4().hex, keys)
    tables[name] = new | {"paths": (old["paths"] if old else {}) | new["paths"]}
    return _commit(spark, root, before, tables, source, batch_id)


def dates_of(df: DataFrame) -> list[int]:
    """The distinct date keys, which the calendar bounds."""
    return sorted(r[0] for r in df.select("date_key").distinct().collect())


def gated_load(spark: SparkSession, root: str, pings: DataFrame, route_hours: DataFrame | None = None,
               ping_checks=None, route_hour_checks=None) -> dict:
    """Check the transformed batch, and publish it as the next version.

    Raises quality.QualityGateError before anything is written when a check
    fails, LoadConflict when another load committed meanwhile; the version read
    so far stays.  Rows of known keys are updated, others inserted or kept, in
    the touched dates; rows without a dimension key are not loaded and counted
    in ``quarantined``.  An empty batch fails the row-count check.
    Returns {"version", "checks", "quarantined"}.
    """
    # six of the steps below read the route-hours, which are few: computed once, not per reader
    rh = materialize(route_hours if route_hours is not None else metrics.route_hour(pings), "route-hours")
    checks = quality.gate(
        quality.run_suite(pings, "vehicle_pings_clean", ping_checks or quality.pings_suite()).unionByName(
            quality.run_suite(rh, "route_hour_speed", route_hour_checks or quality.route_hour_suite())))

    before, run = current(spark, root), uuid.uuid4().hex
    old = {n: read_table(spark, root, n, before) for n in [*DIMS, *FACTS]} if before else {}
    wh = warehouse_build.load(spark, pings, rh, old.get("dim_route"), old.get("dim_vehicle"))
    tables, new = wh.tables(), {}
    for name in DIMS:
        new[name] = _stage(spark, tables[name], root, name, run, None)
    for name, (keys, updated, cluster) in FACTS.items():
        batch = tables[name]
        if before:
            touch = {"loaded_at": F.current_timestamp()} if "loaded_at" in batch.columns else None
            batch = W.merge(W.touched_slice(old[name], batch, "date_key"), batch, keys, updated, touch)
        new[name] = _stage(spark, batch, root, name, run, cluster)
        if before:
            new[name]["paths"] = before["tables"][name]["paths"] | new[name]["paths"]
    lost = {"fact_route_hour_speed": wh.quarantine_route_hour.count(), "fact_vehicle_ping": wh.quarantine_ping.count()}
    return {"version": _commit(spark, root, before, new)["version"], "checks": len(checks), "quarantined": lost}
