"""Star schema on Parquet: dimensions, surrogate keys, facts, upserts,
integrity checks and audits (S7, T1-T9, K3-K6, J9, J10, A9, A10, D-R1).

Parquet tables have no MERGE, so an upsert is a join of the source with the
touched slice of the target followed by a dynamic partition overwrite of
exactly the touched partitions.  Surrogate keys are allocated without a
global single-task row_number (see ``assign_keys``).
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from transitlens.config import DEFAULT, Params
from transitlens.functions.fmt import date_key, day_name, day_part, hour_label
from transitlens.session import materialize

# ---------------------------------------------------------------- dimensions


def dim_date(spark: SparkSession, start: _dt.date = DEFAULT.date_dim_start,
             end: _dt.date = DEFAULT.date_dim_end) -> DataFrame:
    """One row per calendar day in [start, end]."""
    d = F.col("full_date")
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select(
        date_key(d).alias("date_key"), d,
        F.year(d).cast("short").alias("year"), F.month(d).cast("short").alias("month"),
        F.dayofmonth(d).cast("short").alias("day"), F.dayofweek(d).cast("short").alias("day_of_week"),
        day_name(d).alias("day_name"), F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def dim_hour(spark: SparkSession) -> DataFrame:
    """24 rows, label 'HH:00-HH:59' and day part."""
    h = F.col("id")
    return spark.range(24).select(h.cast("short").alias("hour_key"), hour_label(h).alias("hour_label"),
                                  day_part(h).alias("day_part"))


def empty_dim(spark: SparkSession, key_col: str, id_col: str, extra: dict | None = None) -> DataFrame:
    fields = [T.StructField(key_col, T.IntegerType()), T.StructField(id_col, T.StringType())]
    for name, typ in (extra or {}).items():
        fields.append(T.StructField(name, typ))
    fields.append(T.StructField("first_seen_at", T.TimestampType()))
    return spark.createDataFrame([], T.StructType(fields))


def empty_dim_route(spark):
    return empty_dim(spark, "route_key", "route_id", {"route_long_name": T.StringType()})


def empty_dim_vehicle(spark):
    return empty_dim(spark, "vehicle_key", "vehicle_id")


def assign_keys(new_ids: DataFrame, id_col: str, key_col: str, base: Column | int = 0,
                materialize: bool = True) -> DataFrame:
    """Consecutive integer keys base+1, base+2, ... in ``id_col`` order.

    A global row_number would pull every id into one task.  Instead the ids
    are range-partitioned and sorted (distributed), each row's position inside
    its partition comes from monotonically_increasing_id, and partition
    offsets come from a per-partition count (one row per partition, a proven
    small table).  The sorted ids are checkpointed first so both uses see the
    same partitioning even if a task is re-run.
    """
    ids = new_ids.select(id_col).distinct()
    ordered = ids.repartitionByRange(id_col).sortWithinPartitions(id_col) \
        .withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33))
    if materialize:
        from transitlens.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(new_ids.sparkSession)
        ordered = ordered.checkpoint(eager=True)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0))).select("_pid", "_off")
    base_col = base if isinstance(base, Column) else F.lit(base)
    return (ordered.join(F.broadcast(offsets), "_pid")
                   .select((base_col + F.col("_off") + F.col("_pos") + 1).cast("int").alias(key_col), id_col))


def upsert_dim(dim: DataFrame, ids: DataFrame, id_col: str, key_col: str, now: Column | None = None,
               materialize: bool = True) -> DataFrame:
    """Insert ids not yet present (non-null, as strings); existing rows keep
    their keys.  Returns the full new dimension."""
    # distinct first: partial aggregation shrinks every ping's id to the set of
    # ids before anything is shuffled for the anti-join
    ids = ids.select(F.col(id_col).cast("string").alias(id_col)).filter(F.col(id_col).isNotNull()).distinct()
    new = ids.join(dim.select(id_col), id_col, "left_anti")
    base = dim.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("_base"))
    keyed = assign_keys(new, id_col, key_col, 0, materialize)
    # offset by the existing maximum (a one-row table)
    keyed = keyed.crossJoin(F.broadcast(base)).select((F.col(key_col) + F.col("_base")).cast("int").alias(key_col), id_col)
    now = now if now is not None else F.current_timestamp()
    extra = [c for c in dim.columns if c not in (key_col, id_col, "first_seen_at")]
    added = keyed.select(key_col, id_col, *(F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in extra),
                         now.alias("first_seen_at"))
    return dim.unionByName(added)


# ---------------------------------------------------------------- facts

RH_MEASURES = ["n_pings", "n_vehicles", "n_speed_obs", "n_moving", "avg_speed_kmph",
               "avg_moving_speed_kmph", "n_bunched"]
PING_UPDATED = ["trip_id", "gap_s", "dist_m", "speed_kmph", "is_speed_valid", "is_moving", "is_bunched"]


def _lookup(df: DataFrame, dim: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """Id -> surrogate key; unknown ids give a null key (quarantined later)."""
    return df.join(dim.select(id_col, key_col), id_col, "left")


def fact_route_hour(rh: DataFrame, dim_route: DataFrame, dates: DataFrame | None = None,
                    now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """T4: (facts, quarantine).  Rows whose route has no key or whose date is
    outside dim_date go to quarantine instead of violating a foreign key."""
    rh = nan_to_null(rh)
    x = _lookup(rh.withColumn("route_id", F.col("route_id").cast("string")), dim_route, "route_id", "route_key")
    x = x.withColumns({"date_key": date_key("service_date"), "hour_key": F.col("hour_of_day").cast("short")})
    bad = F.col("route_key").isNull() | F.col("date_key").isNull()
    if dates is not None:
        x = x.join(dates.select("date_key", F.lit(True).alias("_in_dim")), "date_key", "left")
        bad = bad | F.col("_in_dim").isNull()
    x = x.withColumn("_bad", bad)
    facts = x.filter(~F.col("_bad")).select(
        "date_key", "hour_key", "route_key",
        *(F.col(c).cast("int").alias(c) for c in ("n_pings", "n_vehicles", "n_speed_obs", "n_moving")),
        F.col("avg_speed_kmph").cast("decimal(7,2)").alias("avg_speed_kmph"),
        F.col("avg_moving_speed_kmph").cast("decimal(7,2)").alias("avg_moving_speed_kmph"),
        F.col("n_bunched").cast("int").alias("n_bunched"),
        (now if now is not None else F.current_timestamp()).alias("loaded_at"))
    quarantine = x.filter(F.col("_bad")).drop("_bad", "_in_dim")
    return facts, quarantine


def fact_ping(pings: DataFrame, dim_route: DataFrame, dim_vehicle: DataFrame,
              dates: DataFrame | None = None, ensure_unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """T5: ping facts keyed by (vehicle_key, obs_ts); doubles take the table's
    NUMERIC scales (explicit HALF_UP decimal casts)."""
    x = _lookup(nan_to_null(pings), dim_route, "route_id", "route_key")
    x = _lookup(x, dim_vehicle, "vehicle_id", "vehicle_key")
    x = x.withColumns({"date_key": date_key("service_date"), "hour_key": F.col("hour_of_day").cast("short")})
    bad = F.col("route_key").isNull() | F.col("vehicle_key").isNull() | F.col("date_key").isNull()
    if dates is not None:
        x = x.join(dates.select("date_key", F.lit(True).alias("_in_dim")), "date_key", "left")
        bad = bad | F.col("_in_dim").isNull()
    x = x.withColumn("_bad", bad)
    facts = x.filter(~F.col("_bad")).select(
        "obs_ts", "date_key", "hour_key", "route_key", "vehicle_key", "trip_id",
        F.col("dispatch_hour").cast("short").alias("dispatch_hour"),
        F.col("dispatch_minute").cast("short").alias("dispatch_minute"),
        F.col("lat").cast("decimal(9,6)").alias("lat"), F.col("lon").cast("decimal(9,6)").alias("lon"),
        F.col("gap_s").cast("int").alias("gap_s"),
        F.col("dist_m").cast("decimal(10,1)").alias("dist_m"),
        F.col("speed_kmph").cast("decimal(8,2)").alias("speed_kmph"),
        "is_speed_valid", "is_moving", "is_bunched")
    # pings from the speed flow are unique per (vehicle, epoch) by construction
    # (A11); sources of unknown quality can ask for the loaders' explicit
    # one-row-per-key guard, which costs a shuffle of the whole fact
    if ensure_unique:
        facts = facts.dropDuplicates(["vehicle_key", "obs_ts"])
    quarantine = x.filter(F.col("_bad")).drop("_bad", "_in_dim")
    return facts, quarantine


# ---------------------------------------------------------------- upsert


def merge(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str] | None = None,
          touch: dict[str, Column] | None = None) -> DataFrame:
    """Upsert ``source`` into ``target`` on ``keys``.

    Matched rows take ``update_cols`` from the source (all non-key columns
    when None) and keep the rest from the target; unmatched source rows are
    inserted; target rows without a match are kept.  ``touch`` gives column
    values set on every inserted or updated row (e.g. loaded_at).
    """
    cols = target.columns
    non_key = [c for c in cols if c not in keys]
    update_cols = non_key if update_cols is None else update_cols
    touch = touch or {}
    t = target.select(*keys, *(F.col(c).alias(f"_t_{c}") for c in non_key), F.lit(True).alias("_t"))
    s = source.select(*keys, *(F.col(c).alias(f"_s_{c}") for c in non_key if c in source.columns),
                      F.lit(True).alias("_s"))
    j = t.join(s, keys, "full_outer")
    in_s = F.col("_s").isNotNull()
    out = []
    for c in non_key:
        if c in touch:
            out.append(F.when(in_s, touch[c]).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(in_s, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            # partial update: keep the first-load value when the row existed
            out.append(F.when(F.col("_t").isNotNull(), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
    return j.select(*keys, *out).select(*cols)


def touched_slice(target: DataFrame, source: DataFrame, part_col: str) -> DataFrame:
    """Target rows in the partitions the source touches (semi join on the
    partition column: dynamic partition pruning skips the other files)."""
    return target.join(source.select(part_col).distinct(), part_col, "left_semi")


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str], part_col: str,
                 update_cols: list[str] | None = None, touch: dict | None = None) -> int:
    """Upsert into a Parquet table partitioned by ``part_col``: rewrite only the
    touched partitions.  They are staged in a folder of this call alone (never
    overwrite a path the same plan reads), the staged rows are counted against
    the source of the write, then published with dynamic partition overwrite,
    and the folder is deleted.  Both writes name their overwrite mode, so the
    session's does not matter.  Returns the number of rows written."""
    import uuid

    from pyspark.sql import Observation
    from transitlens.session import delete_path, path_exists, scratch_path
    if path_exists(spark, path):
        target = spark.read.parquet(path)
        merged = merge(touched_slice(target, source, part_col), source, keys, update_cols, touch)
    else:                                  # first load: the table does not exist yet
        merged = source
    staging = scratch_path(spark, f"staging/{uuid.uuid4().hex}")
    obs = Observation("staged")
    (merged.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").partitionBy(part_col).parquet(staging))
    written = int(obs.get["rows"])
    try:
        staged = spark.read.schema(merged.schema).parquet(staging)
        found = staged.count()
        if found != written:               # K6
            raise RuntimeError(f"staged {found} of {written} rows for {path}")
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path))
    finally:
        delete_path(spark, staging)
    return written


def write_partitioned(df: DataFrame, path: str, part_col: str, sort_cols: list[str] | None = None) -> None:
    """Parquet by ``part_col`` with dynamic partition overwrite; rows are
    clustered inside each partition for min/max skipping on lookups.  Range
    partitioning on (partition column, sort columns) spreads a large date over
    many tasks instead of sending a whole date to one task."""
    if sort_cols:
        df = df.repartitionByRange(part_col, *sort_cols).sortWithinPartitions(part_col, *sort_cols)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path)


# ---------------------------------------------------------------- integrity / audits


def duplicate_count(df: DataFrame, keys: list[str]) -> Column:
    """A10: COUNT(*) - COUNT(DISTINCT keys) (rows with a null key part are not
    counted by the multi-column distinct, as in SQL)."""
    return F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table (name, n_rows)."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(a: DataFrame, b: DataFrame) -> DataFrame:
    """D-R1: rows in exactly one of two copies of a table (empty = identical as bags)."""
    return (a.exceptAll(b).withColumn("side", F.lit("left_only"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("right_only"))))


def _row_digests(df: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Key hash and two hashes of the whole row, which tell nulls in different columns apart."""
    whole = [F.col(c) for c in cols] + [F.col(c).isNull() for c in cols]
    return df.select(*cols, F.xxhash64(*key, *(F.col(c).isNull() for c in key)).alias("_k"),
                     F.xxhash64(*whole).alias("_d1"), F.xxhash64(F.lit("second"), *whole).alias("_d2"))


def reconcile_by_digest(a: DataFrame, b: DataFrame, key: list[str], levels: tuple[int, ...] = (8, 8, 8)) -> DataFrame:
    """D-R1: what ``reconcile`` returns, without comparing equal rows.

    Both sides are summed into order-independent digests (row count and the sums of two
    row hashes) per range of the key's hash; ranges with equal digests are done, the
    others are divided again, ``levels`` bits at a time.  Only rows of the ranges that
    differ at the last level are compared.  A digest table has 2**bits rows per open
    range; ``key`` only deals the rows, it need not be unique."""
    cols = a.columns
    sides = [_row_digests(x, key, cols) for x in (a, b.select(*cols))]
    open_ = None
    bits = 0
    for more in levels:
        bits += more
        sums = []
        for x in sides:
            rows = x.withColumn("range", F.shiftrightunsigned("_k", 64 - bits))
            if open_ is not None:
                rows = rows.join(open_.withColumnRenamed("range", "_up"), F.shiftright("range", more) == F.col("_up"), "left_semi")
            sums.append(rows.groupBy("range").agg(F.count(F.lit(1)).alias("n"), *(
                F.sum(F.col(d).cast("decimal(38,0)")).alias(d) for d in ("_d1", "_d2"))))
        l, r = sums[0].alias("l"), sums[1].alias("r")
        same = F.lit(True)
        for c in ("n", "_d1", "_d2"):
            same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
        open_ = materialize(l.join(r, F.col("l.range") == F.col("r.range"), "full").filter(~same)
                            .select(F.coalesce("l.range", "r.range").alias("range")), f"differing-{bits}")
    left, right = (x.withColumn("range", F.shiftrightunsigned("_k", 64 - bits)).join(open_, "range", "left_semi").select(*cols) for x in sides)
    return reconcile(left, right)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null before a typed sink."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(F.isnan(f.name), F.lit(None)).otherwise(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


PARTITION_OF = {"fact_route_hour_speed": "date_key", "fact_vehicle_ping": "date_key"}


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, run_id: str) -> dict:
    """Stage every table of a load first, publish only when all staging
    writes succeeded.  Facts are published partition-wise (dynamic overwrite of
    the touched date partitions); dimensions are small and replaced whole.
    Returns the staged row count per table."""
    from pyspark.sql import Observation
    staged = {}
    for name, df in tables.items():
        obs = Observation(f"stage_{name}")
        # static: a retried run_id replaces all it staged before
        w = (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("partitionOverwriteMode", "static"))
        part = PARTITION_OF.get(name)
        (w.partitionBy(part) if part else w).parquet(f"{root}/_staging/{run_id}/{name}")
        staged[name] = int(obs.get["rows"])
    for name in tables:
        src = spark.read.parquet(f"{root}/_staging/{run_id}/{name}")
        part = PARTITION_OF.get(name)
        w = src.write.mode("overwrite")
        if part:
            w.option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(f"{root}/{name}")
        else:
            w.parquet(f"{root}/{name}")
    return staged
