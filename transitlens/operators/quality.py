"""Data-quality suites and the publication gate (Q1-Q14, K7).

All scalar checks of a suite are compiled into ONE aggregate over the
dataset (a single scan with partial aggregation); each compound-uniqueness
check adds one grouped aggregate.  The result is a small long-format
DataFrame (one row per check), which is the only thing the gate brings to
the driver.

Semantics follow the common expectation library conventions: range and set
checks ignore nulls; ``mostly`` is the share of non-null values that must
pass; unexpected_pct is relative to non-null values (to all rows for
not-null checks); a compound-uniqueness failure counts every member of a
duplicated key; a suite passes only if every check passes.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from transitlens.config import DEFAULT, Params


class QualityGateError(RuntimeError):
    """A suite failed; the load must not run."""


@dataclass(frozen=True)
class Check:
    check_id: str
    check_type: str
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    values: tuple = ()
    column_b: str | None = None
    or_equal: bool = True
    columns: tuple = ()
    mostly: float = 1.0
    kwargs: dict = field(default_factory=dict, compare=False)


def row_count_at_least(n: int) -> Check:
    return Check(f"row_count_ge_{n}", "row_count_between", min_value=n)


def not_null(c: str) -> Check:
    return Check(f"{c}_not_null", "not_null", c)


def between(c: str, lo=None, hi=None, mostly: float = 1.0) -> Check:
    return Check(f"{c}_between_{lo}_{hi}" + (f"_mostly_{mostly}" if mostly < 1 else ""), "between", c, lo, hi,
                 mostly=mostly)


def in_set(c: str, values) -> Check:
    return Check(f"{c}_in_set", "in_set", c, values=tuple(values))


def pair_ge(a: str, b: str, or_equal: bool = True) -> Check:
    return Check(f"{a}_ge_{b}", "pair_a_ge_b", a, column_b=b, or_equal=or_equal)


def unique(*cols: str) -> Check:
    return Check("unique_" + "_".join(cols), "compound_unique", columns=tuple(cols))


def pings_suite(p: Params = DEFAULT) -> list[Check]:
    """The 12 checks on vehicle_pings_clean."""
    return [
        row_count_at_least(1),
        not_null("vehicle_id"), not_null("route_id"), not_null("obs_ts"),
        between("lat", p.lat_min, p.lat_max), between("lon", p.lon_min, p.lon_max),
        between("hour_of_day", 0, 23), between("day_of_week", 1, 7),
        # jumps are flagged, not dropped: a small share above the cap is allowed
        between("speed_kmph", 0, p.max_kmph, mostly=0.95),
        in_set("is_moving", (True, False)), in_set("is_bunched", (True, False)),
        unique("vehicle_id", "obs_ts"),
    ]


def route_hour_suite(p: Params = DEFAULT) -> list[Check]:
    """The 14 checks on route_hour_speed."""
    return [
        row_count_at_least(1),
        not_null("route_id"), not_null("service_date"), not_null("hour_of_day"),
        between("hour_of_day", 0, 23), between("day_of_week", 1, 7),
        between("n_pings", 1), between("n_vehicles", 1),
        pair_ge("n_pings", "n_vehicles"), pair_ge("n_pings", "n_speed_obs"), pair_ge("n_speed_obs", "n_moving"),
        between("avg_speed_kmph", 0, p.max_kmph), between("avg_moving_speed_kmph", p.moving_kmph, p.max_kmph),
        unique("route_id", "service_date", "hour_of_day"),
    ]


def _scalar_exprs(i: int, c: Check) -> list[Column]:
    """(unexpected, denominator) aggregate expressions of one scalar check."""
    if c.check_type == "row_count_between":
        return [F.lit(None).cast("long").alias(f"u{i}"), F.count(F.lit(1)).alias(f"d{i}")]
    col = F.col(c.column)
    if c.check_type == "not_null":
        return [F.count_if(col.isNull()).alias(f"u{i}"), F.count(F.lit(1)).alias(f"d{i}")]
    if c.check_type == "between":
        ok = F.lit(True)
        if c.min_value is not None:
            ok = ok & (col >= F.lit(c.min_value))
        if c.max_value is not None:
            ok = ok & (col <= F.lit(c.max_value))
        return [F.count_if(col.isNotNull() & ~ok).alias(f"u{i}"), F.count(col).alias(f"d{i}")]
    if c.check_type == "in_set":
        return [F.count_if(col.isNotNull() & ~col.isin(*c.values)).alias(f"u{i}"), F.count(col).alias(f"d{i}")]
    if c.check_type == "pair_a_ge_b":
        b = F.col(c.column_b)
        both = col.isNotNull() & b.isNotNull()
        ok = col >= b if c.or_equal else col > b
        return [F.count_if(both & ~ok).alias(f"u{i}"), F.count_if(both).alias(f"d{i}")]
    raise ValueError(c.check_type)


def _result(dataset: str, i: int, c: Check, n_rows: Column, u: Column, d: Column) -> Column:
    if c.check_type == "row_count_between":
        ok = d >= F.lit(c.min_value if c.min_value is not None else 0)
        if c.max_value is not None:
            ok = ok & (d <= F.lit(c.max_value))
        pct = F.lit(None).cast("double")
    else:
        frac_ok = F.when(d > 0, (d - u).cast("double") / d)
        ok = F.coalesce(frac_ok >= F.lit(c.mostly), F.lit(True))
        pct = F.when(d > 0, F.round((u.cast("double") * 100.0 / d).cast("decimal(38,8)"), 4).cast("double"))
    return F.struct(
        F.lit(dataset).alias("dataset"), F.lit(i).alias("check_no"), F.lit(c.check_id).alias("check_id"),
        F.lit(c.check_type).alias("check_type"),
        F.lit(c.column or ",".join(c.columns)).alias("column_name"),
        ok.alias("success"), n_rows.alias("element_count"), u.alias("unexpected_count"),
        pct.alias("unexpected_pct"))


def run_suite(df: DataFrame, dataset: str, checks: list[Check]) -> DataFrame:
    """Evaluate a suite; one row per check (see module docstring)."""
    scalar = [(i, c) for i, c in enumerate(checks) if c.check_type != "compound_unique"]
    exprs = [F.count(F.lit(1)).alias("_n")]
    for i, c in scalar:
        exprs += _scalar_exprs(i, c)
    one = df.agg(*exprs)
    for i, c in enumerate(checks):
        if c.check_type == "compound_unique":
            keys = [F.col(k) for k in c.columns]
            any_present = None
            for k in keys:
                any_present = k.isNotNull() if any_present is None else (any_present | k.isNotNull())
            grouped = df.filter(any_present).groupBy(*c.columns).agg(F.count(F.lit(1)).alias("_k"))
            u = grouped.agg(F.coalesce(F.sum(F.when(F.col("_k") > 1, F.col("_k"))), F.lit(0)).alias(f"u{i}"),
                            F.coalesce(F.sum("_k"), F.lit(0)).alias(f"d{i}"))
            one = one.crossJoin(u)  # both sides are single-row aggregates
    results = [_result(dataset, i, c, F.col("_n"), F.col(f"u{i}").cast("long"), F.col(f"d{i}").cast("long"))
               for i, c in enumerate(checks)]
    return one.select(F.inline(F.array(*results)))


def _fails(c: Check) -> Column:
    """Whether a row is unexpected for a scalar check (false where it is not judged)."""
    col = F.col(c.column)
    if c.check_type == "not_null":
        return col.isNull()
    if c.check_type == "between":
        bad = F.lit(False)
        if c.min_value is not None:
            bad = bad | (col < F.lit(c.min_value))
        if c.max_value is not None:
            bad = bad | (col > F.lit(c.max_value))
    elif c.check_type == "in_set":
        bad = ~col.isin(*c.values)
    else:
        bad = col < F.col(c.column_b) if c.or_equal else col <= F.col(c.column_b)
    return F.coalesce(bad, F.lit(False))


def failing_keys(df: DataFrame, checks: list[Check], key: list[str], k: int = 5) -> DataFrame:
    """Q13: (check_no, keys): the ``k`` smallest keys (``key`` columns joined by "|") of the rows that each check finds
    unexpected; for a uniqueness check the smallest repeated keys.  Only unexpected rows leave their task, once per
    key and check, and a ranking window with Spark's group limit keeps k of them."""
    def text(cols):
        return F.concat_ws("|", *(F.col(c).cast("string") for c in cols))
    scalar = [(i, c) for i, c in enumerate(checks) if c.check_type not in ("compound_unique", "row_count_between")]
    numbers = F.filter(F.array(*(F.when(_fails(c), F.lit(i)) for i, c in scalar)), lambda x: x.isNotNull())
    bad = df.select(F.explode(numbers).alias("check_no"), text(key).alias("key")).distinct()
    for i, c in enumerate(checks):
        if c.check_type == "compound_unique":
            twice = (df.filter(" or ".join(f"{x} is not null" for x in c.columns))
                     .groupBy(*c.columns).agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1"))
            bad = bad.unionByName(twice.select(F.lit(i).alias("check_no"), text(c.columns).alias("key")).distinct())
    first = bad.withColumn("r", F.row_number().over(Window.partitionBy("check_no").orderBy("key"))).filter(F.col("r") <= k)
    return first.groupBy("check_no").agg(F.array_join(F.array_sort(F.collect_list("key")), ",").alias("keys"))     # k at most


def run_suite_with_keys(df: DataFrame, dataset: str, checks: list[Check], key: list[str], k: int = 5) -> DataFrame:
    """Results of ``run_suite`` with ``keys``, the k smallest offending keys of each check (null: none)."""
    return run_suite(df, dataset, checks).join(F.broadcast(failing_keys(df, checks, key, k)), "check_no", "left")


def suite_passed(results: DataFrame) -> DataFrame:
    """Q13: overall flag per dataset."""
    return results.groupBy("dataset").agg(F.bool_and("success").alias("passed"),
                                          F.count(F.lit(1)).alias("n_checks"),
                                          F.count_if(~F.col("success")).alias("n_failed"))


def gate(results: DataFrame) -> list[dict]:
    """Q14: raise QualityGateError when any check failed.  Brings only the
    check rows (a few dozen) to the driver."""
    rows = [r.asDict() for r in results.orderBy("dataset", "check_no").collect()]
    failed = [r for r in rows if not r["success"]]
    if failed:
        names = ", ".join(f"{r['dataset']}.{r['check_id']}" for r in failed)
        raise QualityGateError(f"{len(failed)} check(s) failed: {names}")
    return rows


def write_report(results: DataFrame, path: str) -> None:
    """K7: JSON report, one folder per dataset."""
    results.coalesce(1).write.mode("overwrite").partitionBy("dataset").json(path)
