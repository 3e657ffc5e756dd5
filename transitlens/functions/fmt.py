"""Formatting and rounding helpers shared by the warehouse and the reports."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from transitlens.config import DAY_PARTS, LATE_EVENING


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hour_label(h) -> Column:
    """'HH:00-HH:59'."""
    hh = F.lpad(_c(h).cast("string"), 2, "0")
    return F.concat(hh, F.lit(":00-"), hh, F.lit(":59"))


def day_part(h) -> Column:
    h = _c(h)
    expr = None
    for lo, hi, name in DAY_PARTS:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(LATE_EVENING))


def date_key(d) -> Column:
    """yyyymmdd integer key of a DATE."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")


def dec_round(x, scale: int, work_scale: int = 6) -> Column:
    """Round a double through a decimal: first to ``work_scale`` digits (absorbs
    summation-order noise), then HALF_UP to ``scale``; returned as double."""
    return F.round(_c(x).cast(f"decimal(38,{work_scale})"), scale).cast("double")


def round_avg(x, scale: int = 2) -> Column:
    """round(avg(x), scale) that two engines agree on (see SURVEY trap 7)."""
    return dec_round(F.avg(_c(x)), scale)
