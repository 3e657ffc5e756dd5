"""Analytics reports, parameterised lookups, dashboard tiles and the insight
prompt over the star schema (R1-R13).

Sorting rules: ascending sorts put nulls last and descending sorts put nulls
first (the warehouse database's defaults), and every LIMIT has tie-breakers so
results are deterministic.  Lookups bind parameters as literals, never by
formatting SQL text.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from transitlens.config import DEFAULT, Params
from transitlens.functions.fmt import day_part, dec_round
from transitlens.plans.warehouse_build import Warehouse


def _speed(c: str = "avg_moving_speed_kmph"):
    return F.col(c).cast("double").alias(c)


def route_hour_view(wh: Warehouse) -> DataFrame:
    """Fact joined to route, date and hour dimensions (all small but let
    AQE choose the join strategy from runtime sizes)."""
    return (wh.fact_route_hour.join(wh.dim_route.select("route_key", "route_id"), "route_key")
            .join(wh.dim_date.select("date_key", "full_date", "day_of_week"), "date_key")
            .join(wh.dim_hour.select("hour_key", "hour_label", "day_part"), "hour_key"))


def slowest_route_hours(wh: Warehouse, min_moving: int = DEFAULT.min_moving, limit: int = 10,
                        date_as_text: bool = False) -> DataFrame:
    """Top-``limit`` slowest route-hours with n_moving >= floor."""
    if not (1 <= limit <= 100) or min_moving < 1:
        raise ValueError("limit must be in 1..100 and min_moving >= 1")
    v = route_hour_view(wh).filter(F.col("n_moving") >= F.lit(min_moving))
    d = F.col("full_date").cast("string").alias("full_date") if date_as_text else F.col("full_date")
    return (v.orderBy(F.col("avg_moving_speed_kmph").asc_nulls_last(), "route_id", "full_date", "hour_key")
             .limit(limit)
             .select("route_id", d, "hour_label", "n_moving", _speed(), "n_bunched"))


def slowest_in_each_hour(wh: Warehouse, p: Params = DEFAULT, limit: int | None = None) -> DataFrame:
    """Rank routes within each hour by moving speed, keep rank 1 (ties kept)."""
    v = route_hour_view(wh).filter(F.col("n_moving") >= p.min_moving)
    w = Window.partitionBy("hour_key").orderBy(F.col("avg_moving_speed_kmph").asc_nulls_last())
    out = (v.withColumn("slow_rank_in_hour", F.rank().over(w)).filter("slow_rank_in_hour = 1")
            .select("hour_label", "route_id", _speed(), "slow_rank_in_hour"))
    out = out.orderBy("hour_label", "route_id")
    return out.limit(limit) if limit else out


def by_day_part(wh: Warehouse) -> DataFrame:
    """Route-hour rows, mean moving speed and bunched pings per day part
    (no sample floor, as in the report)."""
    f = wh.fact_route_hour.join(wh.dim_hour.select("hour_key"), "hour_key")
    return (f.groupBy(day_part("hour_key").alias("day_part"))
             .agg(F.count(F.lit(1)).alias("route_hour_rows"),
                  dec_round(F.avg(F.col("avg_moving_speed_kmph").cast("double")), 2).alias("avg_speed_kmph"),
                  F.sum(F.col("n_bunched").cast("long")).alias("total_bunched_pings"))
             .orderBy(F.col("avg_speed_kmph").asc_nulls_last(), "day_part"))


def bunching_rate(wh: Warehouse, p: Params = DEFAULT, limit: int = 10) -> DataFrame:
    """Bunched / moving pings per route, floor on moving pings."""
    f = wh.fact_route_hour.join(wh.dim_route.select("route_key", "route_id"), "route_key")
    agg = f.groupBy("route_id").agg(F.sum(F.col("n_moving").cast("long")).alias("total_moving_pings"),
                                    F.sum(F.col("n_bunched").cast("long")).alias("total_bunched_pings"))
    pct = dec_round(F.col("total_bunched_pings").cast("double") * 100.0
                    / F.nullif(F.col("total_moving_pings"), F.lit(0)).cast("double"), 1)
    return (agg.filter(F.col("total_moving_pings") >= p.min_moving_rate)
               .withColumn("bunching_pct", pct)
               .orderBy(F.col("bunching_pct").desc_nulls_first(), "route_id")
               .limit(limit))


def day_over_day(wh: Warehouse, p: Params = DEFAULT, limit: int | None = None) -> DataFrame:
    """Daily mean moving speed per route and change vs the previous
    observed day of that route."""
    v = route_hour_view(wh).filter(F.col("n_moving") >= p.min_moving)
    daily = v.groupBy("route_id", "full_date").agg(
        dec_round(F.avg(F.col("avg_moving_speed_kmph").cast("double")), 2).alias("avg_speed_kmph"))
    w = Window.partitionBy("route_id").orderBy("full_date")
    prev = F.lag("avg_speed_kmph").over(w)
    out = (daily.withColumn("prev_day_speed", prev)
                .withColumn("change_vs_prev_day", dec_round(F.col("avg_speed_kmph") - F.col("prev_day_speed"), 2))
                .orderBy("route_id", "full_date"))
    return out.limit(limit) if limit else out


def route_speed(wh: Warehouse, route_id: str, hour: int | None = None,
                min_moving: int = DEFAULT.min_moving) -> DataFrame:
    """One route's route-hours, optionally one hour; empty = not found."""
    if hour is not None and not 0 <= hour <= 23:
        raise ValueError("hour must be in 0..23")
    if min_moving < 1:
        raise ValueError("min_moving must be >= 1")
    v = route_hour_view(wh).filter((F.col("route_id") == F.lit(route_id)) & (F.col("n_moving") >= F.lit(min_moving)))
    if hour is not None:
        v = v.filter(F.col("hour_key") == F.lit(hour))
    return (v.orderBy("full_date", "hour_key")
             .select("route_id", F.col("full_date").cast("string").alias("full_date"), "hour_label",
                     "n_moving", _speed(), "n_bunched"))


class NotFound(LookupError):
    pass


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise NotFound when a lookup is empty (a one-row probe, not a count)."""
    if df.limit(1).count() == 0:
        raise NotFound(message)
    return df


def slowest_routes_tile(wh: Warehouse, p: Params = DEFAULT, limit: int = 15) -> DataFrame:
    """Slowest routes (mean of qualifying route-hours' moving speed)."""
    v = route_hour_view(wh).filter(F.col("n_moving") >= p.min_moving)
    return (v.groupBy("route_id").agg(
                dec_round(F.avg(F.col("avg_moving_speed_kmph").cast("double")), 2).alias("avg_moving_speed_kmph"),
                F.count(F.lit(1)).alias("route_hours"))
             .orderBy(F.col("avg_moving_speed_kmph").asc_nulls_last(), "route_id").limit(limit))


def midday_vs_evening(wh: Warehouse) -> DataFrame:
    """The day-part report restricted to Midday and Evening peak."""
    return by_day_part(wh).filter(F.col("day_part").isin("Midday", "Evening peak"))


def kpi_cards(wh: Warehouse) -> DataFrame:
    """Total pings, distinct routes, mean speed of moving pings."""
    rh = wh.fact_route_hour.agg(F.sum(F.col("n_pings").cast("long")).alias("total_pings"),
                                F.count_distinct("route_key").alias("distinct_routes"))
    mv = wh.fact_ping.filter("is_moving").agg(
        dec_round(F.avg(F.col("speed_kmph").cast("double")), 2).alias("avg_moving_speed_kmph"))
    return rh.crossJoin(mv)  # two one-row aggregates


def bar_scale(slowest: DataFrame) -> DataFrame:
    """Relative bar width max(6, speed / max speed * 100), 0 when the
    maximum is 0; applied to a bounded top-k list."""
    s = F.coalesce(F.col("avg_moving_speed_kmph"), F.lit(0.0))
    mx = F.max(s).over(Window.partitionBy())
    return slowest.withColumn("bar_pct", F.when(mx > 0, dec_round(F.greatest(F.lit(6.0), s / mx * 100.0), 2))
                              .otherwise(F.lit(0.0)))


# Fixed text of the insight prompt (must equal the reference's wording).
PROMPT_SLOW_HEADER = "Slowest bus routes (route_id, date, hour, moving buses, avg speed km/h):"
PROMPT_SLOW_LINE = "- Route %s on %s at %s: %s buses, %s km/h"
PROMPT_BUNCH_HEADER = "\nRoutes with the highest bus-bunching rate (same route, buses within 300m):"
PROMPT_BUNCH_LINE = "- Route %s: %s%% bunched (%s of %s moving pings)"
PROMPT_FOOTER = ("\nWrite a short summary (4-6 sentences, plain English, no jargon) for a "
                 "transit planner. Call out the worst congestion pattern and the worst "
                 "bunching pattern. Do not invent numbers not shown above. Do not give "
                 "traffic-management advice beyond one short suggestion.")


def insight_prompt(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """One-row DataFrame holding the prompt text built from the top-10
    slow route-hours and the top-5 bunching routes.  Lines are ordered by
    (section, rank) with an ordered collect over at most 17 rows."""
    slow = slowest_route_hours(wh, p.min_moving, 10)
    slow = slow.withColumn("_r", F.row_number().over(
        Window.orderBy(F.col("avg_moving_speed_kmph").asc_nulls_last(), "route_id", "full_date", "hour_label")))
    slow_lines = slow.select(F.lit(1).alias("sec"), "_r", F.format_string(
        PROMPT_SLOW_LINE, "route_id", F.col("full_date").cast("string"), "hour_label",
        F.col("n_moving").cast("string"), F.col("avg_moving_speed_kmph").cast("decimal(7,2)").cast("string")).alias("line"))
    bunch = bunching_rate(wh, p, 5)
    bunch = bunch.withColumn("_r", F.row_number().over(
        Window.orderBy(F.col("bunching_pct").desc_nulls_first(), "route_id")))
    bunch_lines = bunch.select(F.lit(3).alias("sec"), "_r", F.format_string(
        PROMPT_BUNCH_LINE, "route_id", F.col("bunching_pct").cast("decimal(10,1)").cast("string"),
        F.col("total_bunched_pings").cast("string"), F.col("total_moving_pings").cast("string")).alias("line"))
    spark = wh.dim_hour.sparkSession
    fixed = spark.createDataFrame([(0, 0, PROMPT_SLOW_HEADER), (2, 0, PROMPT_BUNCH_HEADER), (4, 0, PROMPT_FOOTER)],
                                  "sec int, _r int, line string")
    lines = fixed.unionByName(slow_lines.select(F.col("sec").cast("int"), F.col("_r").cast("int"), "line")) \
                 .unionByName(bunch_lines.select(F.col("sec").cast("int"), F.col("_r").cast("int"), "line"))
    return lines.agg(F.concat_ws("\n", F.transform(
        F.array_sort(F.collect_list(F.struct("sec", "_r", "line"))), lambda x: x["line"])).alias("prompt"))


def save_prompt(prompt: DataFrame, path: str) -> None:
    """K8: the one-row prompt as a text file (a single row by construction)."""
    prompt.select("prompt").write.mode("overwrite").text(path)
