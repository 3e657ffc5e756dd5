"""Speed model on Spark ML.

The training set, features, split, target encoding and baseline are plain
DataFrame expressions; the forest is pyspark.ml's RandomForestRegressor, so
training is distributed as well.  The split is a deterministic arithmetic
hash of the row's keys, stable under any partitioning and reproducible in
SQL, unlike randomSplit.
"""
from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from transitlens.config import DEFAULT, Params
from transitlens.functions.fmt import dec_round

FEATURES = ["hour_key", "day_of_week", "is_peak_hour", "is_weekend", "route_avg_speed"]
LABEL = "avg_moving_speed_kmph"
SEED = 42
TRAIN_PCT = 80


class NotEnoughData(RuntimeError):
    pass


def training_rows(rh_view: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M1: qualifying route-hours with their keys (J7 + F4)."""
    return rh_view.filter(F.col("n_moving") >= p.min_moving).select(
        "route_id", "route_key", "date_key", "full_date", F.col("hour_key").cast("int").alias("hour_key"),
        F.col("day_of_week").cast("int").alias("day_of_week"), "n_moving",
        F.col(LABEL).cast("double").alias(LABEL))


def time_features(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M2: peak-hour and weekend indicators."""
    return df.withColumns({
        "is_peak_hour": F.col("hour_key").isin(*p.peak_hours).cast("int"),
        "is_weekend": F.col("day_of_week").isin(*p.weekend_days).cast("int"),
    })


def split_bucket(seed: int = SEED):
    """Deterministic 0..99 bucket of a route-hour (arithmetic hash of its keys)."""
    h = (F.col("date_key").cast("long") * 31 + F.col("hour_key")) * 1000003 + F.col("route_key").cast("long") * 7919 + seed
    return F.pmod(h, F.lit(100))


def split(df: DataFrame, train_pct: int = TRAIN_PCT, seed: int = SEED) -> DataFrame:
    """M3: adds ``is_train``; the split happens before the target encoding."""
    return df.withColumn("is_train", split_bucket(seed) < train_pct)


def encode_route_mean(df: DataFrame) -> DataFrame:
    """Route mean of the label over training rows; unseen routes get the
    training global mean (one-row aggregate)."""
    train = df.filter("is_train")
    route_avg = train.groupBy("route_id").agg(F.avg(LABEL).alias("_ravg"))
    glob = train.agg(F.avg(LABEL).alias("_gavg"))
    return (df.join(route_avg, "route_id", "left").crossJoin(F.broadcast(glob))
              .withColumn("route_avg_speed", F.coalesce("_ravg", "_gavg")).drop("_ravg", "_gavg"))


def prepared(rh_view: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return encode_route_mean(split(time_features(training_rows(rh_view, p), p)))


def regression_metrics(df: DataFrame, pred: str, prefix: str) -> DataFrame:
    """MAE and R^2 of ``pred`` against the label (one aggregate pass + mean)."""
    y = F.col(LABEL)
    mean = df.agg(F.avg(LABEL).alias("_ybar"))
    x = df.crossJoin(F.broadcast(mean))
    return x.agg(
        F.avg(F.abs(y - F.col(pred))).alias(f"{prefix}_mae"),
        (F.lit(1.0) - F.sum((y - F.col(pred)) ** 2) / F.sum((y - F.col("_ybar")) ** 2)).alias(f"{prefix}_r2"))


def baseline_metrics(data: DataFrame) -> DataFrame:
    """M6 (baseline half): route-mean prediction on the held-out rows."""
    test = data.filter(~F.col("is_train"))
    m = regression_metrics(test, "route_avg_speed", "baseline")
    counts = data.agg(F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test"),
                      F.count_distinct("full_date").alias("n_dates"))
    return counts.crossJoin(m).select("n_train", "n_test", "n_dates",
                                      dec_round("baseline_mae", 4).alias("baseline_mae"),
                                      dec_round("baseline_r2", 4).alias("baseline_r2"))


def forest(p: Params = DEFAULT, num_trees: int = 200, max_depth: int = 8, min_leaf: int = 3) -> Pipeline:
    """M5: every feature is considered at each split (featureSubsetStrategy 'all')."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        RandomForestRegressor(featuresCol="features", labelCol=LABEL, predictionCol="prediction",
                              numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=min_leaf,
                              featureSubsetStrategy="all", seed=SEED),
    ])


def train(data: DataFrame, p: Params = DEFAULT, **kw) -> PipelineModel:
    """M8 guard then fit on the training rows."""
    n = data.count()
    if n < p.min_train_rows:
        raise NotEnoughData(f"only {n} usable rows; at least {p.min_train_rows} are needed")
    return forest(p, **kw).fit(data.filter("is_train"))


def evaluate(model: PipelineModel, data: DataFrame) -> DataFrame:
    """M6: model vs baseline on the held-out rows, improvement in % of MAE."""
    test = model.transform(data.filter(~F.col("is_train")))
    m = regression_metrics(test, "prediction", "model").crossJoin(
        regression_metrics(test, "route_avg_speed", "baseline"))
    return m.withColumn("improvement_pct", (F.col("baseline_mae") - F.col("model_mae")) / F.col("baseline_mae") * 100)


def importances(model: PipelineModel) -> DataFrame:
    """Feature importances, largest first (five values from the model)."""
    rf = model.stages[-1]
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    rows = [(f, float(v)) for f, v in zip(FEATURES, rf.featureImportances.toArray())]
    return s.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


# "seen" and "unseen" are fixed values: the texts of the scoring answer.
NOTES = {
    "seen": "using this route's historical average speed as a feature",
    "unseen": "route not seen before - using the fleet-wide average speed instead",
    "hour": "error: hour_key must be 0 to 23",
    "day": "error: day_of_week must be 1 to 7",
    "empty": "error: no route-hour with enough moving pings to compare with",
}


def score(model: PipelineModel, requests: DataFrame, rh_view: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M9: requests (route_id, hour_key, day_of_week) -> predicted speed, the route's
    historical mean over all qualifying rows (global mean for unseen routes) and
    a note.  Every request gives one row: one that is out of range, or meets no
    qualifying rows at all, has a null prediction and a note that says why."""
    q = rh_view.filter(F.col("n_moving") >= p.min_moving)
    hist = q.groupBy("route_id").agg(F.avg(F.col(LABEL).cast("double")).alias("_ravg"))
    glob = q.agg(F.avg(F.col(LABEL).cast("double")).alias("_gavg"))
    hour, day = F.col("hour_key").try_cast("int"), F.col("day_of_week").try_cast("int")
    asked = requests.withColumn("_request", F.struct("route_id", "hour_key", "day_of_week"))
    x = (asked.join(hist, "route_id", "left").crossJoin(F.broadcast(glob))
              .withColumns({"route_avg_speed": F.coalesce("_ravg", "_gavg"),
                            "_why": F.when(~F.coalesce(hour.between(0, 23), F.lit(False)), F.lit(NOTES["hour"]))
                                     .when(~F.coalesce(day.between(1, 7), F.lit(False)), F.lit(NOTES["day"]))}))
    x = x.withColumn("_why", F.coalesce("_why", F.when(F.col("route_avg_speed").isNull(), F.lit(NOTES["empty"]))))
    fine = F.col("_why").isNull()
    # the model never sees a request it cannot answer; such a row carries stand-ins and loses its prediction below
    x = time_features(x.withColumns({"hour_key": F.when(fine, hour).otherwise(0), "day_of_week": F.when(fine, day).otherwise(1),
                                     "_avg": F.col("route_avg_speed"), "route_avg_speed": F.coalesce("route_avg_speed", F.lit(0.0))}), p)
    out = model.transform(x)
    note = F.when(F.col("_ravg").isNull(), F.lit(NOTES["unseen"])).otherwise(F.lit(NOTES["seen"]))
    return out.select(
        "_request.route_id", "_request.hour_key", "_request.day_of_week",
        F.when(F.col("_why").isNull(), dec_round("prediction", 2)).alias("predicted_speed_kmph"),
        dec_round("_avg", 2).alias("route_historical_avg_kmph"), F.coalesce("_why", note).alias("note"))


def save(model: PipelineModel, path: str) -> None:
    """K10."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
