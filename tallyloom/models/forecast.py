"""Revenue forecasts: calendar and lag features, one model, recursive prediction.

Input is (series, date, revenue); the single series ``total`` is the company's
daily revenue, other keys forecast more series with the same pooled model.
Every window is partitioned by series and a series holds one row per calendar
day, so no group grows with the number of orders.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage, ensure_checkpoint_dir

# Features and defaults.
FEATURES = ("trend", "dow", "month", "lag_1", "lag_7", "roll_mean_7")
HORIZON = 30
HOLDOUT_DAYS = 30
TREES = 200
SEED = 42
LAGS = 7
MIN_TRAINING_DAYS = 14
BAND_SIGMAS = 1.96
TREE_DEPTH = 10  # MLlib allows up to 30
STEPS_PER_CHECKPOINT = 5

MODEL_NAMES = {"randomforest": "spark-randomforest", "linreg": "spark-linreg"}


@dataclass(frozen=True)
class ForecastRun:
    forecasts: DataFrame
    rmse: float
    r2: float
    model_name: str
    days: int
    # (series, days) of the series that are too short to be forecast.
    short_series: DataFrame | None = None


def daily_series(lines: DataFrame, series: Column | None = None) -> DataFrame:
    """Revenue per series and purchase day, from lines or orders that count."""
    amount = "order_revenue" if "order_revenue" in lines.columns else "item_revenue"
    return (
        lines.filter(F.col("purchase_date").isNotNull())
        .groupBy(
            (F.lit("total") if series is None else series).alias("series"),
            F.col("purchase_date").alias("date"),
        )
        .agg(F.sum(amount).cast("double").alias("revenue"))
    )


def fill_gaps(daily: DataFrame) -> DataFrame:
    """Every calendar day between a series' first and last, missing ones with 0.

    A given day also stands for the empty days up to the next one, so only the
    given rows are shuffled, once and on their series.
    """
    given, by_date = F.col("given"), Window.partitionBy("series").orderBy("given")
    before_next = F.coalesce(F.date_sub(F.lead("given").over(by_date), 1), given)
    rows = daily.filter(F.col("date").isNotNull()).select(
        "series", F.col("date").alias("given"), "revenue"
    )
    spans = rows.withColumn("until", F.greatest(given, before_next))
    # A series without a name has days but no revenue, as nothing equals a missing key.
    known = (F.col("date") == given) & F.col("series").isNotNull()
    return spans.withColumn("date", F.explode(F.sequence(given, F.col("until")))).select(
        "series", "date", F.coalesce(F.when(known, F.col("revenue")), F.lit(0.0)).alias("revenue")
    )


def forecast_features(filled: DataFrame) -> DataFrame:
    """Trend, calendar and lag features; the first seven days have no full lags."""
    by_date = Window.partitionBy("series").orderBy("date")
    whole = Window.partitionBy("series")
    week_before = by_date.rowsBetween(-LAGS, -1)
    return filled.select(
        "series",
        "date",
        "revenue",
        F.datediff("date", F.min("date").over(whole)).alias("trend"),
        F.weekday("date").alias("dow"),
        F.month("date").alias("month"),
        F.lag("revenue", 1).over(by_date).alias("lag_1"),
        F.lag("revenue", LAGS).over(by_date).alias("lag_7"),
        F.avg("revenue").over(week_before).alias("roll_mean_7"),
    ).filter(F.col("lag_7").isNotNull())


def mark_holdout(features: DataFrame, holdout_days: int = HOLDOUT_DAYS) -> DataFrame:
    """The last days of each series are kept back for evaluation."""
    last = F.max("date").over(Window.partitionBy("series"))
    return features.withColumn("is_holdout", F.col("date") > F.date_sub(last, holdout_days))


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features")


def _estimator(kind: str, trees: int, seed: int, depth: int):
    common = {"featuresCol": "features", "labelCol": "revenue", "predictionCol": "prediction"}
    if kind == "randomforest":
        return RandomForestRegressor(numTrees=trees, seed=seed, maxDepth=depth, **common)
    if kind == "linreg":
        return LinearRegression(solver="normal", **common)
    raise ValueError(f"unknown model {kind!r}: use one of {sorted(MODEL_NAMES)}")


def split_by_length(filled: DataFrame, holdout_days: int) -> tuple[DataFrame, DataFrame, int]:
    """Series that are long enough, the days of those that are not, and the longest length.

    Raises only if no series is long enough.
    """
    needed = holdout_days + MIN_TRAINING_DAYS
    lengths = cut_lineage(filled.groupBy("series").agg(F.count("*").alias("days")))
    enough = F.col("days") >= needed
    longest = lengths.agg(F.max("days").alias("longest")).first()["longest"]
    if longest is None or longest < needed:
        raise ValueError(f"the longest series has {longest or 0} days, {needed} are needed")
    kept = filled.join(lengths.filter(enough).select("series"), "series", "left_semi")
    return kept, lengths.filter(~enough), int(longest)


def _last_states(features: DataFrame) -> DataFrame:
    """One row per series: last date and trend, and the last week in date order."""
    last = F.max("date").over(Window.partitionBy("series"))
    recent = features.withColumn("last", last).filter(F.col("date") > F.date_sub("last", LAGS))
    week = F.sort_array(F.collect_list(F.struct("date", "revenue")))
    return recent.groupBy("series").agg(
        F.max("date").alias("last_date"),
        F.max("trend").alias("last_trend"),
        F.transform(week, lambda day: day["revenue"]).alias("history"),
    )


def _week_mean(history: Column) -> Column:
    return F.aggregate(history, F.lit(0.0), lambda total, x: total + x) / F.lit(float(LAGS))


def _predict_linear(states: DataFrame, model: LinearRegressionModel, horizon: int) -> DataFrame:
    """The whole recursion as one expression over each series' row."""
    weights = [float(w) for w in model.coefficients]
    intercept = float(model.intercept)

    def step(history: Column, ahead: Column) -> Column:
        day = F.date_add(F.col("last_date"), ahead)
        recent = F.slice(history, -LAGS, LAGS)
        values = (
            F.col("last_trend") + ahead,
            F.weekday(day),
            F.month(day),
            F.element_at(recent, -1),
            F.element_at(recent, 1),
            _week_mean(recent),
        )
        predicted = F.lit(intercept)
        for weight, value in zip(weights, values):
            predicted = predicted + F.lit(weight) * value
        return F.concat(history, F.array(predicted))

    steps = F.sequence(F.lit(1), F.lit(horizon))
    path = F.aggregate(steps, F.col("history"), step)
    ahead = F.slice(path, LAGS + 1, horizon)
    return states.select(
        "series", "last_date", F.posexplode(ahead).alias("position", "prediction")
    ).select(
        "series",
        F.date_add("last_date", F.col("position") + 1).alias("forecast_date"),
        "prediction",
    )


def flat_forest(model: RandomForestRegressionModel) -> DataFrame:
    """One row with all trees of a model, each as arrays over its nodes.

    A node's place is its number; a leaf has no left child.  The size is bounded by
    the number of trees and their depth.
    """
    spark = SparkSession.getActiveSession()
    path = f"{ensure_checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.struct(
            node["id"].alias("id"),
            split["featureIndex"].alias("feature"),
            F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            node["prediction"].alias("value"),
        ).alias("node"),
    )
    listed = nodes.groupBy("tree").agg(F.array_sort(F.collect_list("node")).alias("nodes"))
    names = ("feature", "threshold", "left", "right", "value")
    arrays = F.struct("tree", *(F.col(f"nodes.{name}").alias(name) for name in names))
    return listed.agg(F.array_sort(F.collect_list(arrays)).alias("forest"))


def _predict_forest(
    states: DataFrame, model: RandomForestRegressionModel, horizon: int, depth: int
) -> DataFrame:
    """The whole recursion as one expression: every tree is walked from its root, day by day."""
    levels = F.sequence(F.lit(1), F.lit(depth))

    def leaf_value(tree: Column, inputs: Column) -> Column:
        def down(node: Column, _: Column) -> Column:
            goes_left = F.get(inputs, F.get(tree["feature"], node)) <= F.get(tree["threshold"], node)
            child = F.when(goes_left, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))
            return F.when(F.get(tree["left"], node) < 0, node).otherwise(child)

        return F.get(tree["value"], F.aggregate(levels, F.lit(0), down))

    def step(history: Column, ahead: Column) -> Column:
        day = F.date_add(F.col("last_date"), ahead)
        recent = F.slice(history, -LAGS, LAGS)
        values = F.array(
            (F.col("last_trend") + ahead).cast("double"),
            F.weekday(day).cast("double"),
            F.month(day).cast("double"),
            F.element_at(recent, -1),
            F.element_at(recent, 1),
            _week_mean(recent),
        )
        # The one element of the outer array is computed once and read by all trees.
        total = F.transform(
            F.array(values),
            lambda inputs: F.aggregate(
                F.col("forest"), F.lit(0.0), lambda sum_, tree: sum_ + leaf_value(tree, inputs)
            ),
        )
        return F.concat(history, F.array(F.get(total, F.lit(0)) / F.size("forest")))

    grown = states.select("*", flat_forest(model).scalar().alias("forest"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("history"), step)
    ahead = F.slice(path, LAGS + 1, horizon)
    return grown.select(
        "series", "last_date", F.posexplode(ahead).alias("position", "prediction")
    ).select(
        "series",
        F.date_add("last_date", F.col("position") + 1).alias("forecast_date"),
        "prediction",
    )


def _predict_stepwise(states: DataFrame, model: Model, horizon: int) -> DataFrame:
    """Any model: one narrow step per day ahead on one row per series.

    A checkpoint every few steps keeps plan and lineage short.
    """
    assembler = _assembler()
    state = states.withColumn("path", F.array().cast("array<double>"))
    for ahead in range(1, horizon + 1):
        day = F.date_add("last_date", ahead)
        history = F.col("history")
        inputs = state.withColumns(
            {
                "trend": F.col("last_trend") + ahead,
                "dow": F.weekday(day),
                "month": F.month(day),
                "lag_1": F.element_at(history, -1),
                "lag_7": F.element_at(history, 1),
                "roll_mean_7": _week_mean(history),
            }
        )
        predicted = F.array("prediction")
        state = model.transform(assembler.transform(inputs)).select(
            "series",
            "last_date",
            "last_trend",
            F.concat(F.slice("history", 2, LAGS - 1), predicted).alias("history"),
            F.concat("path", predicted).alias("path"),
        )
        if ahead % STEPS_PER_CHECKPOINT == 0:
            state = cut_lineage(state)
    return state.select(
        "series", "last_date", F.posexplode("path").alias("position", "prediction")
    ).select(
        "series",
        F.date_add("last_date", F.col("position") + 1).alias("forecast_date"),
        "prediction",
    )


def run_forecast(
    daily: DataFrame,
    kind: str = "randomforest",
    horizon: int = HORIZON,
    holdout_days: int = HOLDOUT_DAYS,
    trees: int = TREES,
    seed: int = SEED,
    depth: int = TREE_DEPTH,
) -> ForecastRun:
    """Evaluate on the held-out days, refit on everything, forecast ahead.

    Series without enough days take no part; they come back in ``short_series``.
    The band is 1.96 population standard deviations of the refit's residuals,
    per series, and never below zero.
    """
    # One row per series and day from here on, read by several jobs.
    complete = cut_lineage(fill_gaps(daily))
    filled, short, days = split_by_length(complete, holdout_days)
    marked = mark_holdout(forecast_features(filled), holdout_days)
    vectors = _assembler().transform(marked).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        estimator = _estimator(kind, trees, seed, depth)
        scored = estimator.fit(vectors.filter(~F.col("is_holdout"))).transform(
            vectors.filter("is_holdout")
        )
        rmse, r2 = (
            RegressionEvaluator(
                labelCol="revenue", predictionCol="prediction", metricName=metric
            ).evaluate(scored)
            for metric in ("rmse", "r2")
        )
        model = estimator.fit(vectors)
        residual = F.col("revenue") - F.col("prediction")
        spread = model.transform(vectors).groupBy("series").agg(
            F.stddev_pop(residual).alias("sigma")
        )
        states = cut_lineage(_last_states(vectors).join(spread, "series"))
    finally:
        vectors.unpersist()
    if isinstance(model, LinearRegressionModel):
        path = _predict_linear(states, model, horizon)
    elif isinstance(model, RandomForestRegressionModel):
        path = _predict_forest(states.drop("sigma"), model, horizon, depth)
    else:
        path = _predict_stepwise(states.drop("sigma"), model, horizon)
    width = F.lit(BAND_SIGMAS) * F.col("sigma")
    forecasts = path.join(states.select("series", "sigma"), "series").select(
        "series",
        "forecast_date",
        F.round("prediction", 2).alias("predicted_revenue"),
        F.round(F.greatest(F.lit(0.0), F.col("prediction") - width), 2).alias("lower_bound"),
        F.round(F.col("prediction") + width, 2).alias("upper_bound"),
        F.lit(MODEL_NAMES[kind]).alias("model_name"),
        F.current_timestamp().alias("generated_at"),
    )
    return ForecastRun(forecasts, float(rmse), float(r2), MODEL_NAMES[kind], days, short)
