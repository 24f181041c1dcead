"""Multi-stage runs.  Each stage reads the Parquet its predecessor wrote.

No stage result is computed twice, and a lost executor replays at most one
stage.  Stages return the scan of what they wrote.  With ``resume`` a stage that
an earlier run finished on the same inputs and settings is not run again.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.models import forecast, recommend, segments
from tallyloom.operators.clean import CLEANERS, complete_categories
from tallyloom.operators.facts import master_facts, orders_from_lines, sold_lines
from tallyloom.operators.kpi import kpi_snapshots
from tallyloom.operators.merge import table_profile
from tallyloom.operators.metrics import category_metrics, product_metrics
from tallyloom.operators.rfm import rfm_features
from tallyloom.operators.tables import RetailTables
from tallyloom.plans.stages import StageLog
from tallyloom.sinks.runlog import log_run, run_rows

LOG = logging.getLogger(__name__)

ANALYTICS_STEPS = ("segments", "recommendations", "metrics", "forecast")


@dataclass
class WorkflowConfig:
    root: str
    skip_master: bool = False
    only_features: bool = False
    steps: Iterable[str] = ANALYTICS_STEPS
    clusters: int = segments.CLUSTERS
    als: recommend.AlsSettings = field(default_factory=recommend.AlsSettings)
    forecast_model: str = "randomforest"
    forecast_trees: int = forecast.TREES
    forecast_depth: int = forecast.TREE_DEPTH
    horizon: int = forecast.HORIZON
    holdout_days: int = forecast.HOLDOUT_DAYS
    # Leave out stages that are finished on the same inputs.
    resume: bool = False

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("computed_at", F.current_timestamp())


def require_sales(lines: DataFrame) -> None:
    """Recency and stock age need at least one sale to count back from."""
    if lines.filter(F.col("order_purchase_timestamp").isNotNull()).isEmpty():
        raise ValueError("no order that counts: nothing to anchor dates to")


def run_cleaning(
    spark: SparkSession, raw: Mapping[str, DataFrame], config: WorkflowConfig
) -> RetailTables:
    log = StageLog(spark, config.root, config.resume)
    for name, clean in CLEANERS.items():
        # Completion reads the written products, so categories come last.
        if name != "categories":
            log.source(f"raw {name}", raw[name])
            log.write(name, [f"raw {name}"], lambda name=name, clean=clean: clean(raw[name]))
    log.source("raw categories", raw["categories"])
    log.write(
        "categories",
        ["raw categories", "products"],
        lambda: complete_categories(
            CLEANERS["categories"](raw["categories"]), spark.read.parquet(config.path("products"))
        ),
    )
    return RetailTables.from_parquet(spark, config.root)


def run_preprocessing(
    spark: SparkSession, raw: Mapping[str, DataFrame], config: WorkflowConfig
) -> dict[str, DataFrame]:
    """Clean, join the fact table, derive customer features."""
    reuse = config.skip_master or config.only_features
    if not config.only_features:
        tables = run_cleaning(spark, raw, config)
    if reuse:
        master = spark.read.parquet(config.path("master_facts"))
    else:
        log = StageLog(spark, config.root, config.resume)
        master = log.write(
            "master_facts", list(CLEANERS), lambda: master_facts(tables), partition_by=["purchase_month"]
        )

    def features() -> DataFrame:
        lines = sold_lines(master)
        require_sales(lines)
        return rfm_features(orders_from_lines(lines))

    written = StageLog(spark, config.root, config.resume).write("customer_features", ["master_facts"], features)
    return {"master_facts": master, "customer_features": written}


def run_segments(spark: SparkSession, config: WorkflowConfig) -> DataFrame:
    def build() -> DataFrame:
        features = spark.read.parquet(config.path("customer_features"))
        model = segments.fit_segments(features, config.clusters)
        params = {"k": config.clusters, "seed": segments.SEED, "labels": model.labels}
        rows = run_rows(spark, "kmeans", {"silhouette": model.silhouette}, params)
        log_run(rows, config.path("ml_model_runs"))
        return segments.assign_segments(model, features)

    log = StageLog(spark, config.root, config.resume)
    return log.write("customer_segments", ["customer_features"], build, settings=config.clusters)


def run_recommendations(spark: SparkSession, config: WorkflowConfig) -> DataFrame:
    def build() -> DataFrame:
        master = spark.read.parquet(config.path("master_facts"))
        fitted = recommend.fit_recommender(recommend.interactions(sold_lines(master)), config.als)
        metrics = {"rmse": fitted.rmse, "precision_at_k": fitted.precision_at_k}
        rows = run_rows(spark, "als", metrics, asdict(config.als))
        log_run(rows, config.path("ml_model_runs"))
        return recommend.recommend_all(fitted)

    log = StageLog(spark, config.root, config.resume)
    return log.write("recommendations", ["master_facts"], build, settings=asdict(config.als))


def run_metrics(spark: SparkSession, config: WorkflowConfig) -> dict[str, DataFrame]:
    """KPI snapshots, product metrics and category metrics, all from the fact table."""
    lines = sold_lines(spark.read.parquet(config.path("master_facts")))
    require_sales(lines)
    results = {
        "kpi_snapshots": lambda: kpi_snapshots(orders_from_lines(lines)),
        "product_metrics": lambda: product_metrics(lines),
        "category_metrics": lambda: category_metrics(lines),
    }
    log = StageLog(spark, config.root, config.resume)
    return {
        name: log.write(name, ["master_facts"], lambda build=build: stamped(build()))
        for name, build in results.items()
    }


def run_forecast(spark: SparkSession, config: WorkflowConfig) -> DataFrame:
    settings = {
        "kind": config.forecast_model,
        "horizon": config.horizon,
        "holdout_days": config.holdout_days,
        "trees": config.forecast_trees,
        "depth": config.forecast_depth,
    }

    def build() -> DataFrame:
        lines = sold_lines(spark.read.parquet(config.path("master_facts")))
        run = forecast.run_forecast(forecast.daily_series(lines), **settings)
        params = {"model": run.model_name, "horizon": config.horizon, "days": run.days}
        rows = run_rows(spark, "sales_forecast", {"rmse": run.rmse, "r2": run.r2}, params)
        log_run(rows, config.path("ml_model_runs"))
        return run.forecasts

    log = StageLog(spark, config.root, config.resume)
    return log.write("sales_forecasts", ["master_facts"], build, settings=settings)


def run_analytics(spark: SparkSession, config: WorkflowConfig) -> dict[str, DataFrame]:
    """Selected steps in order.  A failing forecast does not fail the run."""
    steps = list(config.steps)
    unknown = sorted(set(steps) - set(ANALYTICS_STEPS))
    if unknown:
        raise ValueError(f"unknown steps {unknown}: use some of {ANALYTICS_STEPS}")
    done: dict[str, DataFrame] = {}
    if "segments" in steps:
        done["customer_segments"] = run_segments(spark, config)
    if "recommendations" in steps:
        done["recommendations"] = run_recommendations(spark, config)
    if "metrics" in steps:
        done.update(run_metrics(spark, config))
    if "forecast" in steps:
        try:
            done["sales_forecasts"] = run_forecast(spark, config)
        except ValueError as error:  # no series is long enough
            LOG.warning("forecast skipped: %s", error)
    return done


def run_all(
    spark: SparkSession, raw: Mapping[str, DataFrame], config: WorkflowConfig
) -> dict[str, DataFrame]:
    """Preprocessing, then analytics; the first error stops the run."""
    return {**run_preprocessing(spark, raw, config), **run_analytics(spark, config)}


def summaries(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Row, column and NULL counts per written table."""
    return {name: table_profile(df) for name, df in tables.items()}
