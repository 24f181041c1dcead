"""CSV and JSON exports of dashboard results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.rules import half_up

# Headers of the exported files.
CUSTOMER_HEADERS = {
    "id": "Customer ID",
    "name": "Name",
    "segment": "Segment",
    "ltv": "Lifetime Value",
    "engagement": "Engagement",
    "churn_proxy": "Churn Probability",
}


def write_csv(df: DataFrame, path: str) -> None:
    """Header line, every field quoted."""
    df.write.mode("overwrite").options(header=True, quoteAll=True, escape='"').csv(path)


def export_customers(rows: DataFrame, path: str) -> None:
    percent = rows.withColumn("churn_proxy", F.concat(F.col("churn_proxy").cast("string"), F.lit("%")))
    write_csv(
        percent.select(*[F.col(c).alias(header) for c, header in CUSTOMER_HEADERS.items()]), path
    )


def export_trend(trend: DataFrame, path: str) -> None:
    """Month, revenue and prediction as whole numbers; no prediction stays empty."""
    predicted = F.when(F.col("predicted") != 0, half_up(F.col("predicted")).cast("string"))
    write_csv(
        trend.orderBy("month").select(
            F.col("month_label").alias("Month"),
            half_up(F.coalesce("actual", F.lit(0.0))).alias("Revenue"),
            F.coalesce(predicted, F.lit("")).alias("Predicted"),
        ),
        path,
    )


def export_json(
    spark: SparkSession,
    sections: Mapping[str, DataFrame],
    path: str,
    filters: Mapping[str, str] | None = None,
) -> None:
    """One JSON-lines folder per section, plus one row with the time and the filters."""
    about = spark.range(1).select(F.current_timestamp().alias("generated_at"))
    for name, choice in (filters or {}).items():
        about = about.withColumn(name, F.lit(choice))
    for name, section in {"about": about, **sections}.items():
        section.write.mode("overwrite").json(f"{path}/{name}")


def export_workbench(
    spark: SparkSession,
    path: str,
    kpis: DataFrame,
    trend: DataFrame,
    categories: DataFrame,
    filters: Mapping[str, str],
) -> None:
    sections = {"kpi_summary": kpis, "revenue_trend": trend, "category_performance": categories}
    export_json(spark, sections, path, filters)


def export_insights(
    spark: SparkSession, path: str, cards: DataFrame, segments: DataFrame, forecast: DataFrame
) -> None:
    sections = {
        "model_metrics": cards.select(
            "model", "metric", "name", F.col("raw").alias("value"), "trained_at"
        ),
        "customer_segments": segments.select(
            F.col("name").alias("segment"), F.col("value").alias("share_pct"), "customers"
        ),
        "forecast_summary": forecast.select(
            "model",
            F.col("n").alias("horizon_days"),
            "predicted_total",
            F.col("lower").alias("lower_bound"),
            F.col("upper").alias("upper_bound"),
        ),
    }
    export_json(spark, sections, path)
