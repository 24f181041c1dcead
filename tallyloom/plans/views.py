"""The eleven views that dashboards read, as functions over cleaned tables and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.dates import month_start
from tallyloom.operators.clean import clean_order_payments
from tallyloom.operators.facts import (
    MONEY_TOTAL,
    enrich_products,
    order_headers,
    payments_per_order,
    sold_orders,
)
from tallyloom.operators.kpi import kpi_summary
from tallyloom.operators.metrics import category_metrics

__all__ = [
    "category_performance",
    "channel_performance",
    "customer_clusters",
    "kpi_summary",
    "latest_orders",
    "model_latest",
    "paid_orders",
    "recent_orders",
    "revenue_daily_7d",
    "revenue_monthly",
    "segment_distribution",
    "top_products",
    "top_recommendations",
]

RECENT_ORDERS = 50


def paid_orders(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders that count and were paid, one row each, with the amount paid."""
    totals = payments.groupBy("order_id").agg(F.sum("payment_value").alias("order_total_paid"))
    return order_headers(sold_orders(orders), customers).join(totals, "order_id")


def revenue_monthly(paid: DataFrame) -> DataFrame:
    """Paid revenue, orders and distinct customers per purchase month."""
    return (
        paid.groupBy(month_start(F.col("purchase_date")).alias("month"))
        .agg(
            F.sum("order_total_paid").cast(MONEY_TOTAL).alias("revenue"),
            F.count("order_id").alias("order_count"),
            F.count_distinct("customer_unique_id").alias("customer_count"),
        )
    )


def revenue_daily_7d(paid: DataFrame) -> DataFrame:
    """Paid revenue per day over the last seven calendar days of the data."""
    per_day = paid.groupBy(F.col("purchase_date").alias("day")).agg(
        F.count("order_id").alias("order_count"),
        F.sum("order_total_paid").cast(MONEY_TOTAL).alias("revenue"),
    )
    # One row for each day reaches this window.
    last_day = F.max("day").over(Window.partitionBy())
    dated = per_day.withColumn("last_day", last_day)
    return dated.filter(F.col("day") > F.date_sub("last_day", 7)).drop("last_day")


def latest_orders(orders: DataFrame, limit: int) -> DataFrame:
    return orders.orderBy(F.col("order_purchase_timestamp").desc(), "order_id").limit(limit)


def described_orders(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with its customer and payment total."""
    totals = payments.groupBy("order_id").agg(F.sum("payment_value").alias("order_total"))
    people = customers.select("customer_id", "customer_unique_id", "customer_state")
    return (
        orders.join(people, "customer_id", "left")
        .join(totals, "order_id", "left")
        .select(
            "order_id",
            "order_status",
            "order_purchase_timestamp",
            "customer_unique_id",
            "customer_state",
            F.coalesce("order_total", F.lit(0)).cast(MONEY_TOTAL).alias("order_total"),
        )
    )


def recent_orders(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    limit: int = RECENT_ORDERS,
    payments_are_raw: bool = False,
) -> DataFrame:
    """The latest ``limit`` orders with their customer and payment total.

    The limit is taken before anything is joined, and cleaning, whose keys
    contain the order, may follow the choice of payments.
    """
    chosen = latest_orders(orders, limit)
    theirs = payments.join(chosen.select("order_id"), "order_id", "left_semi")
    if payments_are_raw:
        theirs = clean_order_payments(theirs)
    people = customers.join(chosen.select("customer_id"), "customer_id", "left_semi")
    return described_orders(chosen, people, theirs).orderBy(
        F.col("order_purchase_timestamp").desc(), "order_id"
    )


def channel_performance(payments: DataFrame) -> DataFrame:
    """Payment types with revenue, distinct orders and share of all revenue in percent."""
    per_channel = payments.groupBy(F.col("payment_type").alias("channel")).agg(
        F.sum("payment_value").cast(MONEY_TOTAL).alias("revenue"),
        F.count_distinct("order_id").alias("order_count"),
    )
    # A handful of channels reaches this window.
    total = F.sum("revenue").over(Window.partitionBy()).cast("double")
    share = F.try_divide(F.col("revenue").cast("double"), total)
    return per_channel.withColumn("pct_of_total", F.round(share * 100.0, 2))


def category_performance(lines: DataFrame) -> DataFrame:
    """The same rows as the category metrics."""
    return category_metrics(lines)


def customer_clusters(features: DataFrame, segments: DataFrame) -> DataFrame:
    """Customer features with their segment; both are unique on the customer."""
    labels = segments.select(
        "customer_unique_id", "cluster_id", "segment_label", "distance_to_centroid"
    )
    return features.join(labels, "customer_unique_id")


def segment_distribution(segments: DataFrame) -> DataFrame:
    """Customers per segment and their share in percent, largest first."""
    sizes = segments.groupBy("segment_label").agg(F.count("*").alias("customer_count"))
    # A handful of segments: the window over all of them is one small partition.
    share = F.col("customer_count") / F.sum("customer_count").over(Window.partitionBy())
    return sizes.withColumn("pct", F.round(share * 100.0, 2)).orderBy(
        F.col("customer_count").desc(), "segment_label"
    )


def top_products(metrics: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Product metrics with the category label.

    Unordered, so that a caller's own sort and limit becomes a single top-k.
    """
    labels = enrich_products(products, categories).select("product_id", "category")
    return metrics.join(labels, "product_id", "left")


def best_sellers(products: DataFrame) -> DataFrame:
    return products.orderBy(F.col("total_revenue").desc(), "product_id")


def top_recommendations(
    recommendations: DataFrame, products: DataFrame, categories: DataFrame, metrics: DataFrame
) -> DataFrame:
    """Each customer's latest run of recommendations with category, review score and revenue."""
    newest = F.max("generated_at").over(Window.partitionBy("customer_unique_id"))
    current = recommendations.withColumn("newest", newest).filter("generated_at = newest")
    labels = enrich_products(products, categories).select("product_id", "category")
    scores = metrics.select("product_id", "avg_review_score", "total_revenue")
    described = labels.join(scores, "product_id", "left")
    return current.join(described, "product_id").select(
        "customer_unique_id",
        "product_id",
        "rank",
        "score",
        "category",
        "avg_review_score",
        "total_revenue",
    )


def model_latest(runs: DataFrame) -> DataFrame:
    """The most recent row of each (model, metric).

    ``max_by`` keeps one candidate per map task, however long the log of a
    single metric grows.
    """
    rest = [c for c in runs.columns if c not in ("model_name", "metric_name")]
    tie_break = [c for c in ("run_id",) if c in runs.columns]
    newest = F.max_by(F.struct(*rest), F.struct("trained_at", *tie_break, "metric_value"))
    return (
        runs.groupBy("model_name", "metric_name")
        .agg(newest.alias("newest"))
        .select("model_name", "metric_name", "newest.*")
    )
