"""Business rules: status bands, labels and display scores.

Scores that only stand in for a missing measure carry ``proxy`` in their name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import title_case

# Fixed values.
CANCELED_STATUSES = ("canceled", "unavailable")
OUT_OF_STOCK_AFTER_DAYS = 180
LOW_STOCK_AFTER_DAYS = 90

# Order status as shown to users.
STATUS_LABELS = {
    "delivered": "Delivered",
    "shipped": "Delivered",
    "invoiced": "Processing",
    "processing": "Processing",
    "approved": "Processing",
    "created": "Processing",
    "canceled": "Cancelled",
    "unavailable": "Cancelled",
}
DEFAULT_STATUS_LABEL = "Processing"

# Payment type as shown to users.
CHANNEL_LABELS = {
    "credit_card": "Credit Card",
    "debit_card": "Debit Card",
    "boleto": "Boleto",
    "voucher": "Voucher",
    "not_defined": "Other",
}
DEFAULT_CHANNEL = "not_defined"

# Share of orders by region used by the scaled trend.
REGION_WEIGHTS = {
    "All Regions": 1.00,
    "Brazil — North": 0.08,
    "Brazil — South": 0.15,
    "Brazil — Southeast": 0.65,
}

# Model metrics shown first, in this order, with their titles.
METRIC_TITLES = {
    "kmeans__silhouette": "K-Means Silhouette",
    "als__precision_at_k": "ALS Precision@K",
    "als__rmse": "ALS RMSE",
    "sales_forecast__r2": "Forecast R²",
    "sales_forecast__rmse": "Forecast RMSE",
}


def lookup(mapping: dict, key: Column) -> Column:
    """Value from a literal map, NULL when the key is absent."""
    pairs = [F.lit(item) for entry in mapping.items() for item in entry]
    return F.try_element_at(F.create_map(*pairs), key)


def half_up(value: Column) -> Column:
    """Nearest whole number with .5 going towards positive infinity."""
    return F.floor(value + F.lit(0.5))


def is_canceled(status: Column) -> Column:
    """NULL when the status is unknown, so that ``~is_canceled`` drops such rows."""
    return status.isin(*CANCELED_STATUSES)


def status_label(status: Column) -> Column:
    known = lookup(STATUS_LABELS, F.coalesce(F.lower(status), F.lit("")))
    return F.coalesce(known, F.lit(DEFAULT_STATUS_LABEL))


def channel_label(channel: Column) -> Column:
    key = F.lower(F.coalesce(channel, F.lit(DEFAULT_CHANNEL)))
    return F.coalesce(lookup(CHANNEL_LABELS, key), title_case(key))


def inventory_status(days_since_sale: Column) -> Column:
    return (
        F.when(days_since_sale > OUT_OF_STOCK_AFTER_DAYS, "out_of_stock")
        .when(days_since_sale > LOW_STOCK_AFTER_DAYS, "low")
        .otherwise("healthy")
    )


def engagement(frequency: Column) -> Column:
    return F.when(frequency >= 3, "High").when(frequency == 2, "Medium").otherwise("Low")


def churn_proxy(recency_days: Column) -> Column:
    return F.least(F.lit(95), half_up(recency_days / F.lit(365.0) * F.lit(95.0))).cast("bigint")


def sentiment(score: Column) -> Column:
    return (
        F.when(score.isNull(), "Resilient")
        .when(score >= 4.5, "Strong Buy")
        .when(score >= 4.0, "Buy")
        .when(score >= 3.5, "Resilient")
        .otherwise("Watch")
    )


def product_tag(status: Column, score: Column) -> Column:
    return (
        F.when(status == "out_of_stock", "DECLINING")
        .when(status == "low", "GROWING")
        .when(score >= 4.5, "TRENDING")
        .otherwise("STABLE")
    )


def trend_proxy(score: Column) -> Column:
    """Signed percentage around a score of three, one decimal, zero when unknown."""
    exact = (score.cast("decimal(5,2)") - F.lit(3)) * F.lit(4)
    return F.coalesce(F.round(exact, 1).cast("double"), F.lit(0.0))


def margin_proxy(score: Column) -> Column:
    exact = score.cast("decimal(5,2)") * F.lit(12)
    return F.coalesce(F.floor(exact + F.lit("0.5").cast("decimal(2,1)")).cast("bigint"), F.lit(0))


def match_proxy(rank: Column) -> Column:
    return F.greatest(F.lit(75), half_up(F.lit(100.0) - rank * F.lit(2.5))).cast("bigint")


def price_proxy(revenue: Column, rank: Column) -> Column:
    per_rank = half_up(revenue.cast("double") / F.greatest(rank, F.lit(1)))
    clipped = F.least(F.lit(2500), F.greatest(F.lit(29), per_rank))
    return F.when(revenue.isNull(), F.lit(99)).otherwise(clipped).cast("bigint")


def quality_band(score: Column) -> Column:
    return (
        F.when(score.isNull(), "unrated")
        .when(score >= 4.3, "high")
        .when(score >= 3.7, "medium")
        .otherwise("low")
    )


def performance_band(trend: Column) -> Column:
    return F.when(trend > 5, "Strong").when(trend > 0, "Solid").otherwise("Watch")


def metric_percent(metric: Column, value: Column) -> Column:
    """Raw model metric on a 0..100 scale for display."""
    unit = F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))
    signed = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), value))
    clipped = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.floor(value + 0.5).cast("double")))
    scaled = (
        F.when(metric == "silhouette", half_up(signed * 50.0 + 50.0).cast("double"))
        .when(metric.isin("precision_at_k", "r2"), half_up(unit * 100.0).cast("double"))
        .otherwise(clipped)
    )
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(scaled).cast("bigint")
