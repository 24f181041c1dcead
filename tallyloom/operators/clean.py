"""Cleaners for the eight raw tables and completion of the category dimension.

Dates are parsed after deduplication: parsing then only touches rows that stay,
and disappears from the plan of a query that does not read the date.

The cleaners of the large tables take the names of the columns that are needed;
the rest is left out as far as ``keep_first`` can spare it.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import parsed_timestamp
from tallyloom.functions.text import lowered, underscores_to_spaces, uppered
from tallyloom.operators.dedup import keep_first

ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def clean_categories(raw: DataFrame) -> DataFrame:
    tidy = raw.dropna(subset=["product_category_name"]).withColumns(
        {
            "product_category_name": lowered("product_category_name"),
            "product_category_name_english": lowered("product_category_name_english"),
        }
    )
    return keep_first(tidy, ["product_category_name"])


def _clean_places(
    raw: DataFrame, role: str, required: list[str], columns: Collection[str] | None = None
) -> DataFrame:
    tidy = raw.dropna(subset=required).withColumns(
        {f"{role}_city": F.trim(f"{role}_city"), f"{role}_state": uppered(f"{role}_state")}
    )
    return keep_first(tidy, [f"{role}_id"], columns)


def clean_customers(raw: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    return _clean_places(raw, "customer", ["customer_id", "customer_unique_id"], columns)


def clean_sellers(raw: DataFrame) -> DataFrame:
    return _clean_places(raw, "seller", ["seller_id"])


def clean_products(raw: DataFrame) -> DataFrame:
    """Missing measures and categories stay NULL."""
    tidy = raw.dropna(subset=["product_id"]).withColumn(
        "product_category_name", lowered("product_category_name")
    )
    return keep_first(tidy, ["product_id"])


def clean_orders(raw: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """Orders are deduplicated before those without a purchase time are dropped."""
    tidy = raw.dropna(subset=["order_id", "customer_id"]).withColumn(
        "order_status", lowered("order_status")
    )
    needed = None if columns is None else {*columns, "order_purchase_timestamp"}
    kept = keep_first(tidy, ["order_id"], needed)
    parsed = {name: parsed_timestamp(name) for name in ORDER_TIMESTAMPS if name in kept.columns}
    return kept.withColumns(parsed).filter(F.col("order_purchase_timestamp").isNotNull())


def clean_order_items(raw: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    tidy = raw.dropna(subset=["order_id", "order_item_id", "product_id", "seller_id"]).filter(
        (F.col("price") >= 0) & (F.col("freight_value") >= 0)
    )
    # Ties within a key are settled by product, seller, price, freight, then date.
    ranked = tidy.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
        "shipping_limit_date",
    )
    kept = keep_first(ranked, ["order_id", "order_item_id"], columns)
    if "shipping_limit_date" in kept.columns:
        kept = kept.withColumn("shipping_limit_date", parsed_timestamp("shipping_limit_date"))
    return kept.select(*(c for c in raw.columns if c in kept.columns))


def clean_order_payments(raw: DataFrame) -> DataFrame:
    tidy = (
        raw.dropna(subset=["order_id", "payment_sequential"])
        .filter((F.col("payment_value") >= 0) & (F.col("payment_installments") >= 0))
        .withColumn("payment_type", lowered("payment_type"))
    )
    return keep_first(tidy, ["order_id", "payment_sequential"])


def clean_order_reviews(raw: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    tidy = raw.dropna(subset=["review_id", "order_id", "review_score"]).filter(
        F.col("review_score").between(1, 5)
    )
    kept = keep_first(tidy, ["review_id", "order_id"], columns)
    parsed = {
        name: parsed_timestamp(name)
        for name in ("review_creation_date", "review_answer_timestamp")
        if name in kept.columns
    }
    return kept.withColumns(parsed) if parsed else kept


CLEANERS = {
    "categories": clean_categories,
    "customers": clean_customers,
    "sellers": clean_sellers,
    "products": clean_products,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "order_payments": clean_order_payments,
    "order_reviews": clean_order_reviews,
}


def clean_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: clean(raw[name]) for name, clean in CLEANERS.items()}


def complete_categories(categories: DataFrame, products: DataFrame) -> DataFrame:
    """Add the categories that products use and the translation table lacks.

    The label of an added category is its name with underscores as spaces.
    """
    name = "product_category_name"
    known = categories.select(name)
    added = (
        products.select(name)
        .dropna()
        .distinct()
        .join(known, name, "left_anti")
        .withColumn("product_category_name_english", underscores_to_spaces(F.col(name)))
    )
    return categories.unionByName(added)
