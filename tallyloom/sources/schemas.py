"""Schemas of the eight raw tables, as DDL.

Dates are read as text and parsed by the cleaners.  File sources make every
column nullable, so keys are checked by the cleaners and not by the reader.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names and types of the raw files, spelling included.
RAW_DDL = {
    "categories": "product_category_name string, product_category_name_english string",
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g int, "
        "product_length_cm int, product_height_cm int, product_width_cm int"
    ),
    "orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string, "
        "order_estimated_delivery_date string"
    ),
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date string, price decimal(12,2), freight_value decimal(12,2)"
    ),
    "order_payments": (
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value decimal(12,2)"
    ),
    "order_reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date string, "
        "review_answer_timestamp string"
    ),
}

# Only review comments hold line breaks inside quotes.
MULTI_LINE_TABLES = frozenset({"order_reviews"})


def raw_schema(table: str) -> StructType:
    return StructType.fromDDL(RAW_DDL[table])
