"""The sample star-schema tables seen as the eight raw marketplace tables.

Every mapping is a projection or an aggregate over the whole sample tables, so
the raw tables grow with them.  Ids stay 64-bit integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MONEY = "decimal(12,2)"
TEXT_LENGTH = len("yyyy-MM-dd HH:mm:ss")

# Stand-ins for the model log derived from events.
RUN_LOG_METRICS = (
    ("kmeans", "silhouette"),
    ("als", "rmse"),
    ("als", "precision_at_k"),
    ("sales_forecast", "rmse"),
    ("sales_forecast", "r2"),
    ("sales_forecast", "mean_bias"),
)


_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Scan a sample table; its footer is read for the schema once per process."""
    path = f"{folder}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _as_text(timestamp: Column) -> Column:
    """Text to the second."""
    return F.substring(timestamp.cast("string"), 1, TEXT_LENGTH)


def _days_later(name: str, days: int) -> Column:
    return _as_text(F.col(name) + F.make_dt_interval(F.lit(days)))


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderpriority") == "5-LOW", "canceled")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "unavailable")
        .otherwise("processing")
    )
    untidy = F.when(key % 2 == 0, F.concat(F.lit(" "), F.upper(status))).otherwise(status)
    minutes = (key * 7 % 1440).cast("int")
    bought = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    return read_table(spark, folder, "orders").select(
        key.alias("order_id"),
        key.alias("customer_id"),
        F.when(key % 97 != 0, untidy).alias("order_status"),
        F.when(key % 101 == 0, "n/a").otherwise(_as_text(bought)).alias("order_purchase_timestamp"),
        _days_later("o_orderdate", 1).alias("order_approved_at"),
        _days_later("o_orderdate", 3).alias("order_delivered_carrier_date"),
        _days_later("o_orderdate", 10).alias("order_delivered_customer_date"),
        _days_later("o_orderdate", 14).alias("order_estimated_delivery_date"),
    )


def _places(spark: SparkSession, folder: str) -> DataFrame:
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    people = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    places = _places(spark, folder)
    homes = people.join(places, people.c_nationkey == places.n_nationkey)
    return orders.join(homes, orders.o_custkey == homes.c_custkey).select(
        F.col("o_orderkey").alias("customer_id"),
        F.col("o_custkey").alias("customer_unique_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def raw_sellers(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = read_table(spark, folder, "supplier")
    places = _places(spark, folder)
    return suppliers.join(places, suppliers.s_nationkey == places.n_nationkey).select(
        F.col("s_suppkey").alias("seller_id"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.lower("r_name").alias("seller_state"),
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    unknown = F.lit(None).cast("int")
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") != 50, F.concat(F.lit(" "), F.col("p_type"))).alias(
            "product_category_name"
        ),
        unknown.alias("product_name_lenght"),
        unknown.alias("product_description_lenght"),
        unknown.alias("product_photos_qty"),
        F.col("p_size").alias("product_weight_g"),
        unknown.alias("product_length_cm"),
        unknown.alias("product_height_cm"),
        unknown.alias("product_width_cm"),
    )


def raw_categories(spark: SparkSession, folder: str) -> DataFrame:
    name = F.lower("p_type")
    return (
        read_table(spark, folder, "part")
        .select(name.alias("product_category_name"))
        .filter(F.col("product_category_name") != "economy")
        .distinct()
        .withColumn(
            "product_category_name_english",
            F.concat(F.col("product_category_name"), F.lit(" goods")),
        )
    )


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        _as_text(F.col("l_shipdate")).alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast(MONEY).alias("freight_value"),
    )


def raw_order_payments(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    paid = F.col("l_extendedprice").cast(MONEY) + F.col("l_quantity").cast(MONEY)
    return (
        read_table(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_returnflag")
        .agg(F.sum(paid).alias("paid"), F.max("l_linenumber").alias("payment_installments"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.when(flag == "A", 1).when(flag == "N", 2).otherwise(3).alias("payment_sequential"),
            F.when(flag == "A", "credit_card")
            .when(flag == "N", "boleto")
            .otherwise("voucher")
            .alias("payment_type"),
            "payment_installments",
            # Wider than the raw column: one hot order may hold very many lines.
            F.col("paid").cast("decimal(24,2)").alias("payment_value"),
        )
    )


def raw_order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    absent = F.lit(None).cast("string")
    score = F.get_json_object("props", "$.k").cast("int") % 6
    return read_table(spark, folder, "events").select(
        F.col("event_id").alias("review_id"),
        (F.floor(F.col("event_id") / 2) * 3).alias("order_id"),
        score.alias("review_score"),
        absent.alias("review_comment_title"),
        absent.alias("review_comment_message"),
        _as_text(F.col("ts")).alias("review_creation_date"),
        absent.alias("review_answer_timestamp"),
    )


RAW_TABLES = {
    "categories": raw_categories,
    "customers": raw_customers,
    "sellers": raw_sellers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: build(spark, folder) for name, build in RAW_TABLES.items()}


def model_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as rows of a model log: which metric, its value, and when."""
    slot = (F.col("event_id") % len(RUN_LOG_METRICS)).cast("int")
    names = F.array(*[F.lit(model) for model, _ in RUN_LOG_METRICS])
    metrics = F.array(*[F.lit(metric) for _, metric in RUN_LOG_METRICS])
    return read_table(spark, folder, "events").select(
        F.get(names, slot).alias("model_name"),
        F.get(metrics, slot).alias("metric_name"),
        (F.col("value") / 100.0).alias("metric_value"),
        F.col("props").alias("params"),
        F.col("ts").alias("trained_at"),
        F.col("event_id").alias("run_id"),
    )


def daily_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """One forecast-shaped row per order day; every fifth day lacks its bounds."""
    day = F.to_date("o_orderdate")
    predicted = F.col("predicted_revenue")
    bounded = F.dayofyear("forecast_date") % 5 != 0
    return (
        read_table(spark, folder, "orders")
        .groupBy(day.alias("forecast_date"))
        .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("predicted_revenue"))
        .select(
            "forecast_date",
            "predicted_revenue",
            F.when(bounded, predicted - F.lit(1000)).alias("lower_bound"),
            F.when(bounded, predicted + F.lit(1000)).alias("upper_bound"),
            F.lit("sample").alias("model_name"),
        )
    )
