"""The line-level fact table and the order-level aggregates it is joined from.

Grain and money rules:

* one fact row per (order_id, order_item_id); order-level values repeat on it;
* ``item_revenue`` (price + freight) feeds KPI, product, category and forecast
  measures, payment totals feed customer value and the monthly view;
* ``is_canceled`` is NULL when the order header or its status is missing, and
  every measure filters ``~is_canceled``, so such rows stay in the table and
  out of the measures.

Orders, payments and reviews are merged at order grain first.  The large item
table is then shuffled once on order_id, in a join AQE can split by skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import month_start
from tallyloom.functions.rules import is_canceled
from tallyloom.operators.tables import RetailTables

# Totals are wider than the 14 digits of the stored tables, so that sums over
# very large inputs cannot overflow; the values are the same.
MONEY_TOTAL = "decimal(24,2)"

MASTER_COLUMNS = (
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "shipping_limit_date",
    "price",
    "freight_value",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "customer_unique_id",
    "customer_city",
    "customer_state",
    "category_pt",
    "category",
    "product_weight_g",
    "seller_city",
    "seller_state",
    "order_total_paid",
    "payment_installments_max",
    "payment_type_dominant",
    "review_score_avg",
    "review_count",
    "item_revenue",
    "purchase_date",
    "purchase_month",
    "is_canceled",
)


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Total, longest instalment plan, and the type of the largest payment.

    One aggregate gives all three.  Among equal payments the lowest sequence
    number wins.
    """
    preference = F.struct("payment_value", -F.col("payment_sequential"))
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("order_total_paid"),
        F.max("payment_installments").alias("payment_installments_max"),
        F.max_by("payment_type", preference).alias("payment_type_dominant"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("review_score_avg"),
        F.count("review_id").alias("review_count"),
    )


def payments_and_reviews(payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Both order aggregates in one shuffle instead of two and a join.

    Review rows carry no payment and payment rows no review, and every
    aggregate skips what is missing.  The order of preference puts a missing
    payment last.
    """
    paid = payments.select(
        "order_id", "payment_value", "payment_installments", "payment_type", "payment_sequential"
    )
    rated = reviews.select("order_id", "review_id", "review_score")
    preference = F.struct("payment_value", -F.col("payment_sequential"))
    return (
        paid.unionByName(rated, allowMissingColumns=True)
        .groupBy("order_id")
        .agg(
            F.sum("payment_value").alias("order_total_paid"),
            F.max("payment_installments").alias("payment_installments_max"),
            F.max_by("payment_type", preference).alias("payment_type_dominant"),
            F.avg("review_score").alias("review_score_avg"),
            F.nullif(F.count("review_id"), F.lit(0)).alias("review_count"),
        )
    )


def enrich_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Category label: English name, else the raw name, else ``unknown``."""
    name = "product_category_name"
    return products.join(categories, name, "left").select(
        "product_id",
        F.col(name).alias("category_pt"),
        F.coalesce(f"{name}_english", name, F.lit("unknown")).alias("category"),
        "product_weight_g",
    )


def order_headers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    wanted = ("customer_id", "customer_unique_id", "customer_city", "customer_state")
    people = customers.select(*(c for c in wanted if c in customers.columns))
    return orders.join(people, "customer_id", "left")


def _lean_headers(tables: RetailTables, customers: bool) -> DataFrame:
    """Order headers that count, with their time and, if asked for, the customer's lasting id."""
    names = ("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    orders = sold_orders(tables.lean("orders", *names)).select(*names, "purchase_date")
    if not customers:
        return orders
    people = tables.lean("customers", "customer_id", "customer_unique_id")
    return order_headers(orders, people.select("customer_id", "customer_unique_id"))


def _order_measures(df: DataFrame) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    return df.withColumns(
        {
            "purchase_date": F.to_date(bought),
            "is_canceled": is_canceled(F.col("order_status")),
        }
    )


def master_facts(tables: RetailTables) -> DataFrame:
    """All dimensions on every order line; nothing is dropped for a missing match.

    Products and sellers join the narrow items; the many columns of an order,
    which repeat on its lines, come last and are not shuffled at line grain.
    At order grain only the two keys travel to the customers; what is found there
    comes back to the orders, which stay where they were made unique.
    """
    # Joins leave out missing ids on one side only; without them on both, the
    # orders are shuffled once for their two uses.
    orders = tables.orders.filter(F.col("order_id").isNotNull())
    people = order_headers(orders.select("order_id", "customer_id"), tables.customers)
    order_side = orders.join(people.drop("customer_id"), "order_id", "left").join(
        payments_and_reviews(tables.order_payments, tables.order_reviews), "order_id", "full"
    )
    sellers = tables.sellers.select("seller_id", "seller_city", "seller_state")
    joined = (
        tables.order_items.join(
            enrich_products(tables.products, tables.categories), "product_id", "left"
        )
        .join(sellers, "seller_id", "left")
        .join(order_side, "order_id", "left")
    )
    measured = _order_measures(joined).withColumns(
        {
            "item_revenue": F.col("price") + F.col("freight_value"),
            "purchase_month": month_start(F.col("purchase_date")),
        }
    )
    return measured.select(*MASTER_COLUMNS)


def sales_lines(
    tables: RetailTables,
    customers: bool = False,
    products: bool = False,
    reviews: bool = False,
    lean: bool = False,
) -> DataFrame:
    """Fact lines with only the dimensions a measure asks for.

    ``lean`` leaves out the dates but that of the purchase, and the customer's place.

    Every dimension is unique on its key, so leaving one out changes no row
    count; it saves the shuffle of a join whose columns nobody reads.  Without
    canceled lines and lines of unknown status.
    """
    if lean:
        headers, items = _lean_headers(tables, customers), tables.lean("order_items", "freight_value")
        items = items.select(*(c for c in items.columns if c != "shipping_limit_date"))
    else:
        orders, items = sold_orders(tables.orders), tables.order_items
        headers = order_headers(orders, tables.customers) if customers else orders
    if reviews:
        rated = tables.lean("order_reviews", "review_score") if lean else tables.order_reviews
        headers = headers.join(reviews_per_order(rated), "order_id", "left")
    lines = items.join(headers, "order_id").withColumn(
        "item_revenue", F.col("price") + F.col("freight_value")
    )
    if products:
        described = enrich_products(tables.products, tables.categories)
        lines = lines.join(described, "product_id", "left")
    return lines


def bought_products(tables: RetailTables) -> DataFrame:
    """(customer_unique_id, product_id) of every line that counts; fact lines without the rest."""
    items = tables.lean("order_items", "order_id", "order_item_id", "product_id")
    headers = _lean_headers(tables, customers=True).select("order_id", "customer_unique_id")
    return (
        items.select("order_id", "product_id")
        .join(headers, "order_id")
        .select("customer_unique_id", "product_id")
    )


def sold_lines(master: DataFrame) -> DataFrame:
    """Lines that count: not canceled, status known."""
    return master.filter(~F.col("is_canceled"))


def sold_orders(orders: DataFrame) -> DataFrame:
    """Order headers that count, with their calendar day."""
    return _order_measures(orders).filter(~F.col("is_canceled"))


def orders_from_lines(lines: DataFrame) -> DataFrame:
    """Order grain from line grain: one row per order with its revenue and payment.

    Order-level columns are equal on all lines of an order.  As grouping keys
    they keep the aggregation in the hash table, which ``max`` over text would
    not; ``max`` undoes the repetition of the payment total.
    """
    keys = ("order_id", "customer_unique_id", "order_purchase_timestamp", "purchase_date")
    return lines.groupBy(*keys).agg(
        F.sum("item_revenue").alias("order_revenue"),
        F.max("order_total_paid").alias("order_total_paid"),
    )


def order_facts(
    tables: RetailTables, customers: bool = True, payments: bool = False, lean: bool = False
) -> DataFrame:
    """Order grain straight from the cleaned tables.

    ``lean`` leaves out what measures do not read: the other dates of the order
    and the customer's place.

    Items are summed per order before the join, which also splits an order that
    holds very many lines, and the join finds both sides hashed on order_id.
    Orders without items are left out, as they are in the fact table.
    """
    money = ("price", "freight_value")
    items = tables.lean("order_items", *money) if lean else tables.order_items
    per_order = items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("order_revenue")
    )
    if lean:
        headers = _lean_headers(tables, customers)
    else:
        orders = sold_orders(tables.orders)
        headers = order_headers(orders, tables.customers) if customers else orders
    facts = per_order.join(headers, "order_id")
    if payments:
        facts = facts.join(payments_per_order(tables.order_payments), "order_id", "left")
    return facts
