"""The dashboard views by name, and parameter queries as SQL table functions.

After ``register`` a session answers ``SELECT * FROM v_revenue_monthly`` and
``SELECT * FROM best_products(10, 'promo')``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators import facts, kpi, metrics
from tallyloom.operators.tables import RetailTables
from tallyloom.plans import views

# Name, parameters and body of every table function.
FUNCTIONS = {
    "best_products": (
        "wanted INT COMMENT 'how many', search STRING COMMENT 'part of the category, or empty'",
        """
SELECT rank, product_id, category, total_revenue, units_sold FROM (
  SELECT *, row_number() OVER (ORDER BY total_revenue DESC, product_id) AS rank FROM v_top_products
  WHERE best_products.search = '' OR contains(lower(category), lower(best_products.search))
) WHERE rank <= best_products.wanted""",
    ),
    "orders_of_period": (
        "first DATE, last DATE",
        """
SELECT order_id, order_status, order_purchase_timestamp FROM v_orders
WHERE CAST(order_purchase_timestamp AS DATE) BETWEEN orders_of_period.first AND orders_of_period.last""",
    ),
    "months_of_revenue": (
        "wanted INT COMMENT 'how many of the last months'",
        """
SELECT month, revenue, order_count, customer_count FROM (
  SELECT *, row_number() OVER (ORDER BY month DESC) AS age FROM v_revenue_monthly
) WHERE age <= months_of_revenue.wanted""",
    ),
}


def view_frames(
    tables: RetailTables,
    segments: DataFrame | None = None,
    features: DataFrame | None = None,
    recommendations: DataFrame | None = None,
    model_runs: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The frame behind every view whose inputs are given."""
    paid = views.paid_orders(tables.orders, tables.customers, tables.order_payments)
    reviewed = facts.sales_lines(tables, reviews=True)
    product_metrics = metrics.product_metrics(reviewed)
    found = {
        "v_orders": tables.orders,
        "v_kpi_summary": kpi.kpi_summary(kpi.kpi_snapshots(facts.order_facts(tables))),
        "v_revenue_monthly": views.revenue_monthly(paid),
        "v_revenue_daily_7d": views.revenue_daily_7d(paid),
        "v_recent_orders": views.recent_orders(tables.orders, tables.customers, tables.order_payments),
        "v_channel_performance": views.channel_performance(tables.order_payments),
        "v_category_performance": views.category_performance(
            facts.sales_lines(tables, reviews=True, products=True)
        ),
        "v_top_products": views.top_products(product_metrics, tables.products, tables.categories),
    }
    if segments is not None:
        found["v_segment_distribution"] = views.segment_distribution(segments)
        if features is not None:
            found["v_customer_clusters"] = views.customer_clusters(features, segments)
    if recommendations is not None:
        found["v_top_recommendations"] = views.top_recommendations(
            recommendations, tables.products, tables.categories, product_metrics
        )
    if model_runs is not None:
        found["v_ml_model_latest"] = views.model_latest(model_runs)
    return found


def register(spark: SparkSession, tables: RetailTables, **model_output: DataFrame) -> list[str]:
    """Make the views and the functions over them known to this session; returns the views' names."""
    frames = view_frames(tables, **model_output)
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    for name, (parameters, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE RETURN {body}")
    return sorted(frames)
