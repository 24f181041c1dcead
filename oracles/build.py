"""One self-contained statement per query, with the parts it needs as CTEs."""

from __future__ import annotations

import oracles.models  # noqa: F401  (adds its parts)
from oracles.parts import NOT_SOLD, PARTS, PRODUCT_NAME, half_up, short, title


def _ordered(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _ordered(PARTS[name][0], seen)
            seen.append(name)
    return seen


def statement(needs: tuple[str, ...], sql: str) -> str:
    # A part that several others read is computed once.
    ctes = [f"{name} AS MATERIALIZED ({PARTS[name][1]})" for name in _ordered(needs, [])]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + sql.strip()


def _doubles(columns: str) -> str:
    names = [c.strip() for c in columns.split(",")]
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in names)


def _keep_or_take(column: str) -> str:
    return f"CASE WHEN u.product_id IS NOT NULL THEN u.{column} ELSE t.{column} END"


CARDS = """
SELECT 'revenue' AS key, 'Total Revenue' AS label, total_revenue AS value,
  coalesce(revenue_delta * 100.0, 0) AS change FROM summary
UNION ALL SELECT 'orders', 'Total Orders', CAST(total_orders AS DOUBLE),
  coalesce(orders_delta * 100.0, 0) FROM summary
UNION ALL SELECT 'aov', 'Avg Order Value', avg_order_value,
  coalesce(aov_delta * 100.0, 0) FROM summary
UNION ALL SELECT 'active', 'Active Customers', CAST(active_customers AS DOUBLE),
  coalesce(active_customers_delta * 100.0, 0) FROM summary"""

JS_ROUND = "CAST(floor({0} + 0.5) AS BIGINT)"

CATEGORY_ROWS = f"""
SELECT {title("category")} AS category, revenue,
  CAST(floor(coalesce(CAST(round(avg_review_score * 100) AS BIGINT) * 12, 0) / 100.0 + 0.5)
    AS BIGINT) AS margin_proxy,
  order_count, units_sold, avg_review_score AS review_score,
  CASE WHEN avg_review_score IS NULL THEN 'unrated' WHEN avg_review_score >= 4.3 THEN 'high'
    WHEN avg_review_score >= 3.7 THEN 'medium' ELSE 'low' END AS quality_band,
  revenue / greatest((SELECT max(revenue) FROM cm), 1) AS intensity
FROM (SELECT * FROM cm {{0}} ORDER BY revenue DESC, category LIMIT 12)"""

TOP_PRODUCT_ROWS = f"""
SELECT {short("product_id", 8)} AS id, product_id AS raw_id, {PRODUCT_NAME} AS name,
  {title("coalesce(category, 'Other')")} AS category, total_revenue AS revenue, trend_proxy,
  CASE WHEN trend_proxy > 5 THEN 'Strong' WHEN trend_proxy > 0 THEN 'Solid' ELSE 'Watch' END
    AS performance,
  CASE WHEN s IS NULL THEN 'Resilient' WHEN s >= 4.5 THEN 'Strong Buy' WHEN s >= 4 THEN 'Buy'
    WHEN s >= 3.5 THEN 'Resilient' ELSE 'Watch' END AS sentiment,
  CASE WHEN inventory_status = 'out_of_stock' THEN 'DECLINING'
    WHEN inventory_status = 'low' THEN 'GROWING' WHEN s >= 4.5 THEN 'TRENDING'
    ELSE 'STABLE' END AS tag,
  units_sold, review_count, inventory_status, s AS review_score, rank
FROM (
  SELECT *, avg_review_score AS s, coalesce(round((avg_review_score - 3) * 4, 1), 0) AS trend_proxy,
    CAST(row_number() OVER (ORDER BY total_revenue DESC, product_id) AS INTEGER) AS rank
  FROM tp {{0}} QUALIFY rank <= 10
)"""

CUSTOMER_ROWS = f"""
SELECT {short("customer_unique_id", 16)} AS id, customer_unique_id AS raw_id,
  'Customer ' || {short("customer_unique_id", 6)} AS name, segment_label AS segment,
  {JS_ROUND.format("monetary")} AS ltv,
  CASE WHEN frequency >= 3 THEN 'High' WHEN frequency = 2 THEN 'Medium' ELSE 'Low' END AS engagement,
  least(95, {JS_ROUND.format("recency_days / 365.0 * 95.0")}) AS churn_proxy
FROM clusters WHERE {{0}} ORDER BY monetary DESC, raw_id LIMIT 8"""

WORKBENCH = """
SELECT CAST((SELECT sum(paid) FROM paid WHERE date_trunc('month', day) IN
    (SELECT month FROM shown)) AS DOUBLE) AS revenue,
  (SELECT CAST(sum(order_count) AS BIGINT) FROM shown) AS orders,
  (SELECT max(customer_count) FROM shown) AS customers,
  coalesce((SELECT CAST(sum(customer_count) AS BIGINT) FROM shares
    WHERE segment_label ILIKE '%risk%'), 0) AS at_risk_customers,
  round((SELECT sum(predicted) FROM (SELECT * FROM whole_fc ORDER BY month DESC LIMIT 3)), 2)
    AS predicted_revenue
FROM (SELECT 1)"""

SCALED = f"""
SELECT month, month_label, order_count, customer_count, round(actual * s, 4) AS actual,
  round(predicted * s, 4) AS predicted
FROM (SELECT *, 0.15::DOUBLE * (
    SELECT sum(CASE WHEN {title("category")} = 'Promo Goods' THEN revenue END) / sum(revenue)
    FROM cm) AS s
  FROM (SELECT * FROM whole_fc {{0}}))
WHERE s IS NOT NULL"""

HEATMAP = """
SELECT g.hour, g.day, coalesce(n, 0) AS orders,
  coalesce(n, 0) / greatest(max(coalesce(n, 0)) OVER (), 1) AS value
FROM (
  SELECT CAST(h AS INTEGER) AS hour, d AS day
  FROM (SELECT unnest(generate_series(0, 23)) AS h),
    (SELECT unnest(['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun']) AS d)
) g LEFT JOIN (
  SELECT hour(order_purchase_timestamp) AS hour, strftime(order_purchase_timestamp, '%a') AS day,
    count(*) AS n
  FROM {0} WHERE order_status <> 'canceled' GROUP BY 1, 2
) c ON g.hour = c.hour AND g.day = c.day"""

LAST_6 = "ORDER BY month DESC LIMIT 6"

QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "clean_categories": (("c_categories",), "SELECT * FROM c_categories"),
    "clean_customers": (("c_customers",), "SELECT * FROM c_customers"),
    "clean_sellers": (("c_sellers",), "SELECT * FROM c_sellers"),
    "clean_products": (("c_products",), "SELECT * FROM c_products"),
    "clean_orders": (("c_orders",), "SELECT * FROM c_orders"),
    "clean_order_items": (
        ("c_items",),
        f"SELECT * REPLACE ({_doubles('price, freight_value')}) FROM c_items",
    ),
    "clean_order_payments": (
        ("c_payments",),
        f"SELECT * REPLACE ({_doubles('payment_value')}) FROM c_payments",
    ),
    "clean_order_reviews": (("c_reviews",), "SELECT * FROM c_reviews"),
    "reviews_from_csv": (
        ("c_reviews",),
        """
SELECT c.* REPLACE (CASE WHEN lang IS NOT NULL THEN 'says "' || lang || '", or not' END
    AS review_comment_title, text AS review_comment_message)
FROM c_reviews c LEFT JOIN documents ON doc_id = review_id""",
    ),
    "snapshots_from_fact_table": (("snaps",), "SELECT * FROM snaps"),
    "categories_augmented": (("all_categories",), "SELECT * FROM all_categories"),
    "payments_per_order": (
        ("pay",),
        f"SELECT * REPLACE ({_doubles('order_total_paid')}) FROM pay",
    ),
    "reviews_per_order": (("rev",), "SELECT * FROM rev"),
    "products_enriched": (("prod",), "SELECT * FROM prod"),
    "master_facts": (
        ("master",),
        f"SELECT * REPLACE ({_doubles('price, freight_value, order_total_paid, item_revenue')}) "
        "FROM master",
    ),
    "rfm_features": (("rfm",), "SELECT * FROM rfm"),
    "revenue_daily": (("rev_daily",), "SELECT * FROM rev_daily"),
    "customer_base": (("base",), "SELECT * FROM base"),
    "customers_to_date": (
        ("cust_kpi",),
        "SELECT snapshot_date, total_customers FROM cust_kpi",
    ),
    "customers_active_30d": (
        ("cust_kpi",),
        "SELECT snapshot_date, active_customers FROM cust_kpi",
    ),
    "repeat_rate": (("cust_kpi",), "SELECT snapshot_date, repeat_rate FROM cust_kpi"),
    "kpi_snapshots": (("snaps",), "SELECT * FROM snaps"),
    "kpi_deltas": (("deltas",), "SELECT * FROM deltas"),
    "kpi_summary": (("summary",), "SELECT * FROM summary"),
    "kpi_cards": (("summary",), CARDS),
    "period_cards_all_time": (("summary",), CARDS),
    "period_cards": (
        ("paid", "last12"),
        """
SELECT key, label, value, CAST(0.0 AS DOUBLE) AS change FROM (
  SELECT 'revenue' AS key, 'Total Revenue' AS label, revenue AS value FROM totals
  UNION ALL SELECT 'orders', 'Total Orders', CAST(orders AS DOUBLE) FROM totals
  UNION ALL SELECT 'aov', 'Avg Order Value', revenue / orders FROM totals
  UNION ALL SELECT 'active', 'Active Customers', CAST(customers AS DOUBLE) FROM totals
) cards
""".replace(
            "totals",
            """(SELECT
    CAST((SELECT sum(paid) FROM paid WHERE date_trunc('month', day) IN
      (SELECT month FROM last12)) AS DOUBLE) AS revenue,
    (SELECT sum(order_count) FROM last12) AS orders,
    (SELECT max(customer_count) FROM last12) AS customers)""",
        ),
    ),
    "product_metrics": (("pm",), "SELECT * FROM pm"),
    "category_metrics": (("cm",), "SELECT * FROM cm"),
    "category_performance": (("cm",), "SELECT * FROM cm"),
    "category_rows": (("cm",), CATEGORY_ROWS.format("")),
    "category_search": (("cm",), CATEGORY_ROWS.format("WHERE category ILIKE '%good%'")),
    "spending_top": (
        ("cm",),
        f"SELECT {title('category')} AS category, revenue AS value FROM cm "
        "ORDER BY revenue DESC, cm.category LIMIT 6",
    ),
    "top_products": (("tp",), "SELECT * FROM tp"),
    "top_product_rows": (("tp",), TOP_PRODUCT_ROWS.format("")),
    "product_search": (
        ("tp",),
        TOP_PRODUCT_ROWS.format(f"WHERE ({PRODUCT_NAME}) ILIKE '%promo%'"),
    ),
    "inventory_alerts": (
        ("alerts",),
        "SELECT * EXCLUDE (total_revenue) FROM alerts "
        "ORDER BY total_revenue DESC, product_id LIMIT 5",
    ),
    "inventory_alerts_all": (("alerts",), "SELECT * EXCLUDE (total_revenue) FROM alerts"),
    "alert_counts": (
        ("alerts",),
        "SELECT count(*) FILTER (severity = 'high') AS high, "
        "count(*) FILTER (severity = 'medium') AS medium FROM alerts",
    ),
    "revenue_monthly": (("monthly",), "SELECT * FROM monthly"),
    "revenue_daily_7d": (("daily7",), "SELECT * FROM daily7"),
    "daily_bars": (
        ("daily7",),
        """
SELECT day AS date, strftime(day, '%a') AS day, revenue,
  revenue = max(revenue) OVER () AND max(revenue) OVER () > 0 AS is_best_day FROM daily7""",
    ),
    "monthly_actuals": (
        ("last12",),
        """
SELECT month, strftime(month, '%b') AS month_label, revenue AS actual, revenue AS predicted,
  order_count, customer_count FROM last12""",
    ),
    "monthly_with_forecast": (("with_fc",), "SELECT * FROM with_fc"),
    "period_kpis": (
        ("paid", "last12"),
        """
SELECT *, revenue / orders AS aov, CAST(0.0 AS DOUBLE) AS change
FROM (
  SELECT CAST((SELECT sum(paid) FROM paid WHERE date_trunc('month', day) IN
      (SELECT month FROM last12 ORDER BY month DESC LIMIT 3)) AS DOUBLE) AS revenue,
    CAST(sum(order_count) AS BIGINT) AS orders, max(customer_count) AS customers
  FROM (SELECT * FROM last12 ORDER BY month DESC LIMIT 3)
)""",
    ),
    "workbench_kpis": (
        ("paid", "monthly", "whole_fc", "shares"),
        WORKBENCH.replace("shown", f"(SELECT * FROM monthly {LAST_6})"),
    ),
    "workbench_kpis_all_time": (
        ("whole_fc", "shares", "summary"),
        """
SELECT round(total_revenue, 2) AS revenue, total_orders AS orders, active_customers AS customers,
  coalesce((SELECT CAST(sum(customer_count) AS BIGINT) FROM shares
    WHERE segment_label ILIKE '%risk%'), 0) AS at_risk_customers,
  round((SELECT sum(predicted) FROM (SELECT * FROM whole_fc ORDER BY month DESC LIMIT 3)), 2)
    AS predicted_revenue
FROM summary""",
    ),
    "historical_estimate": (
        ("paid", "monthly"),
        f"""
SELECT CAST((SELECT sum(paid) FROM paid WHERE date_trunc('month', day) IN
    (SELECT month FROM monthly {LAST_6})) AS DOUBLE)
  / (SELECT count(*) FROM (SELECT * FROM monthly {LAST_6})) AS estimate""",
    ),
    "historical_estimate_all_time": (
        ("paid",),
        """
SELECT CAST(sum(paid) AS DOUBLE) / count(DISTINCT date_trunc('month', day)) AS estimate
FROM paid""",
    ),
    "trend_scaled_proxy": (("whole_fc", "cm"), SCALED.format(LAST_6)),
    "trend_scaled_proxy_all_time": (("whole_fc", "cm"), SCALED.format("")),
    "trend_filtered": (
        ("sold",),
        """
SELECT purchase_month AS month, CAST(sum(item_revenue) AS DOUBLE) AS revenue,
  count(DISTINCT order_id) AS order_count,
  count(DISTINCT customer_unique_id) AS customer_count
FROM sold WHERE category = 'promo goods' AND customer_state = 'ASIA' GROUP BY purchase_month""",
    ),
    "recent_orders": (("recent",), "SELECT * FROM recent"),
    "recent_order_rows": (
        ("recent_rows",),
        "SELECT * FROM recent_rows ORDER BY date DESC, raw_id LIMIT 6",
    ),
    "recent_order_search": (
        ("order_rows",),
        "SELECT * FROM order_rows WHERE id ILIKE '%cancel%' OR customer ILIKE '%cancel%' "
        "OR status ILIKE '%cancel%'",
    ),
    "recent_order_range": (
        ("order_rows",),
        """
SELECT * FROM order_rows WHERE CAST(date AS DATE) >=
  CAST((SELECT max(date) FROM order_rows) AS DATE) - 7""",
    ),
    "orders_between": (
        ("c_orders",),
        """
SELECT order_id, order_status, order_purchase_timestamp FROM c_orders
WHERE CAST(order_purchase_timestamp AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'""",
    ),
    "channel_performance": (("channels",), "SELECT * FROM channels"),
    "channel_rows": (
        ("channels",),
        """
SELECT CASE channel WHEN 'credit_card' THEN 'Credit Card' WHEN 'boleto' THEN 'Boleto'
    WHEN 'voucher' THEN 'Voucher' END AS channel,
  revenue AS value, pct_of_total AS change, order_count FROM channels""",
    ),
    "channel_count": (("channels",), "SELECT count(DISTINCT channel) AS channels FROM channels"),
    "activity_heatmap": (("c_orders",), HEATMAP.format("c_orders")),
    "activity_heatmap_newest": (
        ("c_orders",),
        HEATMAP.format(
            "(SELECT * FROM c_orders WHERE order_status <> 'canceled' "
            "ORDER BY order_purchase_timestamp DESC, order_id LIMIT 5000)"
        ),
    ),
    "sql_months_of_revenue": (("monthly",), "SELECT * FROM monthly ORDER BY month DESC LIMIT 6"),
    "sql_best_products": (
        ("tp",),
        """
SELECT CAST(row_number() OVER (ORDER BY total_revenue DESC, product_id) AS INTEGER) AS rank,
  product_id, category, total_revenue, units_sold FROM tp WHERE category ILIKE '%promo%' QUALIFY rank <= 10""",
    ),
    "sql_orders_of_period": (
        ("c_orders",),
        """
SELECT order_id, order_status, order_purchase_timestamp FROM c_orders
WHERE CAST(order_purchase_timestamp AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'""",
    ),
    "sql_channel_performance": (("channels",), "SELECT * FROM channels"),
    "exported_customers": (
        ("clusters",),
        "SELECT id, name, segment, CAST(ltv AS VARCHAR) AS ltv, engagement, churn_proxy || '%' AS churn_proxy "
        f"FROM ({CUSTOMER_ROWS.format('frequency >= 3')})",
    ),
    "exported_trend": (
        ("with_fc",),
        f"""
SELECT month_label, CAST({JS_ROUND.format("coalesce(actual, 0)")} AS VARCHAR) AS revenue,
  CASE WHEN predicted <> 0 THEN CAST({JS_ROUND.format("predicted")} AS VARCHAR) ELSE '' END AS predicted
FROM with_fc""",
    ),
    "exported_categories": (("cm",), CATEGORY_ROWS.format("")),
    "exported_forecast": (
        ("fc",),
        """
SELECT min(model_name) AS model, count(*) AS horizon_days,
  CAST(sum(predicted_revenue) AS DOUBLE) AS predicted_total,
  CAST(sum(coalesce(lower_bound, predicted_revenue)) AS DOUBLE) AS lower_bound,
  CAST(sum(coalesce(upper_bound, predicted_revenue)) AS DOUBLE) AS upper_bound FROM fc""",
    ),
    "logged_runs": (("latest_runs",), "SELECT * FROM latest_runs"),
    "kpi_in_batches": (("snaps",), "SELECT * FROM snaps"),
    "distinct_customers_period": (
        ("buyer_days", "windows"),
        """
SELECT days, w.day, count(DISTINCT c) AS customers FROM windows w
JOIN buyer_days b ON b.day > w.day - days AND b.day <= w.day GROUP BY days, w.day
UNION ALL
SELECT days, day, 0 FROM windows w WHERE NOT EXISTS (
  FROM buyer_days b WHERE b.day > w.day - w.days AND b.day <= w.day)""",
    ),
    "distinct_customers_month": (
        ("base",),
        """
SELECT CAST(date_trunc('month', day) AS DATE) AS period, count(DISTINCT customer_unique_id) AS customers
FROM base WHERE day IS NOT NULL AND customer_unique_id IS NOT NULL GROUP BY 1""",
    ),
    "rejected_rows": (
        ("raw_items",),
        """
SELECT CASE WHEN order_id % 97 = 0 THEN head || ',n/a,' || freight_value
    WHEN order_id % 89 = 0 THEN head || ',' || price
    ELSE substr(head, length(order_id::VARCHAR) + 1) || ',' || price || ',' || freight_value END AS line,
  CASE WHEN order_id % 97 = 0 OR order_id % 89 = 0 THEN 'malformed' ELSE 'no order_id' END AS reason
FROM (
  SELECT *, concat_ws(',', order_id, order_item_id, product_id, seller_id, shipping_limit_date) AS head
  FROM raw_items
) WHERE order_id % 97 = 0 OR order_id % 89 = 0 OR order_id % 83 = 0""",
    ),
    "inferred_profile": (
        ("raw_payments",),
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{kind}' AS inferred, count(*) AS row_count, "
            f"count(*) - count({c}) AS null_count FROM raw_payments"
            for c, kind in (
                ("order_id", "int"),
                ("payment_sequential", "int"),
                ("payment_type", "string"),
                ("payment_installments", "int"),
                ("payment_value", "double"),
            )
        ),
    ),
    "upsert_in_place": (
        ("prices", "seen_prices"),
        f"""
SELECT coalesce(t.product_id, u.product_id) AS product_id, {_keep_or_take("size")} AS size,
  CAST({_keep_or_take("price")} AS DOUBLE) AS price
FROM prices t FULL JOIN seen_prices u ON t.product_id = u.product_id""",
    ),
    "upsert_merge": (
        ("prices", "seen_prices"),
        f"""
SELECT coalesce(t.product_id, u.product_id) AS product_id, {_keep_or_take("size")} AS size,
  CAST({_keep_or_take("price")} AS DOUBLE) AS price
FROM prices t FULL JOIN seen_prices u ON t.product_id = u.product_id""",
    ),
    "upsert_subset": (
        ("prices", "seen_prices"),
        f"""
SELECT coalesce(t.product_id, u.product_id) AS product_id,
  CASE WHEN t.product_id IS NULL THEN u.size ELSE t.size END AS size,
  CAST({_keep_or_take("price")} AS DOUBLE) AS price
FROM prices t FULL JOIN seen_prices u ON t.product_id = u.product_id""",
    ),
    "upsert_ignore": (
        ("prices", "seen_prices"),
        """
SELECT product_id, size, CAST(price AS DOUBLE) AS price FROM prices
UNION ALL SELECT product_id, size, CAST(price AS DOUBLE) FROM seen_prices
WHERE product_id NOT IN (SELECT product_id FROM prices)""",
    ),
    "upsert_forecast": (
        ("fc",),
        f"""
SELECT forecast_date, {_doubles("predicted_revenue, lower_bound, upper_bound")}, model_name FROM (
  SELECT CAST(forecast_date + 7 AS DATE) AS forecast_date, predicted_revenue + 1
    AS predicted_revenue, lower_bound, upper_bound, 'rerun' AS model_name FROM fc
  UNION ALL
  SELECT * FROM fc WHERE forecast_date NOT IN (SELECT CAST(forecast_date + 7 AS DATE) FROM fc)
)""",
    ),
    "nan_to_null": (
        (),
        "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events",
    ),
    "table_profile": (
        ("c_products",),
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, 9 AS column_count, "
            f"count(*) - count({c}) AS null_count FROM c_products"
            for c in (
                "product_id",
                "product_category_name",
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            )
        ),
    ),
    "model_latest": (("latest_runs",), "SELECT * FROM latest_runs"),
    "model_cards": (
        ("latest_runs",),
        """
SELECT name, CAST(floor(shown + 0.5) AS BIGINT) AS value, metric_value AS raw,
  CAST(0.0 AS DOUBLE) AS change, model_name AS model, metric_name AS metric, trained_at
FROM (
  SELECT *, CASE model_name || metric_name WHEN 'kmeanssilhouette' THEN 'K-Means Silhouette'
      WHEN 'alsprecision_at_k' THEN 'ALS Precision@K' WHEN 'alsrmse' THEN 'ALS RMSE'
      WHEN 'sales_forecastr2' THEN 'Forecast R²' END AS name,
    CASE model_name || metric_name WHEN 'kmeanssilhouette' THEN 1 WHEN 'alsprecision_at_k' THEN 2
      WHEN 'alsrmse' THEN 3 WHEN 'sales_forecastr2' THEN 4 END AS position,
    CASE metric_name WHEN 'silhouette' THEN least(1, greatest(-1, metric_value)) * 50.0 + 50.0
      WHEN 'rmse' THEN least(100, greatest(0, floor(metric_value + 0.5)))
      ELSE least(1, greatest(0, metric_value)) * 100.0 END AS shown
  FROM latest_runs
) WHERE position IS NOT NULL""",
    ),
    "model_count": (
        ("latest_runs",),
        "SELECT count(DISTINCT model_name) AS models FROM latest_runs",
    ),
    "interactions": (("bought",), "SELECT * FROM bought"),
    "eligible_users": (
        ("bought",),
        "SELECT customer_unique_id, count(*) AS products FROM bought GROUP BY 1 "
        "HAVING count(*) >= 5",
    ),
    "interaction_split": (("split",), "SELECT * FROM split"),
    "precision_given": (
        ("split", "most_bought"),
        """
SELECT users, hits, CAST(hits AS DOUBLE) / (users * 10) AS precision_at_k FROM (
  SELECT (SELECT count(DISTINCT customer_unique_id) FROM split WHERE part = 'holdout') AS users,
    (SELECT count(*) FROM most_bought r JOIN split s ON r.customer_unique_id = s.customer_unique_id
      AND r.product_id = s.product_id WHERE s.part = 'holdout') AS hits)""",
    ),
    "standardized_features": (
        ("rfm",),
        """
SELECT customer_unique_id,
  round((recency_days - avg(recency_days) OVER ()) / stddev_samp(recency_days) OVER (), 6)
    AS recency_days_z,
  round((frequency - avg(frequency) OVER ()) / stddev_samp(frequency) OVER (), 6) AS frequency_z,
  round((monetary - avg(monetary) OVER ()) / stddev_samp(monetary) OVER (), 6) AS monetary_z
FROM rfm""",
    ),
    "daily_series": (("series",), "SELECT * FROM series"),
    "forecast_features": (("features",), "SELECT * FROM features"),
    "forecast_split": (
        ("features",),
        "SELECT *, row_number() OVER (ORDER BY date DESC) <= 30 AS is_holdout FROM features",
    ),
    "forecast_by_month": (("fc_month",), "SELECT * FROM fc_month"),
    "forecast_totals": (
        ("fc",),
        """
SELECT CAST(sum(predicted_revenue) AS DOUBLE) AS predicted_total,
  CAST(sum(coalesce(lower_bound, predicted_revenue)) AS DOUBLE) AS lower,
  CAST(sum(coalesce(upper_bound, predicted_revenue)) AS DOUBLE) AS upper,
  min(model_name) AS model, count(*) AS n FROM fc""",
    ),
    "customer_segments_check": (
        ("rfm",),
        """
SELECT count(*) AS customers, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS without_label,
  CAST(0 AS BIGINT) AS bad_distances FROM rfm""",
    ),
    "recommendations_check": (
        ("split",),
        """
SELECT customers, customers * 10 AS rows, CAST(0 AS BIGINT) AS unknown_products,
  CAST(0 AS BIGINT) AS already_bought, CAST(0 AS BIGINT) AS rank_gaps, CAST(0 AS BIGINT) AS repeats
FROM (SELECT count(DISTINCT customer_unique_id) AS customers FROM split WHERE part = 'train')""",
    ),
    "top_recommendations_check": (
        ("split",),
        """
SELECT customers, customers * 10 AS rows, 10 AS last_rank, CAST(0 AS BIGINT) AS without_revenue,
  CAST(3 AS BIGINT) AS tabs, CAST(0 AS BIGINT) AS tabs_without_name
FROM (SELECT count(DISTINCT customer_unique_id) AS customers FROM split WHERE part = 'train')""",
    ),
    "sales_forecast_check": (
        ("series",),
        """
SELECT series, CAST(max(date) + 1 AS DATE) AS first_day, CAST(max(date) + 30 AS DATE) AS last_day,
  CAST(30 AS BIGINT) AS days, CAST(0 AS BIGINT) AS bad_bands FROM series GROUP BY series""",
    ),
    "sales_forecast_by_seller": (("seller_forecasts",), "SELECT * FROM seller_forecasts"),
    "forecast_quality_by_seller": (("seller_quality",), "SELECT * FROM seller_quality"),
    "customer_segments": (("km_segments",), "SELECT * FROM km_segments"),
    "segment_centroids": (
        ("km_names", "km_scale"),
        """
SELECT cid AS cluster_id, label AS segment_label, round(c0, 6) AS recency_days_z,
  round(c1, 6) AS frequency_z, round(c2, 6) AS monetary_z, round((c0 * d0 + m0) / 100, 6) AS recency_days,
  round((c1 * d1 + m1) / 100, 6) AS frequency, round((c2 * d2 + m2) / 100, 6) AS monetary
FROM km_names, km_scale""",
    ),
    "segment_silhouette": (("km_silhouette",), "SELECT * FROM km_silhouette"),
    "segment_distribution": (("km_shares",), "SELECT * FROM km_shares"),
    "customer_table": (("km_clusters",), CUSTOMER_ROWS.format("true").replace("FROM clusters", "FROM km_clusters")),
    "cluster_scatter": (
        ("km_clusters",),
        """
SELECT segment_label AS cluster, frequency, monetary FROM km_clusters
WHERE monetary IS NOT NULL ORDER BY recency_days DESC, customer_unique_id LIMIT 500""",
    ),
    "clusters_by_rule": (("clusters",), "SELECT * FROM clusters"),
    "segment_shares_by_rule": (("shares",), "SELECT * FROM shares"),
    "segment_rows_by_rule": (
        ("shares",),
        f"SELECT segment_label AS name, {JS_ROUND.format('pct')} AS value, "
        "customer_count AS customers FROM shares",
    ),
    "segment_total_by_rule": (
        ("clusters",),
        "SELECT count(*) AS customers FROM clusters",
    ),
    "customer_rows_by_rule": (("clusters",), CUSTOMER_ROWS.format("frequency >= 3")),
    "customer_rows_new": (("clusters",), CUSTOMER_ROWS.format("segment_label = 'New'")),
    "cluster_scatter_by_rule": (
        ("clusters",),
        """
SELECT segment_label AS cluster, frequency, monetary FROM clusters
WHERE monetary IS NOT NULL ORDER BY recency_days DESC, customer_unique_id LIMIT 500""",
    ),
    "cluster_scatter_hashed": (
        ("clusters",),
        """
SELECT segment_label AS cluster, frequency, monetary FROM clusters
ORDER BY md5(CAST(customer_unique_id AS VARCHAR)), customer_unique_id LIMIT 500""",
    ),
    "recommendations_most_bought": (("shown_recs",), "SELECT * FROM shown_recs"),
    "customer_picks_most_bought": (
        ("shown_recs",),
        f"""
SELECT ({PRODUCT_NAME}) AS id, product_id,
  CASE WHEN total_revenue IS NULL THEN 99 ELSE CAST(least(2500, greatest(29,
    floor(total_revenue / rank + 0.5))) AS BIGINT) END AS price_proxy,
  greatest(75, {JS_ROUND.format("100 - rank * 2.5")}) AS match_proxy, score, rank,
  {title("category")} AS category, avg_review_score AS review_score
FROM shown_recs WHERE customer_unique_id = (
  SELECT customer_unique_id FROM shown_recs
  ORDER BY md5(customer_unique_id || '|42'), customer_unique_id LIMIT 1)
ORDER BY rank LIMIT 4""",
    ),
    "recommendation_tabs_most_bought": (
        ("shown_recs",),
        f"""
SELECT {title("category")} AS category, recommended FROM (
  SELECT coalesce(category, 'Other') AS category, count(*) AS recommended
  FROM shown_recs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)""",
    ),
}


def oracle_statements() -> dict[str, str]:
    return {name: statement(needs, sql) for name, (needs, sql) in QUERIES.items()}
