"""Named SQL parts: sample tables as raw tables, cleaning, facts and metrics."""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S'"


def text_of(expression: str) -> str:
    return f"strftime({expression}, {TS})"


def parsed(column: str) -> str:
    return f"try_strptime({column}, {TS})"


def half_up(numerator: str, denominator: str) -> str:
    """Whole-number quotient of two non-negative integers, halves up."""
    n, d = f"({numerator})::HUGEINT", f"({denominator})::HUGEINT"
    return f"((2 * {n} + {d}) // (2 * {d}))"


def money_mean(total: str, count: str) -> str:
    return f"{half_up(f'({total}) * 100', count)} / 100.0"


def score_mean(expression: str) -> str:
    """Mean of multiples of one half at two decimals, in integer arithmetic."""
    doubled = f"sum(({expression}) * 2)"
    return (
        f"CASE WHEN count({expression}) > 0 THEN "
        f"{half_up(f'{doubled} * 100', f'2 * count({expression})')} / 100.0 END"
    )


def title(expression: str) -> str:
    words = f"list_filter(string_split_regex({expression}, '[_\\s]+'), lambda w: w <> '')"
    cased = f"list_transform({words}, lambda w: upper(w[1]) || substr(w, 2))"
    return (
        f"CASE WHEN {expression} IS NULL OR {expression} = '' THEN '—' "
        f"ELSE array_to_string({cased}, ' ') END"
    )


def short(expression: str, length: int) -> str:
    return f"upper(substr(CAST({expression} AS VARCHAR), 1, {length}))"


def first_per(keys: str, order: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


def nulls_first(*columns: str) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


NOT_SOLD = "('canceled', 'unavailable')"

# name -> (parts it reads, statement)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, needs: tuple[str, ...], sql: str) -> None:
    PARTS[name] = (needs, sql)


# ------------------------------------------------------------- raw tables

STATUS = """CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
    ELSE CASE o_orderpriority WHEN '5-LOW' THEN 'canceled'
    WHEN '4-NOT SPECIFIED' THEN 'unavailable' ELSE 'processing' END END"""

part(
    "raw_orders",
    (),
    f"""
SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL
       WHEN o_orderkey % 2 = 0 THEN ' ' || upper({STATUS}) ELSE {STATUS} END AS order_status,
  CASE WHEN o_orderkey % 101 = 0 THEN 'n/a'
       ELSE {text_of("o_orderdate + to_minutes(o_orderkey * 7 % 1440)")} END
    AS order_purchase_timestamp,
  {text_of("o_orderdate + INTERVAL 1 DAY")} AS order_approved_at,
  {text_of("o_orderdate + INTERVAL 3 DAY")} AS order_delivered_carrier_date,
  {text_of("o_orderdate + INTERVAL 10 DAY")} AS order_delivered_customer_date,
  {text_of("o_orderdate + INTERVAL 14 DAY")} AS order_estimated_delivery_date
FROM orders""",
)
part(
    "raw_customers",
    (),
    """
SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id,
  lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
  n_name AS customer_city, r_name AS customer_state
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
part(
    "raw_sellers",
    (),
    """
SELECT s_suppkey AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
  n_name AS seller_city, lower(r_name) AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
part(
    "raw_products",
    (),
    """
SELECT p_partkey AS product_id,
  CASE WHEN p_size = 50 THEN NULL ELSE ' ' || p_type END AS product_category_name,
  CAST(NULL AS INTEGER) AS product_name_lenght, CAST(NULL AS INTEGER) AS product_description_lenght,
  CAST(NULL AS INTEGER) AS product_photos_qty, p_size AS product_weight_g,
  CAST(NULL AS INTEGER) AS product_length_cm, CAST(NULL AS INTEGER) AS product_height_cm,
  CAST(NULL AS INTEGER) AS product_width_cm
FROM part""",
)
part(
    "raw_categories",
    (),
    """
SELECT DISTINCT lower(p_type) AS product_category_name,
  lower(p_type) || ' goods' AS product_category_name_english
FROM part WHERE lower(p_type) <> 'economy'""",
)
part(
    "raw_items",
    (),
    f"""
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
  l_suppkey AS seller_id, {text_of("l_shipdate")} AS shipping_limit_date,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS DECIMAL(12,2)) AS freight_value
FROM lineitem""",
)
part(
    "raw_payments",
    (),
    """
SELECT l_orderkey AS order_id,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS payment_sequential,
  CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END
    AS payment_type,
  max(l_linenumber) AS payment_installments,
  sum(CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(l_quantity AS DECIMAL(12,2))) AS payment_value
FROM lineitem GROUP BY l_orderkey, l_returnflag""",
)
part(
    "raw_reviews",
    (),
    f"""
SELECT event_id AS review_id, CAST(floor(event_id / 2) AS BIGINT) * 3 AS order_id,
  CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 AS review_score,
  CAST(NULL AS VARCHAR) AS review_comment_title, CAST(NULL AS VARCHAR) AS review_comment_message,
  {text_of("ts")} AS review_creation_date, CAST(NULL AS VARCHAR) AS review_answer_timestamp
FROM events""",
)

# --------------------------------------------------------------- cleaning

part(
    "c_categories",
    ("raw_categories",),
    f"""
SELECT lower(trim(product_category_name)) AS product_category_name,
  lower(trim(product_category_name_english)) AS product_category_name_english
FROM raw_categories WHERE product_category_name IS NOT NULL
{first_per("lower(trim(product_category_name))",
           nulls_first("lower(trim(product_category_name_english))"))}""",
)
part(
    "c_customers",
    ("raw_customers",),
    f"""
SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
  trim(customer_city) AS customer_city, upper(trim(customer_state)) AS customer_state
FROM raw_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL
{first_per("customer_id", nulls_first("customer_unique_id", "customer_zip_code_prefix",
           "trim(customer_city)", "upper(trim(customer_state))"))}""",
)
part(
    "c_sellers",
    ("raw_sellers",),
    f"""
SELECT seller_id, seller_zip_code_prefix, trim(seller_city) AS seller_city,
  upper(trim(seller_state)) AS seller_state
FROM raw_sellers WHERE seller_id IS NOT NULL
{first_per("seller_id", nulls_first("seller_zip_code_prefix", "trim(seller_city)",
           "upper(trim(seller_state))"))}""",
)
part(
    "c_products",
    ("raw_products",),
    f"""
SELECT * REPLACE (lower(trim(product_category_name)) AS product_category_name)
FROM raw_products WHERE product_id IS NOT NULL
{first_per("product_id", nulls_first("lower(trim(product_category_name))", "product_weight_g"))}""",
)
part(
    "c_orders",
    ("raw_orders",),
    f"""
SELECT * FROM (
  SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
    {parsed("order_purchase_timestamp")} AS order_purchase_timestamp,
    {parsed("order_approved_at")} AS order_approved_at,
    {parsed("order_delivered_carrier_date")} AS order_delivered_carrier_date,
    {parsed("order_delivered_customer_date")} AS order_delivered_customer_date,
    {parsed("order_estimated_delivery_date")} AS order_estimated_delivery_date
  FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
  {first_per("order_id", "customer_id")}
) WHERE order_purchase_timestamp IS NOT NULL""",
)
part(
    "c_items",
    ("raw_items",),
    f"""
SELECT order_id, order_item_id, product_id, seller_id,
  {parsed("shipping_limit_date")} AS shipping_limit_date, price, freight_value
FROM raw_items
WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL
  AND seller_id IS NOT NULL AND price >= 0 AND freight_value >= 0
{first_per("order_id, order_item_id", nulls_first("product_id", "seller_id", "price",
           "freight_value", "shipping_limit_date"))}""",
)
part(
    "c_payments",
    ("raw_payments",),
    f"""
SELECT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type,
  payment_installments, payment_value
FROM raw_payments
WHERE order_id IS NOT NULL AND payment_sequential IS NOT NULL
  AND payment_value >= 0 AND payment_installments >= 0
{first_per("order_id, payment_sequential",
           nulls_first("lower(trim(payment_type))", "payment_installments", "payment_value"))}""",
)
part(
    "c_reviews",
    ("raw_reviews",),
    f"""
SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
  {parsed("review_creation_date")} AS review_creation_date,
  {parsed("review_answer_timestamp")} AS review_answer_timestamp
FROM raw_reviews
WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5
{first_per("review_id, order_id", nulls_first("review_score", "review_creation_date"))}""",
)
part(
    "all_categories",
    ("c_categories", "c_products"),
    """
SELECT * FROM c_categories UNION ALL
SELECT product_category_name, replace(product_category_name, '_', ' ')
FROM (SELECT product_category_name FROM c_products WHERE product_category_name IS NOT NULL
      EXCEPT SELECT product_category_name FROM c_categories)""",
)

# ------------------------------------------------------------------ facts

part(
    "pay",
    ("c_payments",),
    f"""
SELECT p.*, d.payment_type_dominant FROM (
  SELECT order_id, sum(payment_value) AS order_total_paid,
    max(payment_installments) AS payment_installments_max FROM c_payments GROUP BY order_id
) p JOIN (
  SELECT order_id, payment_type AS payment_type_dominant FROM c_payments
  {first_per("order_id", "payment_value DESC, payment_sequential")}
) d USING (order_id)""",
)
part(
    "rev",
    ("c_reviews",),
    """
SELECT order_id, avg(review_score) AS review_score_avg, count(review_id) AS review_count
FROM c_reviews GROUP BY order_id""",
)
part(
    "prod",
    ("c_products", "all_categories"),
    """
SELECT product_id, p.product_category_name AS category_pt,
  coalesce(product_category_name_english, p.product_category_name, 'unknown') AS category,
  product_weight_g
FROM c_products p LEFT JOIN all_categories c ON p.product_category_name = c.product_category_name""",
)
part(
    "master",
    ("c_items", "c_orders", "c_customers", "prod", "c_sellers", "pay", "rev"),
    f"""
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price,
  i.freight_value, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
  o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date,
  c.customer_unique_id, c.customer_city, c.customer_state, p.category_pt, p.category,
  p.product_weight_g, s.seller_city, s.seller_state, pay.order_total_paid,
  pay.payment_installments_max, pay.payment_type_dominant, rev.review_score_avg, rev.review_count,
  i.price + i.freight_value AS item_revenue,
  CAST(o.order_purchase_timestamp AS DATE) AS purchase_date,
  CAST(date_trunc('month', o.order_purchase_timestamp) AS DATE) AS purchase_month,
  o.order_status IN {NOT_SOLD} AS is_canceled
FROM c_items i
LEFT JOIN c_orders o ON i.order_id = o.order_id
LEFT JOIN c_customers c ON o.customer_id = c.customer_id
LEFT JOIN prod p ON i.product_id = p.product_id
LEFT JOIN c_sellers s ON i.seller_id = s.seller_id
LEFT JOIN pay ON i.order_id = pay.order_id
LEFT JOIN rev ON i.order_id = rev.order_id""",
)
part("sold", ("master",), "SELECT * FROM master WHERE NOT is_canceled")

# -------------------------------------------------------- customers, KPIs

part(
    "rfm",
    ("sold",),
    f"""
SELECT customer_unique_id,
  CAST(date_diff('day', CAST(max(order_purchase_timestamp) AS DATE),
    (SELECT CAST(max(order_purchase_timestamp) AS DATE) FROM sold)) AS INTEGER) AS recency_days,
  count(DISTINCT order_id) AS frequency,
  CAST(sum(order_value) AS DOUBLE) AS monetary,
  {money_mean("sum(order_value)", "count(DISTINCT order_id)")} AS avg_order_value,
  min(order_purchase_timestamp) AS first_purchase_at,
  max(order_purchase_timestamp) AS last_purchase_at,
  count(DISTINCT order_id) AS total_orders
FROM (
  SELECT customer_unique_id, order_id, order_purchase_timestamp,
    coalesce(any_value(order_total_paid), 0) AS order_value
  FROM sold WHERE customer_unique_id IS NOT NULL GROUP BY ALL
) GROUP BY customer_unique_id""",
)
part(
    "rev_daily",
    ("sold",),
    f"""
SELECT purchase_date AS snapshot_date, CAST(sum(item_revenue) AS DOUBLE) AS total_revenue,
  count(DISTINCT order_id) AS total_orders,
  {money_mean("sum(item_revenue)", "count(DISTINCT order_id)")} AS avg_order_value
FROM sold WHERE purchase_date IS NOT NULL GROUP BY purchase_date""",
)
part(
    "base",
    ("sold",),
    """
SELECT DISTINCT purchase_date AS day, customer_unique_id, order_id FROM sold
WHERE purchase_date IS NOT NULL AND customer_unique_id IS NOT NULL""",
)
part(
    "buyer_days",
    ("base",),
    "SELECT DISTINCT day, customer_unique_id AS c FROM base WHERE c IS NOT NULL AND day IS NOT NULL",
)
part(
    "windows",
    ("buyer_days",),
    """
SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day, days
FROM buyer_days, (SELECT CAST(unnest([7, 30, 90]) AS INTEGER) AS days) GROUP BY days""",
)
part(
    "cust_kpi",
    ("base",),
    f"""
SELECT dates.snapshot_date, total_customers, coalesce(active_customers, 0) AS active_customers,
  coalesce(repeat_rate, 0) AS repeat_rate
FROM (SELECT DISTINCT day AS snapshot_date FROM base) dates
JOIN (
  SELECT snapshot_date, count(DISTINCT customer_unique_id) AS total_customers
  FROM (SELECT DISTINCT day AS snapshot_date FROM base) d
  JOIN (SELECT customer_unique_id, min(day) AS first_day FROM base GROUP BY 1) f
    ON f.first_day <= d.snapshot_date GROUP BY 1
) t ON t.snapshot_date = dates.snapshot_date
LEFT JOIN (
  SELECT snapshot_date, count(DISTINCT customer_unique_id) AS active_customers
  FROM (SELECT DISTINCT day AS snapshot_date FROM base) d
  JOIN base b ON b.day BETWEEN d.snapshot_date - 29 AND d.snapshot_date GROUP BY 1
) a ON a.snapshot_date = dates.snapshot_date
LEFT JOIN (
  SELECT snapshot_date,
    {half_up("count(CASE WHEN n >= 2 THEN 1 END) * 10000", "count(*)")} / 10000.0 AS repeat_rate
  FROM (
    SELECT snapshot_date, customer_unique_id, count(DISTINCT order_id) AS n
    FROM (SELECT DISTINCT day AS snapshot_date FROM base) d
    JOIN base b ON b.day <= d.snapshot_date GROUP BY 1, 2
  ) GROUP BY 1
) r ON r.snapshot_date = dates.snapshot_date""",
)
part(
    "snaps",
    ("rev_daily", "cust_kpi"),
    """
SELECT r.snapshot_date, total_revenue, total_orders,
  coalesce(total_customers, 0) AS total_customers,
  coalesce(active_customers, 0) AS active_customers, avg_order_value,
  coalesce(repeat_rate, 0.0) AS repeat_rate
FROM rev_daily r LEFT JOIN cust_kpi c ON r.snapshot_date = c.snapshot_date""",
)


def _delta(measure: str) -> str:
    now = f"CAST({measure} AS DOUBLE)"
    before = f"lag({now}) OVER (ORDER BY snapshot_date)"
    return f"CASE WHEN {before} <> 0 THEN ({now} - {before}) / {before} END"


part(
    "deltas",
    ("snaps",),
    f"""
SELECT *, {_delta("total_revenue")} AS revenue_delta, {_delta("total_orders")} AS orders_delta,
  {_delta("active_customers")} AS active_customers_delta, {_delta("avg_order_value")} AS aov_delta
FROM snaps""",
)
part("summary", ("deltas",), "SELECT * FROM deltas ORDER BY snapshot_date DESC LIMIT 1")

# ------------------------------------------------------ products, categories

part(
    "pm",
    ("sold",),
    f"""
SELECT product_id, total_revenue, units_sold, total_orders, avg_review_score, review_count,
  last_sold_at,
  CASE WHEN idle > 180 THEN 'out_of_stock' WHEN idle > 90 THEN 'low' ELSE 'healthy' END
    AS inventory_status
FROM (
  SELECT product_id, CAST(sum(item_revenue) AS DOUBLE) AS total_revenue, count(*) AS units_sold,
    count(DISTINCT order_id) AS total_orders, {score_mean("review_score_avg")} AS avg_review_score,
    CAST(sum(coalesce(review_count, 0)) AS BIGINT) AS review_count,
    max(order_purchase_timestamp) AS last_sold_at,
    date_diff('day', CAST(max(order_purchase_timestamp) AS DATE),
      (SELECT CAST(max(order_purchase_timestamp) AS DATE) FROM sold)) AS idle
  FROM sold WHERE product_id IS NOT NULL GROUP BY product_id
)""",
)
part(
    "cm",
    ("sold",),
    f"""
SELECT category, CAST(sum(item_revenue) AS DOUBLE) AS revenue,
  count(DISTINCT order_id) AS order_count, count(*) AS units_sold,
  {score_mean("review_score_avg")} AS avg_review_score
FROM sold WHERE category IS NOT NULL GROUP BY category""",
)
part(
    "tp",
    ("pm", "prod"),
    "SELECT pm.*, category FROM pm LEFT JOIN prod ON pm.product_id = prod.product_id",
)
PRODUCT_NAME = f"{title('''coalesce(category, 'Product')''')} || ' · ' || {short('product_id', 4)}"
part(
    "alerts",
    ("tp", "c_orders"),
    f"""
SELECT total_revenue, ({PRODUCT_NAME}) AS product, product_id,
  CASE inventory_status WHEN 'out_of_stock' THEN 'LOW_STOCK' ELSE 'OVERSTOCK' END AS type,
  CASE inventory_status WHEN 'out_of_stock' THEN 'high' ELSE 'medium' END AS severity,
  CASE inventory_status WHEN 'out_of_stock'
    THEN 'No sale for ' || idle || ' days. ' || units_sold
      || ' historical units sold — consider sunset or relaunch.'
    ELSE 'Slow movement detected. ' || units_sold || ' historical units sold.' END AS detail,
  idle || 'd idle' AS eta
FROM (
  SELECT *, date_diff('day', CAST(last_sold_at AS DATE),
    (SELECT CAST(max(order_purchase_timestamp) AS DATE) FROM c_orders
     WHERE order_status NOT IN {NOT_SOLD})) AS idle
  FROM tp WHERE inventory_status <> 'healthy'
)""",
)

# --------------------------------------------------------- revenue over time

part(
    "paid",
    ("c_orders", "c_customers", "c_payments"),
    f"""
SELECT o.order_id, CAST(o.order_purchase_timestamp AS DATE) AS day, c.customer_unique_id, p.paid
FROM c_orders o LEFT JOIN c_customers c ON o.customer_id = c.customer_id
JOIN (SELECT order_id, sum(payment_value) AS paid FROM c_payments GROUP BY 1) p
  ON o.order_id = p.order_id
WHERE o.order_status NOT IN {NOT_SOLD}""",
)
part(
    "monthly",
    ("paid",),
    """
SELECT CAST(date_trunc('month', day) AS DATE) AS month, CAST(sum(paid) AS DOUBLE) AS revenue,
  count(*) AS order_count, count(DISTINCT customer_unique_id) AS customer_count
FROM paid GROUP BY 1""",
)
part(
    "daily7",
    ("paid",),
    """
SELECT day, count(*) AS order_count, CAST(sum(paid) AS DOUBLE) AS revenue
FROM paid WHERE day > (SELECT max(day) FROM paid) - 7 GROUP BY day""",
)
part("last12", ("monthly",), "SELECT * FROM monthly ORDER BY month DESC LIMIT 12")
part(
    "fc",
    (),
    """
SELECT forecast_date, predicted_revenue,
  CASE WHEN dayofyear(forecast_date) % 5 <> 0 THEN predicted_revenue - 1000 END AS lower_bound,
  CASE WHEN dayofyear(forecast_date) % 5 <> 0 THEN predicted_revenue + 1000 END AS upper_bound,
  'sample' AS model_name
FROM (SELECT CAST(o_orderdate AS DATE) AS forecast_date,
        sum(CAST(o_totalprice AS DECIMAL(12,2))) AS predicted_revenue FROM orders GROUP BY 1)""",
)
part(
    "fc_month",
    ("fc",),
    """
SELECT CAST(date_trunc('month', forecast_date) AS DATE) AS month,
  CAST(sum(predicted_revenue) AS DOUBLE) AS predicted FROM fc GROUP BY 1""",
)
part(
    "with_fc",
    ("last12", "fc_month"),
    """
SELECT a.month, strftime(a.month, '%b') AS month_label, revenue AS actual, order_count,
  customer_count, coalesce(predicted, revenue) AS predicted
FROM last12 a LEFT JOIN fc_month f ON a.month = f.month""",
)

part(
    "whole_fc",
    ("monthly", "fc_month"),
    """
SELECT a.month, strftime(a.month, '%b') AS month_label, revenue AS actual, order_count,
  customer_count, coalesce(predicted, revenue) AS predicted
FROM monthly a LEFT JOIN fc_month f ON a.month = f.month""",
)

# --------------------------------------------------------- orders, channels

part(
    "recent",
    ("c_orders", "c_customers", "c_payments"),
    """
SELECT o.order_id, order_status, order_purchase_timestamp, customer_unique_id, customer_state,
  CAST(coalesce((SELECT sum(payment_value) FROM c_payments p WHERE p.order_id = o.order_id), 0)
    AS DOUBLE) AS order_total
FROM (SELECT * FROM c_orders ORDER BY order_purchase_timestamp DESC, order_id LIMIT 50) o
LEFT JOIN c_customers c ON o.customer_id = c.customer_id""",
)
part(
    "described",
    ("c_orders", "c_customers", "c_payments"),
    """
SELECT o.order_id, order_status, order_purchase_timestamp, customer_unique_id, customer_state,
  CAST(coalesce(total, 0) AS DOUBLE) AS order_total
FROM c_orders o LEFT JOIN c_customers c ON o.customer_id = c.customer_id
LEFT JOIN (SELECT order_id, sum(payment_value) AS total FROM c_payments GROUP BY 1) p
  ON o.order_id = p.order_id""",
)
ROWS = f"""
SELECT {short("order_id", 8)} AS id, order_id AS raw_id,
  CASE WHEN customer_unique_id IS NULL THEN 'Anonymous'
    ELSE 'Customer ' || {short("customer_unique_id", 8)}
      || coalesce(' · ' || customer_state, '') END AS customer,
  CASE WHEN order_status IN ('delivered', 'shipped') THEN 'Delivered'
    WHEN order_status IN {NOT_SOLD} THEN 'Cancelled' ELSE 'Processing' END AS status,
  order_purchase_timestamp AS date, order_total AS amount
FROM """
part("recent_rows", ("recent",), ROWS + "recent")
part("order_rows", ("described",), ROWS + "described")
part(
    "channels",
    ("c_payments",),
    """
SELECT payment_type AS channel, CAST(sum(payment_value) AS DOUBLE) AS revenue,
  count(DISTINCT order_id) AS order_count,
  round(CAST(sum(payment_value) AS DOUBLE)
    / (SELECT CAST(sum(payment_value) AS DOUBLE) FROM c_payments) * 100.0, 2) AS pct_of_total
FROM c_payments GROUP BY payment_type""",
)

# ------------------------------------------------------------ models, merges

part(
    "bought",
    ("sold",),
    """
SELECT customer_unique_id, product_id, CAST(count(*) AS DOUBLE) AS rating FROM sold
WHERE customer_unique_id IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL""",
)
part(
    "split",
    ("bought",),
    """
SELECT customer_unique_id, product_id, rating,
  CASE WHEN count(*) OVER (PARTITION BY customer_unique_id) >= 2
    AND CAST('0x' || substr(md5(customer_unique_id || '|' || product_id || '|42'), 1, 8) AS BIGINT)
      % 100 >= 90 THEN 'holdout' ELSE 'train' END AS part
FROM bought""",
)
part(
    "most_bought",
    ("bought",),
    """
SELECT customer_unique_id, product_id, rating AS score, CAST(row_number() OVER (
    PARTITION BY customer_unique_id ORDER BY rating DESC, product_id) AS INTEGER) AS rank
FROM bought QUALIFY rank <= 10""",
)
part(
    "shown_recs",
    ("most_bought", "prod", "pm"),
    """
SELECT customer_unique_id, r.product_id, rank, score, category, avg_review_score, total_revenue
FROM most_bought r JOIN prod ON r.product_id = prod.product_id
LEFT JOIN pm ON r.product_id = pm.product_id""",
)
part(
    "clusters",
    ("rfm",),
    """
SELECT *, 0 AS cluster_id, CASE WHEN frequency >= 12 THEN 'VIP' WHEN frequency >= 9 THEN 'Loyal'
    WHEN frequency >= 6 THEN 'At Risk' ELSE 'New' END AS segment_label,
  CAST(0.0 AS DOUBLE) AS distance_to_centroid
FROM rfm""",
)
part(
    "shares",
    ("clusters",),
    """
SELECT segment_label, count(*) AS customer_count,
  round(count(*) / (SELECT count(*) FROM clusters) * 100.0, 2) AS pct
FROM clusters GROUP BY segment_label""",
)
part(
    "series",
    ("sold",),
    """
SELECT 'total' AS series, CAST(day AS DATE) AS date,
  CAST(coalesce(revenue, 0) AS DOUBLE) AS revenue
FROM (SELECT unnest(generate_series(min(purchase_date), max(purchase_date), INTERVAL 1 DAY)) AS day
      FROM sold) calendar
LEFT JOIN (SELECT purchase_date, sum(item_revenue) AS revenue FROM sold GROUP BY 1) d
  ON d.purchase_date = CAST(day AS DATE)""",
)
part(
    "features",
    ("series",),
    """
SELECT series, date, revenue,
  CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS trend,
  CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(month(date) AS INTEGER) AS month,
  lag(revenue, 1) OVER (ORDER BY date) AS lag_1, lag(revenue, 7) OVER (ORDER BY date) AS lag_7,
  round(avg(revenue) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 4)
    AS roll_mean_7
FROM series QUALIFY lag_7 IS NOT NULL""",
)
part(
    "runs",
    (),
    """
SELECT list_extract(['kmeans', 'als', 'als', 'sales_forecast', 'sales_forecast', 'sales_forecast'],
    event_id % 6 + 1) AS model_name,
  list_extract(['silhouette', 'rmse', 'precision_at_k', 'rmse', 'r2', 'mean_bias'],
    event_id % 6 + 1) AS metric_name,
  value / 100.0 AS metric_value, props AS params, ts AS trained_at, event_id AS run_id
FROM events""",
)
part(
    "latest_runs",
    ("runs",),
    f"""SELECT model_name, metric_name, metric_value, params, trained_at, run_id FROM runs
{first_per("model_name, metric_name", "trained_at DESC, run_id DESC")}""",
)
part(
    "prices",
    (),
    """
SELECT p_partkey AS product_id, p_size AS size, CAST(p_retailprice AS DECIMAL(12,2)) AS price
FROM part""",
)
part(
    "seen_prices",
    (),
    """
SELECT l_partkey * 2 AS product_id, max(l_linenumber) AS size,
  max(CAST(l_extendedprice AS DECIMAL(12,2))) AS price
FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1""",
)
