"""Queries behind the dashboard pages, each with its parameters.

Top-k results sort by a unique last key.  Measures that the pages make up from
other columns keep ``proxy`` in their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import rules
from tallyloom.functions.dates import month_label, month_start, preset, weekday_label
from tallyloom.functions.text import (
    contains_any,
    equals_unless_all,
    labelled_id,
    short_id,
    title_case,
)
from tallyloom.operators.facts import MONEY_TOTAL
from tallyloom.plans.views import best_sellers

TRAILING_MONTHS = 12
# Days of the week as the heat map names them, Monday first.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def trailing(df: DataFrame, column: str, rows: int | None) -> DataFrame:
    """The last rows of a series in ascending order; no count keeps all of it."""
    if rows is None:
        return df
    return df.orderBy(F.col(column).desc()).limit(rows).orderBy(column)


# ---------------------------------------------------------------- KPI cards


# Key, title, summary column and change column of the four cards.
CARDS = (
    ("revenue", "Total Revenue", "total_revenue", "revenue_delta"),
    ("orders", "Total Orders", "total_orders", "orders_delta"),
    ("aov", "Avg Order Value", "avg_order_value", "aov_delta"),
    ("active", "Active Customers", "active_customers", "active_customers_delta"),
)


def kpi_cards(summary: DataFrame) -> DataFrame:
    """The summary row as four cards with the change in percent."""
    rows = [
        F.struct(
            F.lit(key).alias("key"),
            F.lit(label).alias("label"),
            F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("value"),
            F.coalesce(F.col(delta) * 100.0, F.lit(0.0)).alias("change"),
        )
        for key, label, value, delta in CARDS
    ]
    return summary.select(F.inline(F.array(*rows)))


def period_cards(monthly: DataFrame, summary: DataFrame, range_name: str) -> DataFrame:
    """The cards for a period: its totals without a change.

    All time, and a period without any month, show the summary.
    """
    base = kpi_cards(summary)
    if preset(range_name).months is None:
        return base
    totals = period_totals(monthly, range_name).filter(F.col("revenue").isNotNull())
    columns = {"revenue": "revenue", "orders": "orders", "aov": "aov", "active": "customers"}
    values = [
        F.struct(F.lit(key).alias("key"), F.col(column).cast("double").alias("total"))
        for key, column in columns.items()
    ]
    of_period = totals.select(F.inline(F.array(*values)))
    return base.join(of_period, "key", "left").select(
        "key",
        "label",
        F.coalesce("total", "value").alias("value"),
        F.when(F.col("total").isNull(), F.col("change")).otherwise(F.lit(0.0)).alias("change"),
    )


def period_totals(monthly: DataFrame, range_name: str) -> DataFrame:
    """Revenue, orders, mean order value and peak monthly customers of a period."""
    window = trailing(monthly, "month", preset(range_name).months)
    totals = window.agg(
        F.sum("revenue").cast("double").alias("revenue"),
        F.sum("order_count").alias("orders"),
        F.max("customer_count").alias("customers"),
    )
    mean = F.when(F.col("orders") > 0, F.col("revenue") / F.col("orders")).otherwise(0.0)
    return totals.withColumns({"aov": mean, "change": F.lit(0.0)})


def workbench_kpis(
    trend: DataFrame, segments: DataFrame, summary: DataFrame, range_name: str
) -> DataFrame:
    """Totals of the shown trend, at-risk customers, and the last three predictions.

    ``trend`` is the whole monthly trend with forecast, scaled or not.  All time, and
    a period without any month, show the summary instead of totals.
    """
    months = preset(range_name).months
    shown = trailing(trend, "month", months)
    predicted = trailing(shown, "month", 3).agg(F.sum("predicted").alias("p")).scalar()
    at_risk = (
        segments.filter(F.lower("segment_label").contains("risk"))
        .agg(F.sum("customer_count").alias("n"))
        .scalar()
    )
    base = summary.select(
        F.col("total_revenue").cast("double").alias("revenue"),
        F.col("total_orders").alias("orders"),
        F.col("active_customers").alias("customers"),
    )
    kept = base
    if months is not None:
        totals = shown.agg(
            F.sum("actual").alias("revenue"),
            F.sum("order_count").alias("orders"),
            F.max("customer_count").alias("customers"),
        )
        # The first of the two rows that has a revenue: the period, else the summary.
        ranked = totals.withColumn("source", F.lit(0)).unionByName(
            base.withColumn("source", F.lit(1))
        )
        kept = ranked.filter(F.col("revenue").isNotNull()).orderBy("source").limit(1)
    return kept.select(
        "revenue",
        "orders",
        "customers",
        F.coalesce(at_risk, F.lit(0)).alias("at_risk_customers"),
        F.coalesce(predicted, F.lit(0.0)).alias("predicted_revenue"),
    )


# ---------------------------------------------------------- revenue over time


def daily_bars(daily: DataFrame) -> DataFrame:
    """Last days with weekday label and a flag on every best day."""
    # At most seven rows reach this window.
    peak = F.max("revenue").over(Window.partitionBy())
    return daily.orderBy("day").select(
        F.col("day").alias("date"),
        weekday_label(F.col("day")).alias("day"),
        F.col("revenue").cast("double").alias("revenue"),
        ((F.col("revenue") == peak) & (peak > 0)).alias("is_best_day"),
    )


def monthly_actuals(monthly: DataFrame, months: int | None = TRAILING_MONTHS) -> DataFrame:
    """The trailing months; None keeps all of them."""
    return trailing(monthly, "month", months).select(
        "month",
        month_label(F.col("month")).alias("month_label"),
        F.col("revenue").cast("double").alias("actual"),
        F.col("revenue").cast("double").alias("predicted"),
        "order_count",
        "customer_count",
    )


def of_series(forecasts: DataFrame, series: str) -> DataFrame:
    """The rows of one series, where a table holds several."""
    return forecasts.filter(F.col("series") == series) if "series" in forecasts.columns else forecasts


def forecast_by_month(forecasts: DataFrame, series: str = "total") -> DataFrame:
    return of_series(forecasts, series).groupBy(month_start(F.col("forecast_date")).alias("month")).agg(
        F.sum("predicted_revenue").cast("double").alias("predicted")
    )


def monthly_with_forecast(
    monthly: DataFrame, forecasts: DataFrame, months: int | None = TRAILING_MONTHS
) -> DataFrame:
    """Trailing months, or all, with the forecast where there is one, else the actual value."""
    actuals = monthly_actuals(monthly, months).drop("predicted")
    joined = actuals.join(forecast_by_month(forecasts), "month", "left")
    return joined.withColumn("predicted", F.coalesce("predicted", "actual"))


def trend_scaled_proxy(
    trend: DataFrame,
    categories: DataFrame,
    category: str = "All",
    region: str = "All Regions",
    range_name: str = "All Time",
) -> DataFrame:
    """The overall trend scaled by a category's revenue share and a region weight.

    Only an approximation of the filtered trend; see ``trend_filtered``.
    ``trend`` has all months and ``categories`` all categories with display
    names; a category that is not among them gives no rows.
    """
    shown = trailing(trend, "month", preset(range_name).months)
    scale = F.lit(rules.REGION_WEIGHTS.get(region, 1.0))
    if category != "All":
        chosen = F.sum(F.when(F.col("category") == category, F.col("revenue")))
        share = categories.agg(F.try_divide(chosen, F.sum("revenue")).alias("share")).scalar()
        scale = scale * share
        shown = shown.filter(share.isNotNull())
    return shown.withColumns({c: F.col(c) * scale for c in ("actual", "predicted")})


def trend_filtered(
    lines: DataFrame, category: str = "All", state: str = "All", range_name: str = "All Time"
) -> DataFrame:
    """Monthly item revenue of the lines that match a category and a customer state.

    Lines collapse to orders first, so one distinct count is left for the months.
    """
    chosen = lines.filter(
        equals_unless_all(title_case(F.col("category")), category)
        & equals_unless_all("customer_state", state)
        & F.col("purchase_date").isNotNull()
    )
    per_order = chosen.groupBy(
        "order_id", "customer_unique_id", month_start(F.col("purchase_date")).alias("month")
    ).agg(F.sum("item_revenue").alias("order_revenue"))
    monthly = per_order.groupBy("month").agg(
        F.sum("order_revenue").cast(MONEY_TOTAL).alias("revenue"),
        F.count("order_id").alias("order_count"),
        F.count_distinct("customer_unique_id").alias("customer_count"),
    )
    return trailing(monthly, "month", preset(range_name).months)


def historical_estimate(monthly: DataFrame, range_name: str = "All Time") -> DataFrame:
    """Mean monthly revenue of the range's months; NULL unless positive."""
    shown = trailing(monthly, "month", preset(range_name).months)
    totals = shown.agg(
        F.sum("revenue").cast("double").alias("total"), F.count("month").alias("months")
    )
    mean = F.try_divide("total", "months")
    return totals.select(F.when(mean > 0, mean).alias("estimate"))


# -------------------------------------------------------------------- orders


def recent_order_rows(
    orders: DataFrame, search: str = "", window: Column | None = None, limit: int | None = 6
) -> DataFrame:
    """Orders for display, by date window and search text, newest first.

    Window and search see all rows given; only then the latest ``limit`` are
    taken.  A search, like no limit, returns every match.
    """
    state = F.coalesce(F.concat(F.lit(" · "), F.col("customer_state")), F.lit(""))
    person = F.concat(labelled_id("Customer", F.col("customer_unique_id"), 8), state)
    kept = orders if window is None else orders.filter(window)
    rows = kept.select(
        short_id(F.col("order_id"), 8).alias("id"),
        F.col("order_id").alias("raw_id"),
        F.when(F.col("customer_unique_id").isNull(), "Anonymous").otherwise(person).alias("customer"),
        rules.status_label(F.col("order_status")).alias("status"),
        F.col("order_purchase_timestamp").alias("date"),
        F.col("order_total").cast("double").alias("amount"),
    )
    if search.strip():
        return rows.filter(contains_any(["id", "customer", "status"], search))
    return rows.orderBy(F.col("date").desc(), "raw_id").limit(limit) if limit else rows


def activity_heatmap(orders: DataFrame, newest: int | None = None) -> DataFrame:
    """Orders by hour and weekday, relative to the busiest cell: all, or so many of the newest.

    Only status ``canceled`` is left out here, and so is an unknown status.
    """
    kept = orders.filter(F.col("order_status") != "canceled")
    bought = F.col("order_purchase_timestamp")
    if newest is not None:
        kept = kept.orderBy(bought.desc(), "order_id").limit(newest)
    counts = kept.groupBy(
        F.hour(bought).alias("hour"), F.weekday(bought).alias("weekday")
    ).agg(F.count("*").alias("orders"))
    grid = (
        orders.sparkSession.range(24 * 7)
        .select((F.col("id") / 7).cast("int").alias("hour"), (F.col("id") % 7).cast("int").alias("weekday"))
    )
    cells = grid.join(counts, ["hour", "weekday"], "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0))
    )
    # 168 cells reach this window.
    busiest = F.greatest(F.max("orders").over(Window.partitionBy()), F.lit(1))
    names = F.array(*[F.lit(day) for day in WEEKDAYS])
    return cells.select(
        "hour",
        F.get(names, F.col("weekday")).alias("day"),
        "orders",
        (F.col("orders") / busiest).alias("value"),
    )


# --------------------------------------------------- channels and categories


def channel_rows(channels: DataFrame, channel: str = "All Channels") -> DataFrame:
    rows = channels.orderBy(F.col("revenue").desc(), "channel").select(
        rules.channel_label(F.col("channel")).alias("channel"),
        F.col("revenue").cast("double").alias("value"),
        F.col("pct_of_total").alias("change"),
        "order_count",
    )
    return rows.filter(equals_unless_all("channel", channel, everything="All Channels"))


def channel_count(channels: DataFrame) -> DataFrame:
    return channels.agg(F.count_distinct("channel").alias("channels"))


def category_rows(
    categories: DataFrame, limit: int | None = 12, category: str = "All", search: str = ""
) -> DataFrame:
    """Best categories that match, with score-based margin stand-in, band and intensity.

    Choice and search come first, then the top ``limit``; intensity is relative
    to the best of all categories.
    """
    score = F.col("avg_review_score")
    revenue = F.col("revenue").cast("double")
    # One row for each category reaches this window.
    highest = F.greatest(F.max(revenue).over(Window.partitionBy()), F.lit(1.0))
    rows = categories.select(
        title_case(F.col("category")).alias("category"),
        F.col("category").alias("raw"),
        revenue.alias("revenue"),
        rules.margin_proxy(score).alias("margin_proxy"),
        "order_count",
        "units_sold",
        score.cast("double").alias("review_score"),
        rules.quality_band(score).alias("quality_band"),
        (revenue / highest).alias("intensity"),
    )
    kept = rows.filter(
        equals_unless_all("category", category) & contains_any(["category"], search)
    )
    top = kept if limit is None else kept.orderBy(F.col("revenue").desc(), "raw").limit(limit)
    return top.drop("raw")


def spending_top(categories: DataFrame, limit: int = 6) -> DataFrame:
    top = categories.orderBy(F.col("revenue").desc(), "category").limit(limit)
    return top.select(
        title_case(F.col("category")).alias("category"),
        F.col("revenue").cast("double").alias("value"),
    )


# ----------------------------------------------------------------- customers


def segment_rows(distribution: DataFrame) -> DataFrame:
    return distribution.select(
        F.col("segment_label").alias("name"),
        rules.half_up(F.col("pct")).alias("value"),
        F.col("customer_count").alias("customers"),
    )


def segment_total(distribution: DataFrame) -> DataFrame:
    return distribution.agg(F.sum("customer_count").alias("customers"))


def customer_rows(
    clusters: DataFrame,
    limit: int = 8,
    segment: str = "All",
    engagement: str = "All",
    search: str = "",
) -> DataFrame:
    """The best customers by value among those that match all filters."""
    person = F.col("customer_unique_id")
    rows = clusters.select(
        "monetary",
        short_id(person, 16).alias("id"),
        person.alias("raw_id"),
        labelled_id("Customer", person, 6).alias("name"),
        F.coalesce("segment_label", F.lit("Loyal")).alias("segment"),
        F.round(F.col("monetary"), 0).cast("bigint").alias("ltv"),
        rules.engagement(F.col("frequency")).alias("engagement"),
        rules.churn_proxy(F.col("recency_days")).alias("churn_proxy"),
    )
    return (
        rows.filter(
            equals_unless_all("segment", segment)
            & equals_unless_all("engagement", engagement)
            & contains_any(["name", "id", "segment"], search)
        )
        .orderBy(F.col("monetary").desc(), "raw_id")
        .limit(limit)
        .drop("monetary")
    )


def cluster_scatter(clusters: DataFrame, limit: int = 500, by_hash: bool = False) -> DataFrame:
    """Rows for a scatter plot: longest idle first, or an even pick by hashed id.

    Rows without label or value take no part.
    """
    person = F.col("customer_unique_id")
    rank = F.md5(person.cast("string")) if by_hash else F.col("recency_days").desc()
    shown = clusters.filter(F.col("segment_label").isNotNull() & F.col("monetary").isNotNull())
    return shown.orderBy(rank, person).limit(limit).select(
        F.col("segment_label").alias("cluster"),
        F.col("frequency"),
        F.col("monetary").cast("double").alias("monetary"),
    )


# ------------------------------------------------------------------ products


def _product_name() -> Column:
    category = title_case(F.coalesce("category", F.lit("Product")))
    return F.concat_ws(" · ", category, short_id(F.col("product_id"), 4))


def top_product_rows(products: DataFrame, limit: int = 4, search: str = "") -> DataFrame:
    """Best-selling products that match the search, with their labels and their rank."""
    score = F.col("avg_review_score")
    trend = rules.trend_proxy(score)
    # The limit comes first, so the ranking window holds at most ``limit`` rows.
    by_revenue = Window.orderBy(F.col("total_revenue").desc(), "product_id")
    named = products.withColumns(
        {"shown_id": short_id(F.col("product_id"), 8), "shown_name": _product_name()}
    ).filter(contains_any(["shown_name", "shown_id"], search))
    return best_sellers(named).limit(limit).select(
        F.col("shown_id").alias("id"),
        F.col("product_id").alias("raw_id"),
        F.col("shown_name").alias("name"),
        title_case(F.coalesce("category", F.lit("Other"))).alias("category"),
        F.col("total_revenue").cast("double").alias("revenue"),
        trend.alias("trend_proxy"),
        rules.performance_band(trend).alias("performance"),
        rules.sentiment(score).alias("sentiment"),
        rules.product_tag(F.col("inventory_status"), score).alias("tag"),
        "units_sold",
        "review_count",
        "inventory_status",
        score.cast("double").alias("review_score"),
        F.row_number().over(by_revenue).alias("rank"),
    )


def _idle_days(as_of: Column) -> Column:
    return F.datediff(as_of, F.col("last_sold_at"))


def inventory_alerts(products: DataFrame, as_of: Column, limit: int | None = 5) -> DataFrame:
    """Slow and dead stock, best sellers first; idle days count to the data's last day."""
    # The texts of both kinds of alert.
    gone = F.col("inventory_status") == "out_of_stock"
    idle = _idle_days(as_of)
    days = F.coalesce(idle.cast("string"), F.lit("many"))
    dead = F.format_string(
        "No sale for %s days. %d historical units sold — consider sunset or relaunch.",
        days,
        F.col("units_sold"),
    )
    slow = F.format_string(
        "Slow movement detected. %d historical units sold.", F.col("units_sold")
    )
    alerts = products.filter(F.col("inventory_status") != "healthy")
    if limit is not None:
        alerts = best_sellers(alerts).limit(limit)
    return alerts.select(
        _product_name().alias("product"),
        "product_id",
        F.when(gone, "LOW_STOCK").otherwise("OVERSTOCK").alias("type"),
        F.when(gone, "high").otherwise("medium").alias("severity"),
        F.when(gone, dead).otherwise(slow).alias("detail"),
        F.coalesce(F.concat(idle.cast("string"), F.lit("d idle")), F.lit("—")).alias("eta"),
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count_if(F.col("severity") == "high").alias("high"),
        F.count_if(F.col("severity") == "medium").alias("medium"),
    )


# ----------------------------------------------------------- recommendations


def pick_customer(recommendations: DataFrame, seed: int = 42) -> Column:
    """A customer with recommendations, chosen evenly and repeatably by hashed id."""
    person = F.col("customer_unique_id")
    key = F.struct(F.md5(F.concat_ws("|", person.cast("string"), F.lit(seed))), person)
    return recommendations.agg(F.min_by(person, key).alias("customer")).scalar()


def customer_recommendations(
    recommendations: DataFrame,
    customer: Column | None = None,
    limit: int = 4,
    search: str = "",
) -> DataFrame:
    """The best recommendations for one customer among those that match the search."""
    chosen = pick_customer(recommendations) if customer is None else customer
    category = title_case(F.coalesce("category", F.lit("Product")))
    rank = F.coalesce("rank", F.lit(1))
    theirs = recommendations.filter(F.col("customer_unique_id") == chosen)
    rows = theirs.select(
        F.concat_ws(" · ", category, short_id(F.col("product_id"), 4)).alias("id"),
        "product_id",
        rules.price_proxy(F.col("total_revenue"), rank).alias("price_proxy"),
        rules.match_proxy(rank).alias("match_proxy"),
        "score",
        rank.alias("rank"),
        category.alias("category"),
        F.col("avg_review_score").cast("double").alias("review_score"),
    )
    kept = rows.filter(contains_any(["id", "category"], search))
    return kept.orderBy("rank", "product_id").limit(limit)


def recommendation_tabs(recommendations: DataFrame, limit: int = 3) -> DataFrame:
    """The categories recommended most often, over all recommendations."""
    category = F.coalesce("category", F.lit("Other"))
    return (
        recommendations.groupBy(category.alias("category"))
        .agg(F.count("*").alias("recommended"))
        .orderBy(F.col("recommended").desc(), "category")
        .limit(limit)
        .select(title_case(F.col("category")).alias("category"), "recommended")
    )


# -------------------------------------------------------------------- models


def model_cards(latest_runs: DataFrame, limit: int = 4, search: str = "") -> DataFrame:
    """The first metric cards that match the search, in a fixed order of importance."""
    key = F.concat_ws("__", "model_name", "metric_name")
    known = F.array(*[F.lit(name) for name in rules.METRIC_TITLES])
    position = F.array_position(known, key)
    priority = F.when(position > 0, position - 1).otherwise(99)
    title = F.coalesce(
        rules.lookup(rules.METRIC_TITLES, key),
        title_case(F.concat_ws(" ", "model_name", "metric_name")),
    )
    cards = latest_runs.select(
        title.alias("name"),
        rules.metric_percent(F.col("metric_name"), F.col("metric_value")).alias("value"),
        F.col("metric_value").alias("raw"),
        F.lit(0.0).alias("change"),
        F.col("model_name").alias("model"),
        F.col("metric_name").alias("metric"),
        F.col("trained_at"),
        priority.alias("priority"),
    )
    kept = cards.filter(contains_any(["model", "metric", "name"], search))
    top = kept.orderBy("priority", F.col("trained_at").desc(), "model", "metric").limit(limit)
    return top.drop("priority")


def model_count(latest_runs: DataFrame) -> DataFrame:
    return latest_runs.agg(F.count_distinct("model_name").alias("models"))


def forecast_summary(forecasts: DataFrame, series: str = "total") -> DataFrame:
    """Totals of one series' forecast; a missing bound counts as the point estimate."""
    value = F.coalesce(F.col("predicted_revenue"), F.lit(0))
    return of_series(forecasts, series).agg(
        F.sum(value).cast("double").alias("predicted_total"),
        F.sum(F.coalesce(F.col("lower_bound"), value)).cast("double").alias("lower"),
        F.sum(F.coalesce(F.col("upper_bound"), value)).cast("double").alias("upper"),
        F.min_by("model_name", "forecast_date").alias("model"),
        F.count("*").alias("n"),
    )
