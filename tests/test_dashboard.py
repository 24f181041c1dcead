from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import as_dicts, by_key
from tallyloom.plans import dashboard, views


@pytest.fixture(scope="module")
def monthly(spark):
    rows = [(dt.date(2017, m, 1), float(m * 10), m, 20 - m) for m in range(1, 13)]
    rows += [(dt.date(2018, m, 1), float(m * 100), m, m) for m in range(1, 4)]
    return spark.createDataFrame(
        rows, "month date, revenue double, order_count bigint, customer_count bigint"
    )


def test_trailing_months(monthly):
    months = sorted(r.month for r in dashboard.monthly_actuals(monthly).collect())
    assert months[0] == dt.date(2017, 4, 1) and len(months) == 12


def test_period_totals(monthly):
    (row,) = as_dicts(dashboard.period_totals(monthly, "Last 3 Months"))
    assert row == {"revenue": 600.0, "orders": 6, "customers": 3, "aov": 100.0, "change": 0.0}
    (row,) = as_dicts(dashboard.period_totals(monthly, "All Time"))
    assert row["orders"] == 84 and row["customers"] == 19
    (empty,) = as_dicts(dashboard.period_totals(monthly.limit(0), "All Time"))
    assert empty["aov"] == 0.0


@pytest.fixture(scope="module")
def summary(spark):
    return spark.createDataFrame(
        [(7.0, 2, 5, 3.5, 0.5, None, 0.0, -0.1)],
        "total_revenue double, total_orders bigint, active_customers bigint, avg_order_value double, "
        "revenue_delta double, orders_delta double, active_customers_delta double, aov_delta double",
    )


def test_cards_of_a_period_and_their_fallback(monthly, summary):
    cards = by_key(dashboard.period_cards(monthly, summary, "Last 3 Months"), "key")
    assert {k: (c["value"], c["change"]) for k, c in cards.items()} == {
        "revenue": (600.0, 0.0),
        "orders": (6.0, 0.0),
        "aov": (100.0, 0.0),
        "active": (3.0, 0.0),
    }
    base = by_key(dashboard.kpi_cards(summary), "key")
    assert base["revenue"]["change"] == 50.0 and base["orders"]["change"] == 0.0
    assert by_key(dashboard.period_cards(monthly, summary, "All Time"), "key") == base
    assert by_key(dashboard.period_cards(monthly.limit(0), summary, "Last 3 Months"), "key") == base


def test_workbench(spark, monthly, summary):
    trend = dashboard.monthly_actuals(monthly)
    segments = spark.createDataFrame(
        [("At Risk", 4), ("VIP", 9)], "segment_label string, customer_count bigint"
    )
    expected = {
        "revenue": 500.0,
        "orders": 5,
        "customers": 3,
        "at_risk_customers": 4,
        "predicted_revenue": 500.0,
    }
    assert as_dicts(dashboard.workbench_kpis(trend, segments, summary, "Last 30 Days")) == [expected]
    of_summary = {"revenue": 7.0, "orders": 2, "customers": 5}
    (row,) = as_dicts(dashboard.workbench_kpis(trend, segments.limit(0), summary, "All Time"))
    assert row == {**of_summary, "at_risk_customers": 0, "predicted_revenue": 600.0}
    empty = trend.limit(0)
    (row,) = as_dicts(dashboard.workbench_kpis(empty, segments, summary, "Last 30 Days"))
    assert row == {**of_summary, "at_risk_customers": 4, "predicted_revenue": 0.0}


def test_series_come_in_order(monthly):
    months = [r.month for r in dashboard.monthly_actuals(monthly).collect()]
    assert months == sorted(months)


def test_forecast_replaces_only_its_months(spark, monthly):
    forecasts = spark.createDataFrame(
        [(dt.date(2018, 3, 5), 1.0), (dt.date(2018, 3, 6), 2.0), (dt.date(2018, 4, 1), 9.0)],
        "forecast_date date, predicted_revenue double",
    )
    rows = by_key(dashboard.monthly_with_forecast(monthly, forecasts), "month")
    assert rows[dt.date(2018, 3, 1)]["predicted"] == 3.0
    assert rows[dt.date(2018, 2, 1)]["predicted"] == rows[dt.date(2018, 2, 1)]["actual"] == 200.0
    assert dt.date(2018, 4, 1) not in rows
    without = by_key(dashboard.monthly_with_forecast(monthly, forecasts.limit(0)), "month")
    assert all(row["predicted"] == row["actual"] for row in without.values())


def test_scaled_trend(spark, monthly):
    trend = dashboard.monthly_actuals(monthly)
    categories = spark.createDataFrame([("Toys", 25.0), ("Bed", 75.0)], "category string, revenue double")
    scaled = dashboard.trend_scaled_proxy(
        trend, categories, "Toys", "Brazil — Southeast", "Last 7 Days"
    )
    (row,) = as_dicts(scaled)
    assert row["actual"] == pytest.approx(300 * 0.25 * 0.65)
    assert not as_dicts(dashboard.trend_scaled_proxy(trend, categories, "Cars"))
    whole = dashboard.trend_scaled_proxy(dashboard.monthly_actuals(monthly, None), categories)
    assert whole.count() == monthly.count()


def test_historical_estimate(monthly):
    assert dashboard.historical_estimate(monthly, "Last 3 Months").first()[0] == 200.0
    assert dashboard.historical_estimate(monthly.limit(0)).first()[0] is None


def test_daily_bars_flag_every_best_day(spark):
    rows = [(dt.date(2018, 1, 1), 5.0), (dt.date(2018, 1, 2), 5.0), (dt.date(2018, 1, 3), 1.0)]
    bars = by_key(dashboard.daily_bars(spark.createDataFrame(rows, "day date, revenue double")), "date")
    assert [bars[d]["is_best_day"] for d, _ in rows] == [True, True, False]
    assert bars[rows[0][0]]["day"] == "Mon"
    none = spark.createDataFrame([(dt.date(2018, 1, 1), 0.0)], "day date, revenue double")
    assert dashboard.daily_bars(none).first()["is_best_day"] is False


def test_heatmap_grid_is_complete(spark):
    rows = [
        ("a", "delivered", dt.datetime(2018, 1, 1, 5)),
        ("b", "unavailable", dt.datetime(2018, 1, 1, 5)),
        ("c", "canceled", dt.datetime(2018, 1, 2, 5)),
        ("d", None, dt.datetime(2018, 1, 2, 5)),
        ("e", "shipped", dt.datetime(2018, 1, 7, 23)),
    ]
    orders = spark.createDataFrame(
        rows, "order_id string, order_status string, order_purchase_timestamp timestamp"
    )
    cells = {(r.hour, r.day): r for r in dashboard.activity_heatmap(orders).collect()}
    assert len(cells) == 168
    assert cells[5, "Mon"].value == 1.0 and cells[23, "Sun"].value == 0.5
    assert cells[5, "Tue"].orders == 0
    assert sum(r.orders for r in cells.values()) == 3
    empty = dashboard.activity_heatmap(orders.limit(0)).collect()
    assert len(empty) == 168 and {r.value for r in empty} == {0.0}


def test_recent_orders_with_and_without_search(tables):
    recent = views.recent_orders(tables.orders, tables.customers, tables.order_payments, limit=4)
    rows = as_dicts(dashboard.recent_order_rows(recent, limit=2))
    assert [r["raw_id"] for r in sorted(rows, key=lambda r: r["date"], reverse=True)] == ["o5", "o7"]
    found = as_dicts(dashboard.recent_order_rows(recent, search="cancel", limit=1))
    assert [r["raw_id"] for r in found] == ["o4"]
    assert found[0]["customer"] == "Customer CLEO · RJ" and found[0]["amount"] == 0.0
    window = F.to_date("order_purchase_timestamp") == F.lit("2018-01-30").cast("date")
    assert [r["raw_id"] for r in as_dicts(dashboard.recent_order_rows(recent, window=window))] == ["o3"]


def test_unknown_customer_is_anonymous(tables):
    recent = views.recent_orders(
        tables.orders, tables.customers.limit(0), tables.order_payments
    )
    assert {r["customer"] for r in as_dicts(dashboard.recent_order_rows(recent))} == {"Anonymous"}


def test_customer_rows_filter_before_the_limit(spark):
    rows = [(f"person{i:02d}", 10 - i, float(i), i * 40, "VIP" if i % 2 else None) for i in range(8)]
    clusters = spark.createDataFrame(
        rows, "customer_unique_id string, frequency int, monetary double, recency_days int, segment_label string"
    )
    shown = as_dicts(dashboard.customer_rows(clusters, limit=3))
    assert [r["raw_id"] for r in shown] == ["person07", "person06", "person05"]
    assert [r["segment"] for r in shown] == ["VIP", "Loyal", "VIP"]
    assert [r["engagement"] for r in shown] == ["High", "High", "High"]
    loyal = as_dicts(dashboard.customer_rows(clusters, limit=3, segment="Loyal"))
    assert [r["raw_id"] for r in loyal] == ["person06", "person04", "person02"]
    (found,) = as_dicts(dashboard.customer_rows(clusters, limit=3, search="PERSON00"))
    assert found["raw_id"] == "person00"


def test_tabs_and_picks(spark):
    rows = [
        ("a", "p1", 1, 0.9, "bed_bath", 4.5, 1000.0),
        ("a", "p2", 2, 0.8, "toys", None, None),
        ("b", "p1", 1, 0.7, "bed_bath", 4.5, 1000.0),
        ("b", "p3", 2, 0.6, None, 3.0, 10.0),
    ]
    shown = spark.createDataFrame(
        rows,
        "customer_unique_id string, product_id string, rank int, score double, category string, "
        "avg_review_score double, total_revenue double",
    )
    tabs = as_dicts(dashboard.recommendation_tabs(shown, limit=2))
    assert {"category": "Bed Bath", "recommended": 2} in tabs
    picks = as_dicts(dashboard.customer_recommendations(shown, F.lit("b")))
    assert {(p["product_id"], p["category"], p["price_proxy"]) for p in picks} == {
        ("p1", "Bed Bath", 1000),
        ("p3", "Product", 29),
    }
    assert as_dicts(dashboard.customer_recommendations(shown, F.lit("b"), search="bed"))
    chosen = {r["product_id"] for r in as_dicts(dashboard.customer_recommendations(shown))}
    assert chosen in ({"p1", "p2"}, {"p1", "p3"})


def test_model_cards_order_and_latest(spark):
    first, second = dt.datetime(2018, 1, 1), dt.datetime(2018, 1, 2)
    rows = [
        ("kmeans", "silhouette", 0.1, "{}", first),
        ("kmeans", "silhouette", 0.3, "{}", second),
        ("als", "rmse", 2.0, "{}", first),
        ("als", "precision_at_k", 0.5, "{}", first),
        ("sales_forecast", "r2", 0.8, "{}", first),
        ("sales_forecast", "rmse", 90.0, "{}", first),
        ("my_model", "auc", 7.0, "{}", second),
    ]
    runs = spark.createDataFrame(
        rows, "model_name string, metric_name string, metric_value double, params string, trained_at timestamp"
    )
    newest = views.model_latest(runs)
    assert newest.count() == 6
    cards = by_key(dashboard.model_cards(newest), "name")
    assert set(cards) == {"K-Means Silhouette", "ALS Precision@K", "ALS RMSE", "Forecast R²"}
    assert cards["K-Means Silhouette"]["raw"] == 0.3
    everything = by_key(dashboard.model_cards(newest, limit=10), "name")
    assert everything["My Model Auc"]["value"] == 7
    assert dashboard.model_count(newest).first()[0] == 4


def test_forecast_summary_uses_the_point_for_missing_bounds(spark):
    rows = [
        (dt.date(2018, 1, 2), 10.0, None, None, "b"),
        (dt.date(2018, 1, 1), 5.0, 1.0, 9.0, "a"),
    ]
    forecasts = spark.createDataFrame(
        rows, "forecast_date date, predicted_revenue double, lower_bound double, upper_bound double, model_name string"
    )
    assert as_dicts(dashboard.forecast_summary(forecasts)) == [
        {"predicted_total": 15.0, "lower": 11.0, "upper": 19.0, "model": "a", "n": 2}
    ]
    (empty,) = as_dicts(dashboard.forecast_summary(forecasts.limit(0)))
    assert empty["n"] == 0 and empty["predicted_total"] is None


def test_top_recommendations_show_the_latest_run(spark, tables):
    old, new = dt.datetime(2018, 1, 1), dt.datetime(2018, 1, 2)
    recs = spark.createDataFrame(
        [("a", "p1", 1, 0.5, old), ("a", "p2", 1, 0.6, new), ("a", "p9", 2, 0.1, new)],
        "customer_unique_id string, product_id string, rank int, score double, generated_at timestamp",
    )
    metrics = spark.createDataFrame(
        [("p1", 4.0, 1.0)], "product_id string, avg_review_score double, total_revenue double"
    )
    shown = as_dicts(views.top_recommendations(recs, tables.products, tables.categories, metrics))
    assert [(r["product_id"], r["category"], r["total_revenue"]) for r in shown] == [
        ("p2", "toys", None)
    ]


def test_search_sees_rows_behind_the_limit(spark):
    rows = [(f"c{k}", float(100 - k), 4, 4, 4.0) for k in range(20)] + [("toys", 1.0, 1, 1, 4.0)]
    categories = spark.createDataFrame(
        rows, "category string, revenue double, order_count int, units_sold int, avg_review_score double"
    )
    (found,) = as_dicts(dashboard.category_rows(categories, search="toy"))
    assert found["category"] == "Toys" and found["intensity"] == 0.01
    assert dashboard.category_rows(categories).count() == 12


def test_scatter_leaves_out_rows_before_the_limit(spark):
    rows = [(f"p{k}", k, 1, None if k % 2 else 5.0, "VIP") for k in range(20)]
    clusters = spark.createDataFrame(
        rows, "customer_unique_id string, recency_days int, frequency int, monetary double, segment_label string"
    )
    assert dashboard.cluster_scatter(clusters, limit=8).count() == 8


def test_unknown_range_is_an_error(monthly):
    with pytest.raises(ValueError, match="unknown range"):
        dashboard.period_totals(monthly, "Last Decade")
