from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import dates, rules, text


def evaluate(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [row[0] for row in df.select(expression(F.col("x"))).collect()]


def test_title_case_keeps_the_tail(spark):
    shown = evaluate(
        spark, text.title_case, ["bED_bath x", "a__b", "_a", "already Done", "", None, "é_ü"]
    )
    assert shown == ["BED Bath X", "A B", "A", "Already Done", "—", "—", "É Ü"]


def test_half_up_goes_towards_positive_infinity(spark):
    assert evaluate(spark, rules.half_up, [2.5, -2.5, -2.6, 0.49], "double") == [3, -2, -3, 0]


def test_status_and_channel_labels(spark):
    statuses = ["delivered", "SHIPPED", "created", "canceled", "unavailable", "odd", None]
    assert evaluate(spark, rules.status_label, statuses) == [
        "Delivered",
        "Delivered",
        "Processing",
        "Cancelled",
        "Cancelled",
        "Processing",
        "Processing",
    ]
    channels = ["credit_card", "Debit_Card", "gift_voucher", None]
    assert evaluate(spark, rules.channel_label, channels) == [
        "Credit Card",
        "Debit Card",
        "Gift Voucher",
        "Other",
    ]


def test_canceled_is_three_valued(spark):
    flags = evaluate(spark, rules.is_canceled, ["canceled", "unavailable", "shipped", None])
    assert flags == [True, True, False, None]


def test_bands(spark):
    scores = [4.5, 4.0, 3.5, 3.4, None]
    assert evaluate(spark, rules.sentiment, scores, "double") == [
        "Strong Buy",
        "Buy",
        "Resilient",
        "Watch",
        "Resilient",
    ]
    assert evaluate(spark, rules.quality_band, [4.3, 3.7, 3.6, None], "double") == [
        "high",
        "medium",
        "low",
        "unrated",
    ]
    assert evaluate(spark, rules.performance_band, [5.1, 5.0, 0.0], "double") == [
        "Strong",
        "Solid",
        "Watch",
    ]
    assert evaluate(spark, rules.engagement, [4, 3, 2, 1], "int") == [
        "High",
        "High",
        "Medium",
        "Low",
    ]


def test_product_tag(spark):
    df = spark.createDataFrame(
        [("out_of_stock", 5.0), ("low", 5.0), ("healthy", 4.5), ("healthy", None)],
        "status string, score double",
    )
    tags = [r[0] for r in df.select(rules.product_tag(F.col("status"), F.col("score"))).collect()]
    assert tags == ["DECLINING", "GROWING", "TRENDING", "STABLE"]


def test_proxies(spark):
    assert evaluate(spark, rules.churn_proxy, [0, 100, 365, 9000], "int") == [0, 26, 95, 95]
    assert evaluate(spark, rules.trend_proxy, [5.0, 2.5, 3.19, None], "double") == [
        8.0,
        -2.0,
        0.8,
        0.0,
    ]
    assert evaluate(spark, rules.margin_proxy, [5.0, 4.17, None], "double") == [60, 50, 0]
    assert evaluate(spark, rules.match_proxy, [1, 2, 10, 40], "int") == [98, 95, 75, 75]
    df = spark.createDataFrame(
        [(10.0, 1), (5000.0, 1), (600.0, 2), (None, 1), (100.0, 0)], "revenue double, rank int"
    )
    shown = [r[0] for r in df.select(rules.price_proxy(F.col("revenue"), F.col("rank"))).collect()]
    assert shown == [29, 2500, 300, 99, 100]


@pytest.mark.parametrize(
    ("metric", "value", "shown"),
    [
        ("silhouette", 0.3, 65),
        ("silhouette", -1.5, 0),
        ("precision_at_k", 0.744, 74),
        ("r2", -3.0, 0),
        ("rmse", 1180.0, 100),
        ("rmse", 0.6, 1),
        ("other", float("nan"), 0),
    ],
)
def test_metric_percent(spark, metric, value, shown):
    df = spark.createDataFrame([(metric, value)], "m string, v double")
    assert df.select(rules.metric_percent(F.col("m"), F.col("v"))).first()[0] == shown


def test_search_and_choice_filters(spark):
    df = spark.createDataFrame([("Anna", "x"), ("bert", None), (None, "ANNEX")], "a string, b string")
    assert df.filter(text.contains_any(["a", "b"], "ann")).count() == 2
    assert df.filter(text.contains_any(["a", "b"], "  ")).count() == 3
    assert df.filter(text.equals_unless_all("a", "bert")).count() == 1
    assert df.filter(text.equals_unless_all("a", "All")).count() == 3


def test_presets_count_back_from_the_anchor(spark):
    days = [dt.date(2018, 10, 17) - dt.timedelta(days=n) for n in range(400)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    kept = {
        name: df.filter(
            dates.within_preset(F.col("d"), name, dates.latest(df, "d"))
        ).count()
        for name in dates.RANGE_PRESETS
    }
    assert kept == {
        "Last 7 Days": 8,
        "Last 30 Days": 31,
        "Last 3 Months": 91,
        "Last 6 Months": 181,
        "Last 12 Months": 366,
        "All Time": 400,
    }
    between = df.filter(dates.within_dates(F.col("d"), "2018-10-01", "2018-10-02"))
    assert between.count() == 2


def test_timestamps_must_fit_the_format(spark):
    df = spark.createDataFrame(
        [("2018-01-02 03:04:05",), ("2018-01-02",), ("n/a",), (None,)], "x string"
    )
    parsed = [r[0] for r in df.select(dates.parsed_timestamp("x")).collect()]
    assert parsed == [dt.datetime(2018, 1, 2, 3, 4, 5), None, None, None]
