from __future__ import annotations

import datetime as dt

import pytest

from conftest import by_key, raw_frame
from tallyloom.operators.clean import CLEANERS, complete_categories
from tallyloom.operators.dedup import keep_first


def test_text_is_normalised(tables):
    customers = by_key(tables.customers, "customer_id")
    assert set(customers) == {"c1", "c2", "c3", "c4", "c5"}
    assert customers["c1"]["customer_city"] == "sao paulo"
    assert customers["c2"]["customer_state"] == "SP"
    sellers = by_key(tables.sellers, "seller_id")
    assert sellers["s1"]["seller_city"] == "campinas"
    assert sellers["s1"]["seller_state"] == "SP"
    orders = by_key(tables.orders, "order_id")
    assert orders["o1"]["order_status"] == "delivered"
    assert orders["o5"]["order_status"] is None


def test_unparsable_purchase_time_drops_the_order_without_error(tables):
    orders = by_key(tables.orders, "order_id")
    assert "o6" not in orders and None not in orders
    assert orders["o2"]["order_purchase_timestamp"] == dt.datetime(2018, 1, 1, 23, 30)


def test_unparsable_other_dates_become_null(tables):
    items = {(r.order_id, r.order_item_id): r for r in tables.order_items.collect()}
    assert items["o2", 1].shipping_limit_date is None
    assert items["o1", 1].shipping_limit_date == dt.datetime(2018, 1, 5)


def test_range_filters(tables):
    assert {r.review_id for r in tables.order_reviews.collect()} == {"r1", "r2", "r5"}
    assert ("o7", 2) not in {(r.order_id, r.order_item_id) for r in tables.order_items.collect()}
    assert "o3" not in {r.order_id for r in tables.order_payments.collect()}


def test_duplicate_keys_keep_the_smallest_row(tables):
    kept = [r for r in tables.order_items.collect() if (r.order_id, r.order_item_id) == ("o1", 2)]
    assert [r.product_id for r in kept] == ["p1"]


def test_dedup_precedes_the_purchase_time_filter(spark):
    raw = raw_frame(
        spark,
        "orders",
        [
            ("o", "a", "delivered", None, None, None, None, None),
            ("o", "a", "delivered", "2018-01-01 00:00:00", None, None, None, None),
        ],
    )
    # The row without a time sorts first, wins, and is then dropped.
    assert CLEANERS["orders"](raw).count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_dedup_does_not_depend_on_layout(spark, partitions):
    rows = [(k % 5, v, str(v % 3)) for k in range(40) for v in range(k % 4 + 1)]
    df = spark.createDataFrame(rows, "k int, v int, t string").repartition(partitions)
    expected = {}
    for row in rows:
        expected[row[0]] = min(expected.get(row[0], row[1:]), row[1:])
    assert {r.k: (r.v, r.t) for r in keep_first(df, ["k"]).collect()} == expected


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle


def test_missing_categories_are_completed(spark, tables):
    categories = by_key(tables.categories, "product_category_name")
    assert categories["pc_gamer"]["product_category_name_english"] == "pc gamer"
    assert categories["toys"]["product_category_name_english"] == "toys"
    assert set(categories) == {"bed_bath", "toys", "pc_gamer"}
    again = complete_categories(tables.categories, tables.products)
    assert again.count() == 3
