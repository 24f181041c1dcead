from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from conftest import as_dicts, by_key
from tallyloom.operators import facts, kpi, metrics, rfm


@pytest.fixture(scope="module")
def master(tables):
    return facts.master_facts(tables).cache()


def line(master, order, item=1):
    (row,) = [r for r in master.collect() if (r.order_id, r.order_item_id) == (order, item)]
    return row


def test_columns_and_grain(master):
    assert tuple(master.columns) == facts.MASTER_COLUMNS
    assert master.count() == 9
    assert master.select("order_id", "order_item_id").distinct().count() == 9


def test_missing_header_stays_in_facts_and_keeps_its_payment(master):
    lost = line(master, "lost")
    assert lost.is_canceled is None and lost.purchase_date is None
    assert lost.order_total_paid == Decimal("80.00")
    assert lost.seller_city is None
    assert line(master, "o6").is_canceled is None
    assert line(master, "o5").is_canceled is None
    assert line(master, "o4").is_canceled is True


def test_tied_payments_take_the_lowest_sequence(tables):
    paid = by_key(facts.payments_per_order(tables.order_payments), "order_id")
    assert paid["o1"]["payment_type_dominant"] == "credit_card"
    assert paid["o1"]["order_total_paid"] == Decimal("23.00")
    assert paid["o1"]["payment_installments_max"] == 3


def test_category_label_falls_back(master):
    assert line(master, "o1").category == "bed_bath x"
    assert line(master, "o3").category == "pc gamer"
    assert line(master, "o4").category == "unknown"


def test_product_on_two_lines_counts_its_order_once_and_its_reviews_twice(master):
    products = by_key(metrics.product_metrics(facts.sold_lines(master)), "product_id")
    twice = products["p1"]
    assert twice["units_sold"] == 2 and twice["total_orders"] == 1
    assert twice["review_count"] == 4
    assert twice["avg_review_score"] == Decimal("4.50")
    assert twice["total_revenue"] == Decimal("23.00")
    assert products["p2"]["avg_review_score"] is None and products["p2"]["review_count"] == 0
    # Only the line of o7 counts: o4 is canceled, o5 and o6 have no usable header.
    assert products["p3"]["total_revenue"] == Decimal("70.00")


def test_lean_lines_give_the_same_metrics_as_the_fact_table(tables, master):
    sold = facts.sold_lines(master)
    for measure, dims in (
        (metrics.product_metrics, {}),
        (metrics.category_metrics, {"products": True}),
    ):
        lean = facts.sales_lines(tables, reviews=True, **dims)
        assert sorted(map(str, as_dicts(measure(lean)))) == sorted(
            map(str, as_dicts(measure(sold)))
        )


def test_order_facts_from_tables_and_from_lines_agree(tables, master):
    columns = ["order_id", "customer_unique_id", "purchase_date", "order_revenue", "order_total_paid"]
    lean = facts.order_facts(tables, payments=True).select(columns)
    full = facts.orders_from_lines(facts.sold_lines(master)).select(columns)
    assert sorted(map(tuple, lean.collect())) == sorted(map(tuple, full.collect()))


def test_rfm(tables):
    people = by_key(rfm.rfm_features(facts.order_facts(tables, payments=True)), "customer_unique_id")
    assert set(people) == {"anna", "bert", "dora"}
    anna = people["anna"]
    assert anna["frequency"] == anna["total_orders"] == 2
    assert anna["monetary"] == Decimal("43.00")
    assert anna["avg_order_value"] == Decimal("21.50")
    assert anna["recency_days"] == 30
    # No payment at all counts as zero.
    assert people["bert"]["monetary"] == Decimal("0.00")
    # 2018-01-30 00:00 to 2018-01-31 12:00 is one calendar day.
    assert people["bert"]["recency_days"] == 1


def test_kpis_around_the_thirty_day_edge(tables):
    days = by_key(kpi.kpi_snapshots(facts.order_facts(tables)), "snapshot_date")
    first, edge, past = dt.date(2018, 1, 1), dt.date(2018, 1, 30), dt.date(2018, 1, 31)
    assert set(days) == {first, edge, past}
    # Second order on the same day: repeating from that day on.
    assert days[first]["repeat_rate"] == Decimal("1.0000")
    assert days[first]["total_orders"] == 2
    # Bought 29 days ago: still active.  Thirty days: not any more.
    assert days[edge]["active_customers"] == 2
    assert days[past]["active_customers"] == 2
    assert days[past]["total_customers"] == 3
    assert days[past]["repeat_rate"] == Decimal("0.3333")


@pytest.mark.parametrize(
    ("idle", "status"), [(90, "healthy"), (91, "low"), (180, "low"), (181, "out_of_stock")]
)
def test_inventory_status_edges(spark, idle, status):
    newest = dt.datetime(2018, 12, 31, 1)
    oldest = (newest - dt.timedelta(days=idle)).replace(hour=23)
    rows = [("p", "o1", Decimal(1), oldest), ("q", "o2", Decimal(1), newest)]
    lines = spark.createDataFrame(
        rows, "product_id string, order_id string, item_revenue decimal(13,2), order_purchase_timestamp timestamp"
    ).selectExpr("*", "cast(null as double) review_score_avg", "cast(null as bigint) review_count")
    assert by_key(metrics.product_metrics(lines), "product_id")["p"]["inventory_status"] == status
