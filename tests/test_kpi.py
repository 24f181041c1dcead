"""The event sweep against a plain recount of every day."""

from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from conftest import by_key
from tallyloom.operators import kpi

START = dt.date(2018, 1, 1)
SCHEMA = (
    "order_id int, customer_unique_id string, purchase_date date, order_revenue decimal(24,2)"
)


def recount(orders):
    expected = {}
    for day in {o[2] for o in orders}:
        past = [o for o in orders if o[2] <= day and o[1] is not None]
        today = [o for o in orders if o[2] == day]
        counts = {}
        for order in past:
            counts[order[1]] = counts.get(order[1], 0) + 1
        active = {o[1] for o in past if o[2] >= day - dt.timedelta(days=29)}
        known = any(o[1] is not None for o in today)
        rate = Decimal(sum(n >= 2 for n in counts.values())) / Decimal(max(len(counts), 1))
        revenue = sum(o[3] for o in today)
        cents = Decimal("0.01")
        expected[day] = {
            "snapshot_date": day,
            "total_revenue": revenue,
            "total_orders": len(today),
            "total_customers": len(counts) if known else 0,
            "active_customers": len(active) if known else 0,
            "avg_order_value": (revenue / len(today)).quantize(cents, ROUND_HALF_UP),
            "repeat_rate": rate.quantize(Decimal("0.0001"), ROUND_HALF_UP) if known else Decimal(0),
        }
    return expected


@pytest.mark.parametrize("seed", range(4))
def test_sweep_equals_recount(spark, seed):
    pick = random.Random(seed)
    span, people, count = pick.choice([(40, 5, 60), (120, 12, 80), (400, 3, 90), (90, 30, 150)])
    orders = [
        (
            i,
            pick.choice([f"c{pick.randrange(people)}"] * 9 + [None]),
            START + dt.timedelta(days=pick.randrange(span)),
            Decimal(pick.randrange(1, 10000)) / 100,
        )
        for i in range(count)
    ]
    df = spark.createDataFrame(orders, SCHEMA)
    expected = recount(orders)
    assert by_key(kpi.kpi_snapshots(df), "snapshot_date") == expected
    measures = by_key(kpi.customer_kpis(df), "snapshot_date")
    for day, row in measures.items():
        assert row == {k: expected[day][k] for k in row}
    daily = by_key(kpi.revenue_daily(df), "snapshot_date")
    for day, row in daily.items():
        assert row == {k: expected[day][k] for k in row}


def test_hot_customer_and_many_orders_a_day(spark):
    """A third of all orders from one person leaves one row per day for them."""
    orders = spark.range(3000).selectExpr(
        "cast(id as int) order_id",
        "if(id % 3 = 0, 'hot', concat('c', id % 700)) customer_unique_id",
        "date_add(date'2018-01-01', cast(id % 50 as int)) purchase_date",
        "cast(1 as decimal(24,2)) order_revenue",
    )
    days = kpi.customer_days(orders).filter("customer_unique_id = 'hot'")
    assert days.count() == 50
    last = max(by_key(kpi.kpi_snapshots(orders), "snapshot_date").items())[1]
    assert last["total_customers"] == orders.select("customer_unique_id").distinct().count()


def test_deltas(spark):
    rows = [
        (START, Decimal(0), 1, 1, 2, Decimal(5), Decimal(0)),
        (START + dt.timedelta(days=1), Decimal(4), 2, 1, 1, Decimal(5), Decimal(0)),
        (START + dt.timedelta(days=9), Decimal(3), 1, 1, 1, Decimal(6), Decimal(0)),
    ]
    snapshots = spark.createDataFrame(
        rows,
        "snapshot_date date, total_revenue decimal(24,2), total_orders int, total_customers int, "
        "active_customers int, avg_order_value decimal(24,2), repeat_rate decimal(5,4)",
    )
    deltas = by_key(kpi.kpi_deltas(snapshots), "snapshot_date")
    assert deltas[rows[0][0]]["orders_delta"] is None
    assert deltas[rows[1][0]]["revenue_delta"] is None
    assert deltas[rows[1][0]]["orders_delta"] == 1.0
    assert deltas[rows[1][0]]["active_customers_delta"] == -0.5
    (summary,) = kpi.kpi_summary(snapshots).collect()
    assert summary.snapshot_date == rows[2][0]
    assert summary.revenue_delta == -0.25
    assert summary.aov_delta == pytest.approx(0.2)
