"""Daily KPIs: revenue, and running customer measures by an event sweep.

A customer counts towards a day's totals from known event dates on: the first
purchase, the second order, and the intervals of 30 days after each purchase
day.  Turning these into +1/-1 events and summing over the calendar replaces a
join of every day with every customer.  Customers are hashed across the
cluster; what reaches the running sum is one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.facts import MONEY_TOTAL

ACTIVE_DAYS = 30
RATE = "decimal(5,4)"


def revenue_daily(orders: DataFrame) -> DataFrame:
    """Revenue, orders and mean order value per purchase day, from order-grain facts."""
    per_day = (
        orders.filter(F.col("purchase_date").isNotNull())
        .groupBy(F.col("purchase_date").alias("snapshot_date"))
        .agg(
            F.sum("order_revenue").alias("total_revenue"),
            F.count("order_id").alias("total_orders"),
        )
    )
    mean = F.coalesce(F.try_divide("total_revenue", "total_orders"), F.lit(0))
    return per_day.select(
        "snapshot_date",
        F.col("total_revenue").cast(MONEY_TOTAL).alias("total_revenue"),
        "total_orders",
        mean.cast(MONEY_TOTAL).alias("avg_order_value"),
    )


def customer_days(orders: DataFrame) -> DataFrame:
    """Orders and revenue per customer and purchase day.

    Order-grain input already has each (day, customer, order) once, so a count
    is enough.  At most one row per calendar day remains for any customer, so a
    customer with a large part of all orders stays small from here on.
    """
    return (
        orders.filter(F.col("purchase_date").isNotNull())
        .groupBy("customer_unique_id", F.col("purchase_date").alias("day"))
        .agg(F.count("order_id").alias("orders"), F.sum("order_revenue").alias("revenue"))
    )


def daily_events(days: DataFrame) -> DataFrame:
    """Revenue, orders and customer events (+1/-1), summed per calendar day.

    Orders without a customer add to revenue and orders only.
    """
    by_customer = Window.partitionBy("customer_unique_id").orderBy("day")
    earlier = by_customer.rowsBetween(Window.unboundedPreceding, -1)
    traced = days.select(
        "day",
        "orders",
        "revenue",
        F.col("customer_unique_id").isNotNull().alias("known"),
        F.coalesce(F.sum("orders").over(earlier), F.lit(0)).alias("before"),
        F.least(F.lead("day").over(by_customer), F.date_add("day", ACTIVE_DAYS)).alias(
            "inactive_from"
        ),
    )
    known = F.col("known")
    is_first = known & (F.col("before") == 0)
    is_second = known & (F.col("before") < 2) & (F.col("before") + F.col("orders") >= 2)
    zero = F.lit(0)
    arrival = F.struct(
        F.col("day").alias("day"),
        F.col("orders").alias("orders"),
        F.col("revenue").alias("revenue"),
        is_first.cast("int").alias("new"),
        is_second.cast("int").alias("repeating"),
        known.cast("int").alias("active"),
        known.cast("int").alias("buyers"),
    )
    departure = F.struct(
        F.col("inactive_from").alias("day"),
        zero.cast("bigint").alias("orders"),
        F.lit(None).alias("revenue"),
        zero.alias("new"),
        zero.alias("repeating"),
        (-known.cast("int")).alias("active"),
        zero.alias("buyers"),
    )
    summed = ("orders", "revenue", "new", "repeating", "active", "buyers")
    return (
        traced.select(F.inline(F.array(arrival, departure)))
        .groupBy("day")
        .agg(*[F.sum(c).alias(c) for c in summed])
    )


def running_customers(events: DataFrame) -> DataFrame:
    """Daily sums with the customer measures run up over the calendar.

    Departures can fall on days without orders; those are no snapshot days.
    """
    # One row per calendar day: the unpartitioned window stays small at any scale.
    to_date = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.select(
        F.col("day").alias("snapshot_date"),
        "orders",
        "revenue",
        "buyers",
        F.sum("new").over(to_date).alias("total_customers"),
        F.sum("repeating").over(to_date).alias("repeat_customers"),
        F.sum("active").over(to_date).alias("active_customers"),
    ).filter(F.col("orders") > 0)


def _repeat_rate() -> Column:
    rate = F.try_divide("repeat_customers", "total_customers")
    return F.coalesce(rate, F.lit(0.0)).cast(RATE).alias("repeat_rate")


def customer_kpis(orders: DataFrame) -> DataFrame:
    """Customers to date, customers active in the last 30 days, and repeat rate."""
    running = running_customers(daily_events(customer_days(orders)))
    return running.filter(F.col("buyers") > 0).select(
        "snapshot_date", "total_customers", "active_customers", _repeat_rate()
    )


def kpi_snapshots(orders: DataFrame) -> DataFrame:
    """One row per purchase day with revenue and customer measures.

    Revenue travels along with the customer events, so the orders are read and
    shuffled once.  On a day without any known buyer the customer measures are
    zero.
    """
    return snapshots_of_events(daily_events(customer_days(orders)))


def snapshots_of_events(events: DataFrame) -> DataFrame:
    """The same rows from the sums of events per day."""
    running = running_customers(events)
    has_buyers = F.col("buyers") > 0
    mean = F.try_divide("revenue", "orders")
    return running.select(
        "snapshot_date",
        F.col("revenue").cast(MONEY_TOTAL).alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        F.when(has_buyers, F.col("total_customers")).otherwise(0).alias("total_customers"),
        F.when(has_buyers, F.col("active_customers")).otherwise(0).alias("active_customers"),
        mean.cast(MONEY_TOTAL).alias("avg_order_value"),
        F.when(has_buyers, _repeat_rate()).otherwise(F.lit(0).cast(RATE)).alias("repeat_rate"),
    )


# Measures that carry a period-over-period change, and the name of the change.
DELTAS = {
    "total_revenue": "revenue_delta",
    "total_orders": "orders_delta",
    "active_customers": "active_customers_delta",
    "avg_order_value": "aov_delta",
}


def kpi_deltas(snapshots: DataFrame) -> DataFrame:
    """Relative change of each measure against the snapshot before.

    NULL when there is none before or it was zero.
    """
    by_day = Window.orderBy("snapshot_date")
    changes = {}
    for measure, name in DELTAS.items():
        current = F.col(measure).cast("double")
        previous = F.lag(current).over(by_day)
        changes[name] = F.try_divide(current - previous, previous)
    return snapshots.withColumns(changes)


def kpi_summary(snapshots: DataFrame) -> DataFrame:
    """The latest snapshot with its changes."""
    return kpi_deltas(snapshots).orderBy(F.col("snapshot_date").desc()).limit(1)
