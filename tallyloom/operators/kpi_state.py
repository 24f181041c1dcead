"""Daily KPIs kept up to date by batches of changed orders.

The state is two tables: orders and revenue per customer and day, and the sums
of customer events per day.  A batch touches only its customers: their events
before are taken back, their events after are added.  Late orders and orders
that turn canceled are batches like any other, and the snapshots equal
those of all orders together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.kpi import customer_days, daily_events, snapshots_of_events

PERSON = "customer_unique_id"
EVENT_SUMS = ("orders", "revenue", "new", "repeating", "active", "buyers")


@dataclass(frozen=True)
class KpiState:
    # (customer_unique_id, day, orders, revenue)
    days: DataFrame
    # One row per calendar day.
    events: DataFrame

    def snapshots(self) -> DataFrame:
        return snapshots_of_events(self.events)


def initial_state(orders: DataFrame) -> KpiState:
    days = customer_days(orders)
    return KpiState(days, daily_events(days))


def _negated(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: -F.col(c) for c in columns})


def apply_batch(state: KpiState, added: DataFrame, removed: DataFrame | None = None) -> KpiState:
    """The state after a batch of order facts; a changed order is removed as it was and added as it is.

    Write the returned tables before the next batch: they are plans over the old
    ones.  Orders without a customer form one group of their own.
    """
    changes = customer_days(added)
    if removed is not None:
        changes = changes.unionByName(_negated(customer_days(removed), ("orders", "revenue")))
    # One row for each customer of the batch.
    people = changes.select(F.col(PERSON).alias("person")).distinct()
    same = state.days[PERSON].eqNullSafe(people["person"])
    before = state.days.join(people, same, "left_semi")
    untouched = state.days.join(people, same, "left_anti")
    after = (
        before.unionByName(changes)
        .groupBy(PERSON, "day")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
        .filter(F.col("orders") > 0)
    )
    moved = daily_events(after).unionByName(_negated(daily_events(before), EVENT_SUMS))
    events = state.events.unionByName(moved).groupBy("day").agg(*(F.sum(c).alias(c) for c in EVENT_SUMS))
    return KpiState(untouched.unionByName(after), events)
