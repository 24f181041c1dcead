"""Physical plans: what must and must not be in them."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tallyloom.models.indexing import dense_index
from tallyloom.operators.facts import master_facts, orders_from_lines, sold_lines
from tallyloom.operators.kpi import kpi_snapshots
from tallyloom.plans.catalog import BUILDERS, MODEL_QUERIES, Sample, all_queries
from tallyloom.sinks.tables import write_parquet


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


RELATIONAL = sorted(set(BUILDERS) - MODEL_QUERIES)


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_pairwise_join_and_no_python_worker(name, spark, sample_folder):
    plan = plan_of(all_queries()[name](spark, sample_folder))
    assert "NestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    assert not re.search(r"Python|Pandas|Arrow", plan)


def test_snapshots_read_every_table_once(spark, sample_folder):
    plan = plan_of(all_queries()["kpi_snapshots"](spark, sample_folder))
    assert plan.count("lineitem.parquet") == 1
    # Once for the headers, once for the customers, who are keyed by order.
    assert plan.count("orders.parquet") == 2


@pytest.mark.parametrize("name", ["product_metrics", "interaction_split", "channel_performance"])
def test_one_scan_of_the_lines_is_enough(name, spark, sample_folder):
    # Product measures are written once, so their plan has no scan of the lines left.
    assert plan_of(all_queries()[name](spark, sample_folder)).count("lineitem.parquet") <= 1


def test_scans_are_pruned(spark, sample_folder):
    plan = plan_of(all_queries()["revenue_daily"](spark, sample_folder))
    scan = re.search(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", plan, re.S).group(1)
    assert "l_tax" not in scan and "l_discount" not in scan


def test_filters_reach_the_fact_table_scan(spark, tmp_path):
    tables = Sample(spark, "/root/testdata/sf0.001").tables
    master = write_parquet(master_facts(tables), str(tmp_path / "m"), partition_by=["purchase_month"])
    plan = plan_of(kpi_snapshots(orders_from_lines(sold_lines(master))))
    scan = plan[plan.index("FileScan parquet") :]
    assert "PushedFilters: [IsNotNull(is_canceled), Not(EqualTo(is_canceled,true))" in scan
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
    assert {column.split("#")[0] for column in columns.split(",")} == {
        "order_id",
        "customer_unique_id",
        "order_purchase_timestamp",
        "item_revenue",
        "purchase_date",
        "is_canceled",
        "purchase_month",
    }


def test_index_offsets_are_the_only_forced_broadcast(spark):
    df = spark.range(10).selectExpr("cast(id as string) as k")
    plan = plan_of(dense_index(df, "k", "i"))
    assert plan.count("BroadcastExchange") == 1


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "snapshot_date",
        "total_revenue",
        "total_orders",
        "total_customers",
        "active_customers",
        "avg_order_value",
        "repeat_rate",
    ]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
