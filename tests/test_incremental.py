"""Tables and measures that are kept up to date instead of computed anew."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import as_dicts
from tallyloom.operators import kpi, kpi_state, merge, periods
from tallyloom.operators.tables import RetailTables
from tallyloom.plans import dashboard, sql, views
from tallyloom.plans.catalog import Sample
from tallyloom.session import cut_lineage
from tallyloom.sinks import managed
from tallyloom.sources import sample
from tallyloom.sources.rejects import land_csv

SMALL = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# -------------------------------------------------------------- managed tables


@pytest.fixture
def prices(spark, tmp_path):
    table = spark.range(200).selectExpr("cast(id as int) as k", "id * 1.5D as v", "concat('n', id) as name")
    root = str(tmp_path / "prices")
    managed.create_table(table, root, ["k"], buckets=16)
    return table, root


@pytest.mark.parametrize("columns", [None, ["v"], []])
def test_an_upsert_touches_only_its_buckets(spark, prices, columns):
    table, root = prices
    updates = spark.createDataFrame([(3, float("nan"), "x"), (900, 9.0, "y")], "k int, v double, name string")
    report = managed.upsert_table(updates, root, columns)
    assert report.version == 2
    assert 1 <= report.buckets_read <= 2 and report.buckets_written == report.buckets_read
    assert report.buckets_kept + report.buckets_written == 16
    expected = merge.upsert(table, merge.nan_to_null(updates), ["k"], columns)
    assert rows_of(managed.read_table(spark, root, table)) == rows_of(expected)
    # The version before is still there.
    assert rows_of(managed.read_table(spark, root, table, version=1)) == rows_of(table)


def test_kept_buckets_keep_their_files(spark, prices):
    table, root = prices
    before = set(managed.read_table(spark, root, table).inputFiles())
    managed.upsert_table(spark.createDataFrame([(5, 1.0, "z")], "k int, v double, name string"), root)
    after = set(managed.read_table(spark, root, table).inputFiles())
    assert len(after - before) == 1 and len(before - after) == 1


def test_a_run_that_dies_before_the_switch_changes_nothing(spark, prices, monkeypatch):
    table, root = prices
    updates = spark.createDataFrame([(5, 1.0, "z")], "k int, v double, name string")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(managed, "_publish", dies)
        with pytest.raises(RuntimeError):
            managed.upsert_table(updates, root)
    assert rows_of(managed.read_table(spark, root, table)) == rows_of(table)
    assert managed.upsert_table(updates, root).version == 2
    assert managed.read_table(spark, root, table).filter("k = 5").first()["name"] == "z"


def test_updates_without_rows(spark, prices):
    table, root = prices
    report = managed.upsert_table(table.limit(0), root)
    assert (report.buckets_read, report.buckets_written, report.buckets_kept) == (0, 0, 16)
    assert managed.read_table(spark, root, table).count() == 200


# ---------------------------------------------------------- KPIs in batches


def order_frame(spark, rows):
    return spark.createDataFrame(
        [(c, d, o, r) for o, (c, d, r) in rows.items()],
        "customer_unique_id string, purchase_date date, order_id string, order_revenue double",
    )


def test_batches_equal_all_orders_together(spark):
    pick = random.Random(7)
    first = dt.date(2018, 1, 1)

    def order():
        person = pick.choice([None, *"abcdefgh"])
        return person, first + dt.timedelta(days=pick.randrange(150)), float(pick.randrange(1, 50))

    held = {f"o{k}": order() for k in range(60)}
    state = kpi_state.initial_state(order_frame(spark, held))
    for step in range(3):
        state = kpi_state.KpiState(cut_lineage(state.days), cut_lineage(state.events))
        gone = {o: held.pop(o) for o in pick.sample(sorted(held), 8)}
        fresh = {f"n{step}-{k}": order() for k in range(10)}
        # One order changes its day: it goes as it was and comes as it is.
        moved = pick.choice(sorted(held))
        gone[moved] = held[moved]
        held[moved] = fresh[moved] = (held[moved][0], first + dt.timedelta(days=200 + step), held[moved][2])
        held.update(fresh)
        state = kpi_state.apply_batch(state, order_frame(spark, fresh), order_frame(spark, gone))
        expected = kpi.kpi_snapshots(order_frame(spark, held))
        assert rows_of(state.snapshots()) == rows_of(expected)


# --------------------------------------------------- customers of any period


def test_trailing_and_grouped_customers_equal_a_recount(spark):
    pick = random.Random(11)
    first = dt.date(2018, 1, 1)
    rows = [(f"c{pick.randrange(25)}", first + dt.timedelta(days=pick.choice([0, 1, 2, 9, 10, 31, 45]))) for _ in range(80)]
    rows += [(None, first), ("c1", None), *rows[:5]]
    orders = spark.createDataFrame(rows, "customer_unique_id string, purchase_date date")
    bitmaps = periods.daily_bitmaps(orders).cache()
    known = {(c, d) for c, d in rows if c and d}
    last = max(d for _, d in known)
    days = [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]
    for length in (1, 7, 30, 400):
        expected = [
            (day, len({c for c, d in known if day - dt.timedelta(days=length) < d <= day})) for day in days
        ]
        found = periods.distinct_trailing(bitmaps, length).orderBy("day").collect()
        assert [(r.day, r.customers) for r in found] == expected
    months = rows_of(periods.distinct_by_period(bitmaps, F.trunc("day", "month")))
    assert months == [
        (dt.date(2018, m, 1), len({c for c, d in known if d.month == m})) for m in (1, 2)
    ]
    assert periods.distinct_trailing(bitmaps.limit(0), 7).count() == 0


def test_customers_in_several_bitmaps(spark):
    many = spark.range(70_000).selectExpr(
        "concat('c', id) as customer_unique_id", "date_add(date'2018-01-01', cast(id % 3 as int)) as purchase_date"
    )
    bitmaps = periods.daily_bitmaps(many)
    assert bitmaps.select("bucket").distinct().count() == 3
    assert [r.customers for r in periods.distinct_trailing(bitmaps, 2).orderBy("day").collect()] == [
        23_334, 46_667, 46_666,
    ]


# -------------------------------------------------------------- rejected rows


def test_rejected_rows_keep_line_and_reason(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('k,n,text\na,1,"x ""y"", z"\nb,one,t\nc,3\n,4,t\nd,5,t,left over\ne,,\n')
    landed = land_csv(spark, str(path), "k string, n int, text string", str(tmp_path / "out"), ["k"])
    assert rows_of(landed.accepted) == [("a", 1, 'x "y", z'), ("e", None, None)]
    assert rows_of(landed.rejected) == [
        (",4,t", "no k"),
        ("b,one,t", "malformed"),
        ("c,3", "malformed"),
        ("d,5,t,left over", "malformed"),
    ]
    assert (landed.accepted_rows, landed.rejected_rows) == (2, 4)


def test_nothing_is_rejected_from_an_empty_file(spark, tmp_path):
    (tmp_path / "in.csv").write_text("k,n\n")
    landed = land_csv(spark, str(tmp_path / "in.csv"), "k string, n int", str(tmp_path / "out"))
    assert (landed.accepted_rows, landed.rejected_rows) == (0, 0)
    assert landed.accepted.count() == landed.rejected.count() == 0


# ------------------------------------------------------------------ SQL text


def test_sql_text_equals_the_frames(spark):
    s = Sample(spark, SMALL)
    names = sql.register(
        spark,
        s.tables,
        segments=s.segments_by_rule(),
        features=s.features(),
        recommendations=s.most_bought(),
        model_runs=sample.model_run_log(spark, SMALL),
    )
    assert {"v_customer_clusters", "v_top_recommendations", "v_segment_distribution"} <= set(names)
    assert len(names) == 12  # the eleven views, and the orders they start from
    assert rows_of(spark.sql("SELECT * FROM v_revenue_monthly")) == rows_of(s.monthly())
    assert rows_of(spark.table("v_segment_distribution")) == rows_of(views.segment_distribution(s.segments_by_rule()))
    best = spark.sql("SELECT product_id, rank FROM best_products(wanted => 5, search => '')")
    shown = dashboard.top_product_rows(s.top_products(), limit=5)
    assert rows_of(best) == rows_of(shown.select(F.col("raw_id"), F.col("rank")))
    monthly = spark.sql("SELECT sum(revenue) FROM months_of_revenue(3)").first()[0]
    assert float(monthly) == as_dicts(dashboard.period_totals(s.monthly(), "Last 3 Months"))[0]["revenue"]
    between = spark.sql(
        "SELECT count(*) FROM orders_of_period(DATE '1996-03-01', DATE '1996-03-31') o "
        "JOIN v_orders USING (order_id) WHERE o.order_status <> 'canceled'"
    ).first()[0]
    bought = F.to_date("order_purchase_timestamp")
    kept = s.tables.orders.filter(bought.between("1996-03-01", "1996-03-31") & (F.col("order_status") != "canceled"))
    assert between == kept.count()


def test_views_need_only_the_tables_that_are_given(spark):
    tables = Sample(spark, SMALL).tables
    assert isinstance(tables, RetailTables)
    assert "v_ml_model_latest" not in sql.view_frames(tables)
    assert len(sql.view_frames(tables)) == 8
