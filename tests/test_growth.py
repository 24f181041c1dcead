"""What keeps the large queries small: fewer passes, narrower shuffles, cheaper sums."""

from __future__ import annotations

import re
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.models import forecast, per_series, pruned, recommend, segments
from tallyloom.operators import facts
from tallyloom.operators.dedup import keep_first
from tallyloom.operators.tables import RetailTables
from tallyloom.plans import catalog
from tallyloom.plans.catalog import Sample, all_queries
from tallyloom.sinks import tables as tables_sink


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def daily_rows(spark, rows):
    return spark.createDataFrame(rows, "series string, date date, revenue double")


def test_gaps_are_filled_without_a_join(spark):
    start = date(2024, 1, 30)
    rows = [("a", start, 1.0), ("a", start + timedelta(3), None), ("a", None, 9.0), ("b", start, 2.0)]
    rows += [(None, start, 5.0), (None, start + timedelta(1), 6.0), ("c", None, 1.0)]
    filled = forecast.fill_gaps(daily_rows(spark, rows).repartition(3))
    found = sorted((r["series"] or "", r["date"], r["revenue"]) for r in filled.collect())
    days = [start + timedelta(d) for d in range(4)]
    expected = [("", days[0], 0.0), ("", days[1], 0.0)]
    expected += [("a", day, 1.0 if day == start else 0.0) for day in days] + [("b", start, 2.0)]
    assert found == expected
    plan = plan_of(filled.select("series", "date", "revenue"))
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning(series") == 1


@pytest.mark.parametrize("scale", [1, 10**6, 10**10, 10**13])
def test_sums_of_products_are_exact(spark, scale):
    start, length = date(2023, 12, 1), 60
    values = [((day * 7919) % 101 - 30) * scale / 100 for day in range(length)]
    rows = [("s", start + timedelta(day), value) for day, value in enumerate(values)]
    given = daily_rows(spark, rows)
    marked = forecast.mark_holdout(per_series.whole_number_features(forecast.fill_gaps(given)), 20)
    bits = per_series.value_bits(given, length)
    found = per_series.sums_of_products(marked, bits, length).collect()
    cents = [((day * 7919) % 101 - 30) * scale for day in range(length)]
    for row in found:
        span = range(length - 20, length) if row["is_holdout"] else range(7, length - 20)
        days = [
            (d, (start + timedelta(d)).weekday(), (start + timedelta(d)).month)
            + (cents[d - 1], cents[d - 7], sum(cents[d - 7 : d]), cents[d])
            for d in span
        ]
        assert row["n"] == len(days)
        for i in range(len(per_series.VARIABLES)):
            assert row[f"s{i}"] == sum(x[i] for x in days)
            for j in range(i, len(per_series.VARIABLES)):
                assert row[f"p{i}_{j}"] == sum(x[i] * x[j] for x in days)


def test_a_series_is_summed_by_few_integers(spark):
    start = date(2024, 1, 1)
    given = daily_rows(spark, [("s", start + timedelta(d), 100.0 + d) for d in range(60)])
    marked = forecast.mark_holdout(per_series.whole_number_features(forecast.fill_gaps(given)))
    sums = per_series.sums_of_products(marked, per_series.value_bits(given, 60), 60)
    partial = plan_of(sums.agg(F.max("p6_6"))).split("partial_sum(")
    # One sum for each product, and no decimal among them.
    assert len(partial) - 1 <= 40
    assert not any("decimal" in part.split(")")[0] for part in partial[1:])


def test_rule_made_clusters_compute_their_features_once(spark, sample_folder, monkeypatch):
    passes, build = [], Sample.features
    monkeypatch.setattr(Sample, "features", lambda self: passes.append(1) or build(self))
    sample = Sample(spark, sample_folder)
    assert sample.clusters_by_rule().count() == sample.segments_by_rule().count()
    assert len(passes) == 2  # one for each of the two calls above


def test_the_many_columns_of_an_order_join_last(spark, tables):
    plan = plan_of(facts.master_facts(tables))
    joins = re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[(\w+)#", plan)
    # The plan is printed from the top.
    assert joins[0] == "order_id"


def test_lean_tables_begin_like_the_whole_ones(spark, tables):
    for name, columns in (
        ("customers", ["customer_id", "customer_unique_id"]),
        ("orders", ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]),
        ("order_items", ["order_id", "order_item_id", "product_id"]),
        ("order_items", ["order_id", "order_item_id", "freight_value"]),
        ("order_reviews", ["review_id", "order_id", "review_score"]),
    ):
        lean, whole = tables.lean(name, *columns), getattr(tables, name)
        assert len(lean.columns) < len(whole.columns)
        assert sorted(lean.select(columns).collect()) == sorted(whole.select(columns).collect())


def test_what_settles_ties_after_the_last_needed_column_is_left_out(spark):
    rows = [(1, None, "b", "x"), (1, None, "a", "z"), (1, 3, "a", "a"), (2, 5, None, "q"), (2, 5, "c", "p")]
    df = spark.createDataFrame(rows, "k int, first int, second string, third string").repartition(3)
    whole = keep_first(df, ["k"])
    assert sorted(whole.select("k", "first", "second").collect()) == [(1, None, "a"), (2, 5, None)]
    lean = keep_first(df, ["k"], ["second"])
    assert lean.columns == ["k", "first", "second"]
    assert sorted(lean.collect()) == sorted(whole.select("k", "first", "second").collect())


def test_interactions_shuffle_only_what_they_need(spark, sample_folder):
    sample = Sample(spark, sample_folder)
    lines = facts.sales_lines(sample.tables, customers=True)
    whole = recommend.interactions(lines)
    assert sample.interactions().exceptAll(whole).isEmpty() and whole.exceptAll(sample.interactions()).isEmpty()
    plan = plan_of(sample.interactions())
    assert "l_shipdate" not in plan and "customer_city" not in plan and "order_approved_at" not in plan


@pytest.mark.parametrize("name", ["recommendations_check", "precision_at_k"])
def test_interactions_are_computed_once(name, spark, monkeypatch):
    passes, build = [], Sample.interactions
    monkeypatch.setattr(Sample, "interactions", lambda self: passes.append(1) or build(self))
    assert all_queries()[name](spark, "/root/testdata/sf0.001").count() == 1
    assert len(passes) == 1
    # What was written for the training is also what the results are compared with.
    assert "lineitem.parquet" not in plan_of(all_queries()[name](spark, "/root/testdata/sf0.001"))


def test_cluster_sums_are_exact_and_without_decimals(spark):
    rows = [(k, (k * 7919 - 40) * 10**12, -k * 10**15 - 1, k) for k in range(50)]
    points = spark.createDataFrame(rows, "customer_unique_id int, z0 long, z1 long, z2 long").repartition(4)
    found = segments._cluster_sums(points, [[0.0, 0.0, 0.0]])
    assert found == {0: {"n": 50} | {f"s{i}": sum(r[i + 1] for r in rows) for i in range(3)}}
    squared = segments._cluster_sums(points, [[0.0, 0.0, 0.0]], squares=True)
    assert squared[0]["squares"] == sum(x * x for r in rows for x in r[1:])


def test_products_already_bought_meet_numbers_of_blocks_and_no_vectors(spark, monkeypatch):
    seen, build = [], pruned._with_had
    monkeypatch.setattr(pruned, "_with_had", lambda pairs, *rest: seen.append(pairs.columns) or build(pairs, *rest))
    users = spark.createDataFrame([(i, [1.0, i / 7]) for i in range(9)], "id int, features array<float>")
    items = spark.createDataFrame([(i, [i / 3, 1.0]) for i in range(8)], "id int, features array<float>")
    had = spark.createDataFrame([(0, 7), (3, 7)], "user_idx int, item_idx int")
    lists = pruned.top_items(users, items, 2, had, user_block=4, item_block=2).lists.collect()
    assert seen == [["user_block", "item_block"]] * 2
    best = {u: [r.item_idx for r in sorted(lists, key=lambda r: r["rank"]) if r.user_idx == u] for u in range(9)}
    assert best == {u: [6, 5] if u in (0, 3) else [7, 6] for u in range(9)}


def test_orders_are_shuffled_once_for_the_fact_table(spark, sample_folder):
    master = facts.master_facts(Sample(spark, sample_folder).tables)
    assert master.collect()
    plan = plan_of(master)
    final = plan[: plan.index("== Initial Plan ==")]
    # The customers' side and the headers read one shuffle of the raw orders.
    assert "ReusedExchange" in final
    narrow = re.findall(r"Exchange hashpartitioning\(customer_id#\d+L?, \d+\).*\n.*?Project \[([^\]]*)\]", plan)
    assert any({c.split("#")[0] for c in columns.split(", ")} == {"order_id", "customer_id"} for columns in narrow)


def test_an_order_without_its_customer_keeps_its_columns(tables):
    named = {name: getattr(tables, name) for name in (
        "categories", "customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews"
    )}
    whole = facts.master_facts(RetailTables(named.__getitem__)).collect()
    named["customers"] = named["customers"].filter("customer_id != 'c1'")
    place = ("customer_unique_id", "customer_city", "customer_state")

    def without(rows, order):
        blank = dict.fromkeys(place)
        return sorted(str(r.asDict() | blank if r.order_id == order else r.asDict()) for r in rows)

    found = facts.master_facts(RetailTables(named.__getitem__)).collect()
    assert all(r[c] is None for r in found if r.order_id == "o1" for c in place)
    assert without(found, "o1") == without(whole, "o1")


def test_a_table_read_once_is_not_shuffled_to_be_written(spark, tmp_path, monkeypatch):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, id % 5) as month").repartition(4)
    for rebalance in (True, False):
        written = tables_sink.write_parquet(
            df, str(tmp_path / str(rebalance)), partition_by=["month"], rebalance=rebalance
        )
        assert set(written.select("id", "month").collect()) == set(df.collect())
        # Four tasks hold rows of each month.
        per_month = len(list((tmp_path / str(rebalance) / "month=1").glob("*.zstd.parquet")))
        assert per_month == (1 if rebalance else 4)
    asked = []

    def spy(df, path, **options):
        asked.append(options)
        return tables_sink.write_parquet(df, path, **options)

    monkeypatch.setattr(catalog, "write_parquet", spy)
    assert all_queries()["snapshots_from_fact_table"](spark, "/root/testdata/sf0.001").count()
    assert asked == [{"partition_by": ["purchase_month"], "rebalance": False}]


def test_vectors_are_copied_for_large_blocks_only(spark):
    pick = np.random.default_rng(5)
    # Norms that are all alike prune nothing.
    users, items = (pick.standard_normal((n, 4)).astype(np.float32) for n in (300, 20_000))
    items /= np.linalg.norm(items, axis=1)[:, None]
    frames = [
        spark.createDataFrame(pd.DataFrame({"id": range(len(v)), "features": v.tolist()}), "id int, features array<float>")
        for v in (users, items)
    ]
    found = pruned.top_items(*frames, 3)
    copies = found.pairs.agg(F.sum("users"), F.sum("items")).first()
    assert tuple(copies) == (300, 20_000)
    best = np.sort(users @ items.T, axis=1)[:, :-4:-1]
    for row in found.lists.collect():
        assert row.score == pytest.approx(best[row.user_idx, row["rank"] - 1], rel=1e-5)
    assert found.lists.count() == 900


def test_steps_left_out_hold_no_better_product(monkeypatch):
    monkeypatch.setattr(pruned, "ITEM_STEP", 16)
    pick = np.random.default_rng(8)
    u, v = (pick.standard_normal((n, 5)).astype(np.float32) for n in (60, 500))
    u[3] = 0
    block = pruned.steps(np.arange(500, dtype=np.int32), v)
    assert sorted(block.ids) == list(range(500)) and np.array_equal(block.vectors, v[block.ids])
    who, what = pick.integers(0, 60, 900), np.sort(pick.integers(0, 500, 900))
    scores = u @ block.vectors.T
    scores[who, what] = -np.inf
    for beat in (np.full(60, -np.inf), np.full(60, 1.5)):
        values, places, after = pruned.walk(u, block, 7, beat, (who, what))
        for row in range(60):
            best = np.sort(scores[row][scores[row] > beat[row]])[::-1][:7]
            found = np.isfinite(values[row])
            assert np.sort(values[row][found])[::-1] == pytest.approx(best, rel=1e-5, abs=1e-6)
            assert values[row][found] == pytest.approx(scores[row][places[row][found]], rel=1e-5, abs=1e-6)
            assert len(set(places[row][found])) == found.sum()
            assert after[row] == (values[row].min() if len(best) == 7 else beat[row])


@pytest.mark.parametrize("evaluate", [False, True])
def test_training_carries_numbers_and_ids_only_for_the_holdout(spark, monkeypatch, evaluate):
    seen = []

    class Training:
        def __init__(self, **settings):
            pass

        def fit(self, rows):
            seen.append(set(rows.columns))

    monkeypatch.setattr(recommend, "ALS", Training)
    monkeypatch.setattr(recommend, "_evaluated", lambda fitted, holdout: seen.append(set(holdout.columns)))
    bought = spark.createDataFrame([("a", "p", 1.0), ("b", "q", 2.0)], "customer_unique_id string, product_id string, rating float")
    recommend.fit_recommender(bought, evaluate=evaluate)
    numbers, ids = {"user_idx", "item_idx", "rating", "part"}, {"customer_unique_id", "product_id"}
    assert seen == ([numbers | ids] * 2 if evaluate else [numbers])
