from __future__ import annotations

from dataclasses import replace

import pytest

from conftest import by_key
from tallyloom.models.recommend import AlsSettings
from tallyloom.operators import facts
from tallyloom.operators.tables import RetailTables
from tallyloom.plans import workflow
from tallyloom.plans.catalog import all_queries, present
from tallyloom.sources import sample

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    config = workflow.WorkflowConfig(
        root=str(tmp_path_factory.mktemp("run")),
        als=AlsSettings(rank=4, max_iterations=2, top_k=3),
        forecast_model="linreg",
        horizon=5,
    )
    return config, workflow.run_all(spark, sample.raw_tables(spark, SMALL), config)


def test_all_tables_are_written(spark, done):
    config, written = done
    assert set(written) == {
        "master_facts",
        "customer_features",
        "customer_segments",
        "recommendations",
        "kpi_snapshots",
        "product_metrics",
        "category_metrics",
        "sales_forecasts",
    }
    profile = workflow.summaries(written)
    for name, df in profile.items():
        assert df.first()["row_count"] > 0, name
    log = spark.read.parquet(config.path("ml_model_runs"))
    assert {(r.model_name, r.metric_name) for r in log.collect()} == {
        ("kmeans", "silhouette"),
        ("als", "rmse"),
        ("als", "precision_at_k"),
        ("sales_forecast", "rmse"),
        ("sales_forecast", "r2"),
    }


@pytest.mark.parametrize(
    ("table", "query"),
    [
        ("master_facts", "master_facts"),
        ("customer_features", "rfm_features"),
        ("kpi_snapshots", "kpi_snapshots"),
        ("product_metrics", "product_metrics"),
        ("category_metrics", "category_metrics"),
    ],
)
def test_written_tables_equal_the_queries(spark, done, table, query):
    _, written = done
    expected = all_queries()[query](spark, SMALL)
    ours = present(written[table]).select(expected.columns)
    assert sorted(map(str, ours.collect())) == sorted(map(str, expected.collect()))


def test_fact_table_is_partitioned_by_month(done):
    _, written = done
    files = written["master_facts"].inputFiles()
    assert all("purchase_month=" in file for file in files)


def test_stages_can_be_skipped_and_chosen(spark, done):
    config, _ = done
    again = workflow.run_preprocessing(spark, {}, replace(config, only_features=True))
    assert again["customer_features"].count() > 0
    chosen = workflow.run_analytics(spark, replace(config, steps=["metrics"]))
    assert set(chosen) == {"kpi_snapshots", "product_metrics", "category_metrics"}
    with pytest.raises(ValueError, match="unknown steps"):
        workflow.run_analytics(spark, replace(config, steps=["metrics", "magic"]))


def test_failing_forecast_does_not_fail_the_run(spark, done):
    config, _ = done
    assert workflow.run_analytics(spark, replace(config, steps=["forecast"], holdout_days=10**6)) == {}


def test_only_canceled_orders_is_a_clear_error(spark, raw, tmp_path):
    canceled = {**raw, "orders": raw["orders"].filter("order_status = 'canceled'")}
    config = workflow.WorkflowConfig(root=str(tmp_path))
    with pytest.raises(ValueError, match="anchor"):
        workflow.run_preprocessing(spark, canceled, config)


def test_tables_read_back_equal_tables_computed(spark, done):
    config, _ = done
    back = RetailTables.from_parquet(spark, config.root)
    computed = RetailTables.from_raw(sample.raw_tables(spark, SMALL))
    paid = [
        by_key(facts.payments_per_order(t.order_payments), "order_id") for t in (back, computed)
    ]
    assert paid[0] == paid[1]


def test_a_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    config = workflow.WorkflowConfig(root=str(tmp_path / "run"), steps=["segments", "metrics"], resume=True)
    raw_tables = sample.raw_tables(spark, SMALL)

    def fails(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(workflow, "rfm_features", fails)
        with pytest.raises(RuntimeError):
            workflow.run_all(spark, raw_tables, config)
    files = {t: set(spark.read.parquet(config.path(t)).inputFiles()) for t in ("orders", "categories", "master_facts")}
    built = []
    for name in ("master_facts", "complete_categories", "rfm_features", "kpi_snapshots"):
        function = getattr(workflow, name)
        monkeypatch.setattr(workflow, name, lambda *a, name=name, f=function, **k: (built.append(name), f(*a, **k))[1])
    first = workflow.run_all(spark, raw_tables, config)
    assert built == ["rfm_features", "kpi_snapshots"]
    for table, names in files.items():
        assert set(spark.read.parquet(config.path(table)).inputFiles()) == names
    # Nothing is left to do, and other settings do only what they change.
    again = workflow.run_all(spark, raw_tables, config)
    assert built == ["rfm_features", "kpi_snapshots"]
    assert again["kpi_snapshots"].count() == first["kpi_snapshots"].count() > 0
    before = set(again["customer_segments"].inputFiles())
    fewer = workflow.run_all(spark, raw_tables, replace(config, clusters=3))
    assert built == ["rfm_features", "kpi_snapshots"] and not before & set(fewer["customer_segments"].inputFiles())
    counts = {r.stage: r.rows for r in spark.read.parquet(f"{config.root}/_stages").collect()}
    assert counts["customer_features"] == first["customer_features"].count()
