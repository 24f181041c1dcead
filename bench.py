"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the sample folder, BENCH_CPUS the local cores.  Every query
runs twice from the sample files, all rows are produced, and the better time
counts; queries that fit a model run once.  The two stages run once each, from raw tables to written Parquet; they
cover the same work as the published wall times of preprocessing and of
analytics with models.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyloom.plans.catalog import MODEL_QUERIES, all_queries  # noqa: E402
from tallyloom.plans.workflow import (  # noqa: E402
    WorkflowConfig,
    run_analytics,
    run_preprocessing,
)
from tallyloom.session import build_session  # noqa: E402
from tallyloom.sources.sample import raw_tables  # noqa: E402

HEADLINE = (
    "kpi_snapshots",
    "master_facts",
    "rfm_features",
    "product_metrics",
    "category_metrics",
    "top_product_rows",
    "revenue_monthly",
    "monthly_with_forecast",
    "recent_orders",
    "channel_performance",
    "activity_heatmap",
    "interaction_split",
    "forecast_features",
    "upsert_merge",
    "customer_segments",
    "recommendations",
    "sales_forecast",
    "sales_forecast_forest",
)
RUNS = 2


def timed(query, spark, folder) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def timed_stages(spark, folder) -> dict[str, float]:
    root = f"{spark.conf.get('spark.checkpoint.dir')}/bench-stages"
    config = WorkflowConfig(root=root)
    marks = [time.perf_counter()]
    run_preprocessing(spark, raw_tables(spark, folder), config)
    marks.append(time.perf_counter())
    run_analytics(spark, config)
    marks.append(time.perf_counter())
    return {
        "stage_preprocessing": round(marks[1] - marks[0], 3),
        "stage_analytics": round(marks[2] - marks[1], 3),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-shared-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    # One untimed run: class loading and compilation are not what is measured.
    timed(queries["kpi_snapshots"], spark, folder)
    seconds = {
        name: round(
            min(
                timed(queries[name], spark, folder)
                for _ in range(1 if name in MODEL_QUERIES else RUNS)
            ),
            3,
        )
        for name in chosen
    }
    if "BENCH_QUERIES" not in os.environ:
        seconds |= timed_stages(spark, folder)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
