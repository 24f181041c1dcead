"""Append-only log of model metrics."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)

SCHEMA = "model_name string, metric_name string, metric_value double, params map<string,string>"


def run_rows(
    spark: SparkSession,
    model: str,
    metrics: Mapping[str, float],
    params: Mapping[str, object],
) -> DataFrame:
    """One row per metric; the parameters travel as a JSON text."""
    shown = {key: str(value) for key, value in params.items()}
    rows = [(model, metric, float(value), shown) for metric, value in metrics.items()]
    return spark.createDataFrame(rows, SCHEMA).select(
        "model_name",
        "metric_name",
        "metric_value",
        F.to_json("params").alias("params"),
        F.current_timestamp().alias("trained_at"),
    )


def log_run(rows: DataFrame, path: str) -> bool:
    """Append to the log.  A failure is reported and does not stop the run."""
    try:
        rows.write.mode("append").parquet(path)
    except Exception as error:
        LOG.warning("model log not written: %s", error)
        return False
    return True


def log_runs(rows: Iterable[DataFrame], path: str) -> int:
    return sum(log_run(row, path) for row in rows)
