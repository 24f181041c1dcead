"""Written intermediate tables that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import ensure_checkpoint_dir

ARROW_BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches by bytes, so that very long texts do not add up in a worker."""
    for key, value in ARROW_BATCH_LIMITS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: lost executors replay nothing."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def plain_columns(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """The frame with its columns called column_0 and so on, but for the given ones' new names."""
    new = [f"column_{k}" for k in range(len(df.columns))]
    return df.toDF(*new), [new[df.columns.index(name)] for name in names]


def named_again(df: DataFrame, like: DataFrame) -> DataFrame:
    """Only the columns that plain_columns renamed, with their names."""
    return df.select(*(df[f"column_{k}"].alias(c) for k, c in enumerate(like.columns)))
