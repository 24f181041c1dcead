"""Table writers.  Nothing here passes rows through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators.merge import nan_to_null, upsert


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
) -> DataFrame:
    """Write and hand back the scan of what was written.

    For a partitioned table the rows are rebalanced on the partition columns
    first: small partition values share a task, large ones are split over
    several, and each task opens few files.  For a table that is read once,
    ``rebalance=False`` saves this shuffle of whole rows; each task then sorts
    its rows and writes one file for each partition value among them.
    """
    out = df
    if partition_by and rebalance:
        out = df.hint("rebalance", *partition_by)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("compression", "zstd")
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_upsert(
    spark: SparkSession,
    current_path: str,
    updates: DataFrame,
    keys: Sequence[str],
    next_path: str,
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Merge ``updates`` into the table at ``current_path``, written to ``next_path``.

    The current files are only read, so a failed run leaves them whole; the
    caller switches readers to the new path.
    """
    if current_path.rstrip("/") == next_path.rstrip("/"):
        raise ValueError("an upsert cannot overwrite the files it reads")
    merged = upsert(spark.read.parquet(current_path), nan_to_null(updates), keys, update_columns)
    return write_parquet(merged, next_path)


def jdbc_options(url: str, table: str, batch_size: int, driver: str) -> dict[str, str]:
    jdbc_url = url if url.startswith("jdbc:") else f"jdbc:{url}"
    return {"url": jdbc_url, "dbtable": table, "driver": driver, "batchsize": str(batch_size)}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int = 5000,
    driver: str = "org.postgresql.Driver",
) -> None:
    """Append over JDBC, one connection per partition; it does not upsert."""
    options = jdbc_options(url, table, batch_size, driver)
    nan_to_null(df).write.format("jdbc").options(**options).mode(mode).save()
