"""CSV and Parquet scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyloom.sources.schemas import MULTI_LINE_TABLES, RAW_DDL, raw_schema


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV with doubled quotes as escapes; malformed cells become NULL.

    Without a schema the types are inferred, which costs one more pass.  A
    multi-line file cannot be split between tasks, so land it as Parquet once.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line, mode="PERMISSIVE")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_raw_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Scan the eight raw CSV tables; ``paths`` maps table name to file or folder."""
    return {
        table: scan_csv(spark, paths[table], raw_schema(table), table in MULTI_LINE_TABLES)
        for table in RAW_DDL
    }
