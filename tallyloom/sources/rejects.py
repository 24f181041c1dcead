"""CSV scans that keep what they cannot read.

Rows that do not fit the schema, or lack a value they need, go to a reject table
with the line and the reason; all others go on.  Good and bad rows are
written in one pass, which also counts them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "__line"


@dataclass(frozen=True)
class LandedRows:
    accepted: DataFrame
    # (line, reason)
    rejected: DataFrame
    accepted_rows: int
    rejected_rows: int


def land_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    folder: str,
    required: Sequence[str] = (),
    header: bool = True,
    multi_line: bool = False,
) -> LandedRows:
    """Read CSV files into Parquet below ``folder``, accepted and rejected rows apart.

    A row is rejected as malformed if a field does not parse or fields are missing
    or left over, else if one of the ``required`` columns is empty.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    scanned = (
        spark.read.schema(StructType([*wanted.fields]).add(CORRUPT, StringType()))
        .options(
            header=header, escape='"', multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
        )
        .csv(path)
    )
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed")
    for name in required:
        reason = reason.when(F.col(name).isNull(), f"no {name}")
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*wanted.names)))
    judged = scanned.withColumn("__reason", reason).withColumns(
        {CORRUPT: F.when(F.col("__reason").isNotNull(), line), "__rejected": F.col("__reason").isNotNull().cast("int")}
    )
    counted = Observation()
    judged.observe(
        counted, F.count("*").alias("rows"), F.coalesce(F.sum("__rejected"), F.lit(0)).alias("rejected")
    ).write.partitionBy("__rejected").parquet(folder)
    written = spark.read.schema(judged.schema).parquet(folder)
    accepted = written.filter("__rejected = 0").select(*wanted.names)
    rejected = written.filter("__rejected = 1").select(
        F.col(CORRUPT).alias("line"), F.col("__reason").alias("reason")
    )
    bad = counted.get["rejected"]
    return LandedRows(accepted, rejected, counted.get["rows"] - bad, bad)
