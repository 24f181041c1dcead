"""Dense integer ids for any key, without bringing the keys to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 1024


def dense_index(df: DataFrame, key: str, index: str, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Lookup table (key, index) with indexes 0..n-1 over the distinct keys.

    Distinct keys spread evenly over hash buckets, are numbered inside their
    bucket, and get the size of the buckets before as an offset.  The result
    depends on the keys alone and not on the layout of the input, so lost tasks
    recompute the same ids.  The offsets are one row per bucket, which bounds
    the broadcast.  Past the integer range that matrix factorisation accepts
    the cast raises an error.
    """
    keys = df.select(key).dropna().distinct().withColumn(
        "__bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    )
    in_bucket = Window.partitionBy("__bucket").orderBy(key)
    numbered = keys.withColumn("__seq", F.row_number().over(in_bucket))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keys.groupBy("__bucket")
        .agg(F.count("*").alias("__n"))
        .select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    return numbered.join(F.broadcast(offsets), "__bucket").select(
        key, (F.col("__offset") + F.col("__seq") - 1).cast("int").alias(index)
    )
