"""Vector tables as the two searches take them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable_vectors(df: DataFrame, vec_id: str, vector: str, zeros: bool) -> DataFrame:
    """(vec_id, v array<double>) without null, empty or non-finite vectors, and zero ones if asked.

    Vectors whose length is not the commonest one (of equally common ones the
    longest) take no part either.
    """
    rows = df.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")
    )
    limit = F.lit(float("inf"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & fine)
    if not zeros:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    first = sizes.first()
    return rows.where(F.size("v") == F.lit(first["d"] if first else 0))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else values.reshape(0, 0)


def best_ranked(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest scores, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
