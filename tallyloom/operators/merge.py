"""Keyed upserts and write-side normalisation as DataFrame operators.

Keys must be unique in each input, as a primary key would enforce.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEW = "__new_"


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``target`` with ``updates`` merged in by key.

    Matching rows take the update columns, by default all but the keys; new
    rows take every column.  With no columns to update, existing rows win.
    """
    others = [c for c in updates.columns if c not in keys]
    changed = set(others if update_columns is None else update_columns)
    if not changed:
        return insert_ignore(target, updates, keys)
    old = target.withColumn("__old", F.lit(True))
    new = updates.select(
        *keys, *[F.col(c).alias(NEW + c) for c in others], F.lit(True).alias(NEW)
    )
    joined = old.join(new, list(keys), "full")
    arrives, exists = F.col(NEW).isNotNull(), F.col("__old").isNotNull()
    merged = [
        F.when(arrives & (F.lit(c in changed) | ~exists), F.col(NEW + c)).otherwise(F.col(c)).alias(c)
        if c in others
        else F.col(c)
        for c in target.columns
    ]
    return joined.select(*merged)


def insert_ignore(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows of ``updates`` whose key is not there yet."""
    fresh = updates.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL; everything else stays."""
    floating = [name for name, kind in df.dtypes if kind in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column with row count, column count and NULL count, in one pass."""
    totals = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            F.col(f"n{i}").alias("null_count"),
        )
        for i, c in enumerate(df.columns)
    ]
    return totals.select(F.inline(F.array(*rows)))
