"""Key deduplication with a total order, so that reruns keep the same row."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MARK = "__position"


def keep_first(
    df: DataFrame, keys: Sequence[str], columns: Collection[str] | None = None
) -> DataFrame:
    """One row per key: the smallest by the remaining columns, NULLs first.

    Spark turns the rank filter into a group limit on the map side, so each
    task sends at most one row per key and a key held by a large part of the
    input does not pile up in one reducer.

    ``columns`` names those that are needed.  The columns after the last of them
    only settle ties between rows that begin alike, so they are left out before
    anything is shuffled and the kept row begins with the same values.
    """
    rest = [c for c in df.columns if c not in keys]
    if columns is not None:
        rest = rest[: max((i + 1 for i, c in enumerate(rest) if c in columns), default=0)]
        df = df.select(*(c for c in df.columns if c in keys or c in rest))
    # A single-column key without other columns still needs an ordering.
    order = [F.col(c).asc_nulls_first() for c in rest] or [F.col(c) for c in keys]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(MARK, F.row_number().over(window)).filter(F.col(MARK) == 1).drop(MARK)
