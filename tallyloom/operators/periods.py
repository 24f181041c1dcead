"""Distinct customers of any period, from daily bitmaps.

Customers get dense numbers; a day's customers are bitmaps of 32,768 numbers
each.  Bitmaps of days combine into those of weeks, months or trailing windows
without reading the orders again, and the counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.models.indexing import dense_index

PERSON = "customer_unique_id"


def daily_bitmaps(orders: DataFrame) -> DataFrame:
    """(day, bucket, bits): who bought on a day; orders without day or customer do not count.

    Copies of a (day, customer) pair fold into one bit on the map side.
    """
    bought = orders.filter(F.col("purchase_date").isNotNull() & F.col(PERSON).isNotNull())
    pairs = bought.select(F.col("purchase_date").alias("day"), PERSON).distinct()
    number = F.col("number").cast("long") + 1  # bitmaps begin with number 1
    return (
        pairs.join(dense_index(pairs, PERSON, "number"), PERSON)
        .groupBy("day", F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def distinct_by_period(bitmaps: DataFrame, period: Column) -> DataFrame:
    """(period, customers) for periods that are given by an expression of the day."""
    merged = bitmaps.groupBy(period.alias("period"), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("period").agg(F.sum(F.bitmap_count("bits")).alias("customers"))


def distinct_trailing(bitmaps: DataFrame, days: int) -> DataFrame:
    """(day, customers) of the `days` calendar days up to every day from the first to the last.

    The calendar is cut into stretches of `days` days.  A window is the end of
    one stretch and the beginning of the next, so running unions forwards and
    backwards inside the stretches are all that is needed: two bitmaps a day and
    bucket, however long the window.
    """
    first, last = (bitmaps.agg(bound("day")).scalar() for bound in (F.min, F.max))
    # Every bucket has a row for every day: a few thousand for each 32,768 customers.
    bounded = bitmaps.select("bucket").distinct().withColumns({"first": first, "last": last})
    grid = bounded.select("bucket", "first", F.explode(F.sequence("first", "last")).alias("day"))
    placed = grid.join(bitmaps, ["day", "bucket"], "left").withColumn(
        "stretch", F.floor(F.datediff("day", "first") / days)
    )
    inside = Window.partitionBy("bucket", "stretch").orderBy("day")
    forwards = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backwards = Window.partitionBy("bucket", "stretch").orderBy(F.desc("day")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    unions = placed.select(
        "day",
        "bucket",
        F.bitmap_or_agg("bits").over(forwards).alias("so_far"),
        F.bitmap_or_agg("bits").over(backwards).alias("from_here"),
    )
    # The union from a day on serves the window that starts with it.
    begun = unions.select(F.date_add("day", days - 1).alias("day"), "bucket", F.col("from_here").alias("bits"))
    ended = unions.select("day", "bucket", F.col("so_far").alias("bits"))
    windows = ended.union(begun).groupBy("day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = windows.groupBy("day").agg(F.sum(F.bitmap_count("bits")).alias("customers"))
    return counts.filter(F.col("day") <= last)
