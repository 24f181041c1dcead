"""Timestamp parsing, calendar labels and date-range presets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RAW_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parsed_timestamp(name: str) -> Column:
    """Parse raw text; anything that does not fit the format becomes NULL."""
    return F.try_to_timestamp(F.col(name), F.lit(RAW_TIMESTAMP_FORMAT))


def month_start(value: Column) -> Column:
    return F.trunc(value, "month")


def weekday_label(value: Column) -> Column:
    return F.date_format(value, "EEE")


def month_label(value: Column) -> Column:
    return F.date_format(value, "MMM")


@dataclass(frozen=True)
class RangePreset:
    days: int | None
    months: int | None


# Day span and month count of each selectable range.
RANGE_PRESETS = {
    "Last 7 Days": RangePreset(7, 1),
    "Last 30 Days": RangePreset(30, 2),
    "Last 3 Months": RangePreset(90, 3),
    "Last 6 Months": RangePreset(180, 6),
    "Last 12 Months": RangePreset(365, 12),
    "All Time": RangePreset(None, None),
}


def preset(name: str) -> RangePreset:
    if name not in RANGE_PRESETS:
        raise ValueError(f"unknown range {name!r}; one of {', '.join(RANGE_PRESETS)}")
    return RANGE_PRESETS[name]


def within_preset(value: Column, name: str, anchor: Column) -> Column:
    """Both ends included, counted back from the last day in the data."""
    days = preset(name).days
    if days is None:
        return F.lit(True)
    end = F.to_date(anchor)
    return F.to_date(value).between(F.date_sub(end, days), end)


def within_dates(value: Column, start: str | None = None, end: str | None = None) -> Column:
    """Inclusive date range; a missing bound is open."""
    day = F.to_date(value)
    keep = F.lit(True)
    if start is not None:
        keep = keep & (day >= F.lit(start).cast("date"))
    if end is not None:
        keep = keep & (day <= F.lit(end).cast("date"))
    return keep


def latest(df: DataFrame, column: str) -> Column:
    """The largest value of a column as a scalar subquery, without a driver round trip."""
    return df.agg(F.max(column).alias("latest")).scalar()
