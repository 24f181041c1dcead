"""Text normalisation, labels for display, and search predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACEHOLDER = "—"


def lowered(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def uppered(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def underscores_to_spaces(value: Column) -> Column:
    return F.replace(value, F.lit("_"), F.lit(" "))


def title_case(value: Column) -> Column:
    """Upper-case the first letter of each word and keep the rest as it is.

    Words are separated by runs of underscores or white space.  NULL and the
    empty string become a dash.
    """
    words = F.filter(F.split(value, r"[_\s]+"), lambda w: w != "")
    cased = F.transform(
        words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2147483647))
    )
    return F.when(value.isNull() | (value == ""), F.lit(PLACEHOLDER)).otherwise(
        F.array_join(cased, " ")
    )


def short_id(value: Column, length: int) -> Column:
    return F.upper(F.substring(value.cast("string"), 1, length))


def labelled_id(prefix: str, value: Column, length: int) -> Column:
    return F.concat_ws(" ", F.lit(prefix), short_id(value, length))


def contains_any(columns: Sequence[str | Column], needle: str | None) -> Column:
    """Case-insensitive containment in any of the columns; a blank needle matches all."""
    wanted = (needle or "").strip()
    if not wanted:
        return F.lit(True)
    wanted = (needle or "").lower()
    tests = [
        F.coalesce(F.lower(F.col(c) if isinstance(c, str) else c).contains(wanted), F.lit(False))
        for c in columns
    ]
    return reduce(or_, tests)


def equals_unless_all(column: str | Column, choice: str | None, everything: str = "All") -> Column:
    """Equality filter that passes every row when the choice is the catch-all."""
    if choice is None or choice == everything:
        return F.lit(True)
    return (F.col(column) if isinstance(column, str) else column) == F.lit(choice)
