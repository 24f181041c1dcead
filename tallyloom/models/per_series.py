"""A linear forecast model of its own for every series.

One grouped aggregate gives each series the sums of its features' products; they
are whole numbers (money in cents, the weekly mean as the sum of seven days),
so they are exact and do not depend on how rows are laid out.  They are summed in
64-bit integers, if need be in two parts, wherever the data's size allows it.
Everything after that happens on one row per series, in expressions: the solution
of the normal equations, the errors on the held-out days, the residuals' spread
and the recursion over the days ahead.  There is no loop over series.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.models.forecast import (
    BAND_SIGMAS,
    HOLDOUT_DAYS,
    HORIZON,
    LAGS,
    fill_gaps,
    mark_holdout,
    split_by_length,
)
from tallyloom.session import cut_lineage

# Features, and last what they predict.
VARIABLES = ("trend", "dow", "month", "lag_1", "lag_7", "week", "cents")
TARGET = len(VARIABLES) - 1
# Added to the diagonal of the correlations, so that equal features share a weight.
RIDGE = 1e-9
WHOLE = "decimal(18,0)"
WIDE = "decimal(38,0)"
# Sums of at most so many bits are kept in 64-bit integers.
LONG_BITS = 62
MODEL_NAME = "spark-linreg-per-series"


@dataclass(frozen=True)
class SeriesForecasts:
    forecasts: DataFrame
    # (series, days, rmse, r2) on the held-out days; r2 is null where those are all alike.
    quality: DataFrame
    # (series, days) of the series that are too short to be forecast.
    short_series: DataFrame


def whole_number_features(filled: DataFrame) -> DataFrame:
    """Features of every day that has a full week before it, as whole numbers."""
    by_date = Window.partitionBy("series").orderBy("date")
    whole = Window.partitionBy("series")
    whole_cents = F.round(F.col("revenue") * 100).cast(WHOLE).cast("long")
    cents = filled.withColumn("cents", whole_cents)
    return cents.select(
        "series",
        "date",
        F.datediff("date", F.min("date").over(whole)).cast("long").alias("trend"),
        F.weekday("date").cast("long").alias("dow"),
        F.month("date").cast("long").alias("month"),
        F.lag("cents", 1).over(by_date).alias("lag_1"),
        F.lag("cents", LAGS).over(by_date).alias("lag_7"),
        F.sum("cents").over(by_date.rowsBetween(-LAGS, -1)).alias("week"),
        "cents",
    ).filter(F.col("lag_7").isNotNull())


def value_bits(given: DataFrame, days: int) -> list[int]:
    """Bits that hold the absolute value of each of VARIABLES in series of at most so many days."""
    cents = F.abs(F.round(F.col("revenue") * 100).cast(WHOLE))
    largest = int(given.agg(F.max(cents).alias("largest")).first()["largest"] or 0)
    known = {"trend": days, "dow": 6, "month": 12, "week": LAGS * largest}
    return [known.get(name, largest).bit_length() for name in VARIABLES]


def _sum_of_products(i: int, j: int, bits: list[int], day_bits: int) -> tuple[list[Column], Column]:
    """Sums over a group's rows, named p<i>_<j> and more, and the exact decimal they make up.

    One factor is cut in two where the whole product could need too many bits; beyond that
    the products are decimals, which is much slower.
    """
    x, y, name = F.col(VARIABLES[i]), F.col(VARIABLES[j]), f"p{i}_{j}"
    room = LONG_BITS - day_bits - bits[j]
    if bits[i] <= room:
        return [F.sum(x * y).alias(name)], F.col(name).cast(WIDE)
    if bits[i] <= 2 * room:
        low = x.bitwiseAND(F.lit((1 << room) - 1))
        parts = [F.sum(low * y).alias(name), F.sum(F.shiftright(x, room) * y).alias(f"{name}_high")]
        high = (F.col(f"{name}_high").cast(WIDE) * F.lit(1 << room)).cast(WIDE)
        return parts, (high + F.col(name).cast(WIDE)).cast(WIDE)
    return [F.sum(x.cast(WHOLE) * y.cast(WHOLE)).alias(name)], F.col(name).cast(WIDE)


def sums_of_products(marked: DataFrame, bits: list[int], days: int) -> DataFrame:
    """(series, is_holdout, n, s..., p...): rows, sums and sums of products, exact decimals."""
    day_bits = days.bit_length()
    summed, made = [F.count("*").alias("n")], [F.col("n").cast(WIDE).alias("n")]
    for i, name in enumerate(VARIABLES):
        plain = bits[i] + day_bits <= LONG_BITS
        summed.append(F.sum(F.col(name) if plain else F.col(name).cast(WHOLE)).alias(f"s{i}"))
        made.append(F.col(f"s{i}").cast(WIDE).alias(f"s{i}"))
        for j in range(i, len(VARIABLES)):
            parts, product = _sum_of_products(i, j, bits, day_bits)
            summed += parts
            made.append(product.alias(f"p{i}_{j}"))
    return marked.groupBy("series", "is_holdout").agg(*summed).select("series", "is_holdout", *made)


def _double(value: Column) -> Column:
    return value.cast("double")


def _moments(prefix: str) -> Column:
    """(n, means, products): products are n^2 times the covariances, exact before they become doubles."""
    n = F.col(f"{prefix}n")

    def product(i: int, j: int) -> Column:
        i, j = min(i, j), max(i, j)
        both = F.col(f"{prefix}s{i}").cast(WIDE) * F.col(f"{prefix}s{j}").cast(WIDE)
        return _double(n.cast(WIDE) * F.col(f"{prefix}p{i}_{j}").cast(WIDE) - both)

    span = range(len(VARIABLES))
    return F.struct(
        _double(n).alias("n"),
        F.array(*(_double(F.col(f"{prefix}s{i}")) / _double(n) for i in span)).alias("means"),
        F.array(*(F.array(*(product(i, j) for j in span)) for i in span)).alias("products"),
    )


def _solve(moments: Column) -> Column:
    """Weights of the features, from their correlations by Gauss-Jordan steps.

    A feature that never changes gets weight 0.
    """
    products = moments["products"]
    roots = F.transform(products, lambda row, i: F.sqrt(F.get(row, i)))

    def correlation(i: int, j: int) -> Column:
        spread = F.get(roots, F.lit(i)) * F.get(roots, F.lit(j))
        value = F.when(spread > 0, F.get(F.get(products, F.lit(i)), F.lit(j)) / spread)
        own = F.lit(1.0 + RIDGE) if i == j else F.lit(0.0)
        return own if i == j else F.coalesce(value, own)

    system = F.array(
        *(F.array(*(correlation(i, j) for j in range(TARGET + 1))) for i in range(TARGET))
    )

    def step(matrix: Column, p: Column) -> Column:
        pivot = F.transform(F.get(matrix, p), lambda x: x / F.get(F.get(matrix, p), p))
        return F.get(
            F.transform(
                F.array(pivot),
                lambda chosen: F.transform(
                    matrix,
                    lambda row, i: F.when(i == p, chosen).otherwise(
                        F.zip_with(row, chosen, lambda a, b: a - F.get(row, p) * b)
                    ),
                ),
            ),
            F.lit(0),
        )

    solved = F.aggregate(F.sequence(F.lit(0), F.lit(TARGET - 1)), system, step)
    return F.transform(
        solved,
        lambda row, i: F.when(
            F.get(roots, i) > 0, F.get(row, F.lit(TARGET)) * F.get(roots, F.lit(TARGET)) / F.get(roots, i)
        ).otherwise(0.0),
    )


def _dot(weights: Column, values: Column) -> Column:
    products = F.zip_with(weights, F.slice(values, 1, TARGET), lambda w, x: w * x)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _level(moments: Column, weights: Column) -> Column:
    """What is left of the target's mean once the features' means are weighed."""
    return F.get(moments["means"], F.lit(TARGET)) - _dot(weights, moments["means"])


def _residual_variance(moments: Column, weights: Column) -> Column:
    """Population variance of the target minus the weighed features."""
    products = moments["products"]
    target = F.get(products, F.lit(TARGET))
    fitted = _dot(weights, F.transform(F.slice(products, 1, TARGET), lambda row: _dot(weights, row)))
    spread = F.get(target, F.lit(TARGET)) - F.lit(2.0) * _dot(weights, target) + fitted
    return F.greatest(spread / (moments["n"] * moments["n"]), F.lit(0.0))


def fit_each(marked: DataFrame, bits: list[int], days: int) -> DataFrame:
    """(series, weights, level, sigma, rmse, r2) from whole-number features with is_holdout.

    Weights, level and sigma come from all days; rmse and r2 judge a fit on the
    other days by the held-out ones.  Money is in cents; ``bits`` and ``days`` bound
    the variables and the length of a series (``value_bits``).
    """
    # Two rows of sums for each series, of the held-out days and of the others.
    parts, held = sums_of_products(marked, bits, days), F.col("is_holdout")
    names = [c for c in parts.columns if c not in ("series", "is_holdout")]
    sums = parts.groupBy("series").agg(
        *(F.sum(c).alias(f"a_{c}") for c in names),
        *(F.sum(F.when(~held, F.col(c))).alias(f"t_{c}") for c in names),
        *(F.sum(F.when(held, F.col(c))).alias(f"h_{c}") for c in names),
    )
    solved = sums.select(
        "series", _moments("a_").alias("a"), _moments("t_").alias("t"), _moments("h_").alias("h")
    )
    # Each step is a column of its own, computed once.
    solved = solved.withColumns({"weights": _solve(F.col("a")), "trained": _solve(F.col("t"))})
    off = _level(F.col("h"), F.col("trained")) - _level(F.col("t"), F.col("trained"))
    solved = solved.withColumns(
        {
            "level": _level(F.col("a"), F.col("weights")),
            "sigma": F.sqrt(_residual_variance(F.col("a"), F.col("weights"))),
            "mse": off * off + _residual_variance(F.col("h"), F.col("trained")),
        }
    )
    target = F.lit(TARGET)
    spread = F.get(F.get(F.col("h.products"), target), target) / (F.col("h.n") * F.col("h.n"))
    return solved.select(
        "series",
        "weights",
        "level",
        "sigma",
        F.sqrt("mse").alias("rmse"),
        F.when(spread > 0, 1 - F.col("mse") / spread).alias("r2"),
    )


def _last_weeks(filled: DataFrame) -> DataFrame:
    """(series, last_date, days, history): the last week of each series in cents, in date order."""
    whole = Window.partitionBy("series")
    counted = filled.withColumns(
        {"last": F.max("date").over(whole), "days": F.count("*").over(whole).cast("int")}
    )
    recent = counted.filter(F.col("date") > F.date_sub("last", LAGS))
    cents = F.round(F.col("revenue") * 100)
    week = F.array_sort(F.collect_list(F.struct("date", cents.alias("cents"))))
    return recent.groupBy("series").agg(
        F.max("date").alias("last_date"),
        F.transform(week, lambda day: day["cents"]).alias("history"),
        F.max("days").alias("days"),
    )


def _path(horizon: int) -> Column:
    """The days ahead as one expression; every prediction is the next day's lag."""

    def step(history: Column, ahead: Column) -> Column:
        day = F.date_add("last_date", ahead)
        recent = F.slice(history, -LAGS, LAGS)
        values = F.array(
            _double(F.col("days") - 1 + ahead),
            _double(F.weekday(day)),
            _double(F.month(day)),
            F.element_at(recent, -1),
            F.element_at(recent, 1),
            F.aggregate(recent, F.lit(0.0), lambda total, x: total + x),
        )
        return F.concat(history, F.array(F.col("level") + _dot(F.col("weights"), values)))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("history"), step)
    return F.slice(path, LAGS + 1, horizon)


def forecast_each(
    daily: DataFrame, horizon: int = HORIZON, holdout_days: int = HOLDOUT_DAYS
) -> SeriesForecasts:
    """Forecasts of every series by its own model, with the pooled forecast's columns.

    Input is (series, date, revenue), money to the cent.  Series without enough
    days take no part; they come back in ``short_series``.
    """
    # Only the given days are written; the empty ones are filled in where they are read.
    given = cut_lineage(daily.repartition("series"))
    filled, short, days = split_by_length(fill_gaps(given), holdout_days)
    marked = mark_holdout(whole_number_features(filled), holdout_days)
    models = fit_each(marked, value_bits(given, days), days)
    state = cut_lineage(models.join(_last_weeks(filled), "series"))
    ahead = state.select("*", F.posexplode(_path(horizon)).alias("position", "prediction"))
    width = F.lit(BAND_SIGMAS) * F.col("sigma")
    forecasts = ahead.select(
        "series",
        F.date_add("last_date", F.col("position") + 1).alias("forecast_date"),
        F.round(F.col("prediction") / 100, 2).alias("predicted_revenue"),
        F.round(F.greatest(F.lit(0.0), F.col("prediction") - width) / 100, 2).alias("lower_bound"),
        F.round((F.col("prediction") + width) / 100, 2).alias("upper_bound"),
        F.lit(MODEL_NAME).alias("model_name"),
        F.current_timestamp().alias("generated_at"),
    )
    quality = state.select("series", "days", (F.col("rmse") / 100).alias("rmse"), "r2")
    return SeriesForecasts(forecasts, quality, short)
