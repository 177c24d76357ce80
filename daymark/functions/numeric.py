"""Rounding, safe ratios, clipping and target transforms as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(column, places: int = 6) -> Column:
    """Round to ``places`` and turn a negative zero into zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), places) + F.lit(0.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def clip_forecast(column: Column) -> Column:
    """A count forecast cannot be negative. Null, NaN and infinity are errors."""
    finite = column.isNotNull() & ~F.isnan(column) & (F.abs(column) != F.lit(float("inf")))
    clipped = F.greatest(F.lit(0.0), column.cast("double"))
    return F.when(finite, clipped).otherwise(F.raise_error(F.lit("forecast is not finite")).cast("double"))


def whole_forecast(column: Column) -> Column:
    """The clipped forecast as a whole number; halves go to the even neighbour."""
    return F.bround(clip_forecast(column), 0).cast("long")


# The fitted targets; all but the logarithm take something off the count (SQL over feature columns).
TAKEN_OFF = {"direct": "0D", "residual7": "lag_7", "residualweekly": "weekly_mean_4",
             "residualblend": "(lag_7 + mean_7) / 2D", "delta1": "lag_1"}
# The range a fitted logarithm is held to.
LOG_RANGE = (0.0, 16.0)
#: Per target: SQL from a count to the fitted value and back, with ``{x}`` for the value.
TARGET_SQL = {name: (f"({{x}} - {taken})", f"greatest(0D, {{x}} + {taken})") for name, taken in TAKEN_OFF.items()}
TARGET_SQL["log"] = ("log1p({x})", f"expm1(least({LOG_RANGE[1]}D, greatest({LOG_RANGE[0]}D, {{x}})))")
TARGETS = tuple(TARGET_SQL)


def fitted_sql(count: str, target: str) -> str:
    """SQL of what is fitted in place of ``count``, itself SQL."""
    return TARGET_SQL[target][0].format(x=f"cast({count} as double)")


def count_sql(fitted: str, target: str) -> str:
    """SQL of the count, never negative, that belongs to the fitted value ``fitted``."""
    return TARGET_SQL[target][1].format(x=f"({fitted})")
