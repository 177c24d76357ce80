"""Calendar terms and the United States federal holiday rules."""

from __future__ import annotations

import math
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TURN = 2 * math.pi

# Fixed values: (month, day, first year) of the holidays that move to the nearest workday.
FIXED_DATES = (
    (1, 1, 1970),
    (6, 19, 2021),
    (7, 4, 1970),
    (11, 11, 1970),
    (12, 25, 1970),
)
# Fixed values: (month, isoweekday, nth or -1 for the last, first year).
FLOATING_DAYS = (
    (1, 1, 3, 1986),
    (2, 1, 3, 1970),
    (5, 1, -1, 1970),
    (9, 1, 1, 1970),
    (10, 1, 2, 1970),
    (11, 4, 4, 1970),
)


def weekday(day: Column) -> Column:
    """0 is Monday."""
    return F.weekday(day)


def year_fraction(day: Column) -> Column:
    length = F.dayofyear(F.make_date(F.year(day), F.lit(12), F.lit(31)))
    return (F.dayofyear(day) - 1) / length


def calendar_terms(day: Column) -> dict[str, Column]:
    angle = F.lit(TURN) * weekday(day) / 7
    yearly = F.lit(TURN) * year_fraction(day)
    return {
        "weekday_sin": F.sin(angle),
        "weekday_cos": F.cos(angle),
        "year_sin": F.sin(yearly),
        "year_cos": F.cos(yearly),
        "weekend": (weekday(day) >= 5).cast("int"),
    }


def harmonic_terms(day: Column, origin: str = "2023-01-01") -> dict[str, Column]:
    """One-hot weekdays, second and third yearly waves and a trend in years from ``origin``."""
    terms = {"trend": F.datediff(day, F.to_date(F.lit(origin))) / F.lit(365.0)}
    for n in range(7):
        terms[f"weekday_{n}"] = (weekday(day) == n).cast("int")
    for n in (2, 3):
        yearly = F.lit(n * TURN) * year_fraction(day)
        terms[f"year_sin_{n}"] = F.sin(yearly)
        terms[f"year_cos_{n}"] = F.cos(yearly)
    return terms


def observed_holidays(year: int) -> list[date]:
    """Observed federal holidays whose rule belongs to ``year`` (eleven dates at most)."""
    found = []
    for month, day, since in FIXED_DATES:
        if year >= since:
            actual = date(year, month, day)
            shift = {5: -1, 6: 1}.get(actual.weekday(), 0)
            found.append(actual + timedelta(days=shift))
    for month, isoday, nth, since in FLOATING_DAYS:
        if year < since:
            continue
        if nth > 0:
            first = date(year, month, 1)
            found.append(first + timedelta(days=(isoday - first.isoweekday()) % 7 + 7 * (nth - 1)))
        else:
            after = date(year + month // 12, month % 12 + 1, 1)
            last = after - timedelta(days=1)
            found.append(last - timedelta(days=(last.isoweekday() - isoday) % 7))
    return sorted(found)


def federal_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """``holiday date`` table. One year either side is included, since a New Year can move."""
    days = sorted({d for y in range(first_year - 1, last_year + 2) for d in observed_holidays(y)})
    return spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in days])).alias("holiday"))


def is_federal_holiday(day: Column) -> Column:
    """Whether a date is an observed federal holiday, as plain date arithmetic.

    No table, no range limit and no join: the rules are a few integer comparisons per row.
    """
    def fixed(d: Column) -> Column:
        hit = F.lit(False)
        for month, number, since in FIXED_DATES:
            hit = hit | ((F.month(d) == month) & (F.dayofmonth(d) == number) & (F.year(d) >= since))
        return hit

    w = weekday(day)
    moved = (w < 5) & (fixed(day) | ((w == 4) & fixed(F.date_add(day, 1))) | ((w == 0) & fixed(F.date_sub(day, 1))))
    floating = F.lit(False)
    for month, isoday, nth, since in FLOATING_DAYS:
        in_week = (F.dayofmonth(day).between(7 * nth - 6, 7 * nth) if nth > 0
                   else F.dayofmonth(day) > F.dayofmonth(F.last_day(day)) - 7)
        floating = floating | ((F.month(day) == month) & (w == isoday - 1) & in_week & (F.year(day) >= since))
    return moved | floating


def holiday_flags(df: DataFrame, day: str) -> DataFrame:
    """Add ``holiday``, ``before_holiday`` and ``after_holiday`` as 0/1."""
    return df.withColumns({
        "holiday": is_federal_holiday(F.col(day)).cast("int"),
        "before_holiday": is_federal_holiday(F.date_add(day, 1)).cast("int"),
        "after_holiday": is_federal_holiday(F.date_sub(day, 1)).cast("int"),
    })


def register_holiday_table(spark: SparkSession, name: str = "us_holidays") -> None:
    """Register the table function ``us_holidays(start, end)`` for SQL."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="holiday date")
    class UsHolidays:
        def eval(self, start: date, end: date):
            for year in range(start.year - 1, end.year + 2):
                for day in observed_holidays(year):
                    if start <= day <= end:
                        yield (day,)

    spark.udtf.register(name, UsHolidays)
