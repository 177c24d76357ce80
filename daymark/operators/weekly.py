"""Within-week contrast between weekdays and weekends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.calendar import weekday
from daymark.functions.numeric import ratio
from daymark.operators.validate import require_daily


def _weeks(daily: DataFrame, day: str, value: str) -> DataFrame:
    return daily.select(F.col(day).alias("date"), F.col(value).cast("double").alias("v"),
                        F.date_trunc("week", F.col(day)).cast("date").alias("week_start"),
                        weekday(F.col(day)).alias("_wd"))


def week_contrast(daily: DataFrame, day: str = "date", value: str = "trips") -> DataFrame:
    """One row per Monday week that has all seven days. A value that is not positive is an error."""
    positive = F.when(F.col("v") > 0, F.col("v")).otherwise(
        F.raise_error(F.lit("weekly contrasts need positive daily counts")).cast("double"))
    out = _weeks(daily, day, value).withColumn("v", positive).groupBy("week_start").agg(
        F.count(F.lit(1)).alias("_days"),
        F.avg(F.when(F.col("_wd") < 5, F.col("v"))).alias("weekday_mean"),
        F.avg(F.when(F.col("_wd") >= 5, F.col("v"))).alias("weekend_mean"),
        F.avg("v").alias("week_mean"),
    ).where(F.col("_days") == 7).drop("_days")
    out = out.withColumn("difference", F.col("weekday_mean") - F.col("weekend_mean"))
    return out.withColumn("contrast", ratio(F.col("difference"), F.col("week_mean")))


def planned_contrast(daily: DataFrame, first: str, last: str, reserved_from: str, day: str = "date",
                     value: str = "trips") -> DataFrame:
    """Action: contrasts of a planned period, which must be covered day by day and end before the
    reserved period."""
    if last >= reserved_from:
        raise ValueError("the analysis must end before the reserved period")
    inside = daily.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    require_daily(inside, day=day, value=value)
    seen = inside.agg(F.min(day).cast("string"), F.max(day).cast("string")).first()
    if tuple(seen) != (first, last):
        raise ValueError(f"dates cover {tuple(seen)}, the plan is {(first, last)}")
    return week_contrast(inside, day, value)


def excluded_dates(daily: DataFrame, day: str = "date") -> DataFrame:
    """Dates of weeks without all seven days."""
    weeks = daily.select(F.col(day).alias("date"), F.date_trunc("week", F.col(day)).cast("date").alias("week_start"))
    short = weeks.groupBy("week_start").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < 7)
    return weeks.join(short.select("week_start"), "week_start", "left_semi").select("date", "week_start")


def contrast_summary(weeks: DataFrame) -> DataFrame:
    """One row: complete weeks, their direction and means."""
    return weeks.agg(
        F.count(F.lit(1)).alias("complete_weeks"),
        F.count_if(F.col("contrast") > 0).alias("positive_weeks"),
        F.count_if(F.col("contrast") < 0).alias("negative_weeks"),
        F.avg("weekday_mean").alias("mean_weekday"), F.avg("weekend_mean").alias("mean_weekend"),
        F.avg("difference").alias("mean_difference"), F.avg("contrast").alias("estimate"),
        F.min("week_start").alias("first_date"), F.date_add(F.max("week_start"), 6).alias("last_date"))


def quarter_summary(weeks: DataFrame) -> DataFrame:
    return weeks.groupBy(F.quarter("week_start").cast("long").alias("quarter")).agg(
        F.count(F.lit(1)).alias("weeks"), F.avg("contrast").alias("mean_contrast"))


def records_to_json(weeks: DataFrame, day: str = "week_start") -> DataFrame:
    """One ISO-dated JSON record per row."""
    return weeks.select(day, F.to_json(F.struct(
        F.date_format(day, "yyyy-MM-dd").alias(day), *[c for c in weeks.columns if c != day])).alias("record"))


def records_from_json(records: DataFrame, schema: str, column: str = "record") -> DataFrame:
    return records.select(F.from_json(column, schema).alias("r")).select("r.*")
