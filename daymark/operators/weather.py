"""Hourly forecast values to daily ones, by true local dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.clock import local_date, utc_clock

NEW_YORK = "America/New_York"
# Fixed value: rain below this is an error, above it a rounding artefact that counts as zero.
LOWEST_RAIN = -0.1


def trim_to_days(hourly: DataFrame, first: str, last: str, instant: str = "instant", zone: str = NEW_YORK) -> DataFrame:
    """Hours whose local date lies in [first, last]; a response usually overlaps both ends."""
    day = local_date(utc_clock(hourly, instant), zone)
    return hourly.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def hourly_to_daily(hourly: DataFrame, values: Sequence[str], instant: str = "instant", zone: str = NEW_YORK) -> DataFrame:
    """Mean, min and max per local date. One null hour makes that day's values null, all of them."""
    complete = F.lit(0)
    for v in values:
        complete = complete + F.col(v).isNull().cast("int")
    whole = F.sum(complete) == 0
    out = [F.count(F.lit(1)).alias("hours")]
    for v in values:
        out += [F.when(whole, F.avg(v)).alias(f"{v}_mean"), F.when(whole, F.min(v)).alias(f"{v}_min"),
                F.when(whole, F.max(v)).alias(f"{v}_max")]
    return hourly.groupBy(local_date(utc_clock(hourly, instant), zone).alias("date")).agg(*out)


def rain_wind_daily(hourly: DataFrame, rain: str = "rain", wind: str = "wind", instant: str = "instant",
                    zone: str = NEW_YORK) -> DataFrame:
    """Daily rain and wind.

    A rain stamp closes its hour, so one elapsed hour is taken off the instant before it is
    dated; wind is dated as stamped. Rain between -0.1 and 0 counts as zero and is reported.
    """
    at = utc_clock(hourly, instant)
    rain_day = local_date(at - F.expr("INTERVAL 1 HOUR"), zone)
    wind_day = local_date(at, zone)
    refused = F.raise_error(F.lit("forecast value is missing, not finite or too negative")).cast("double")

    def usable(name: str, floor: float) -> Column:
        v = F.col(name).cast("double")
        good = v.isNotNull() & ~F.isnan(v) & (v != F.lit(float("inf"))) & (v >= F.lit(floor - 0.000001 if floor < 0 else floor))
        return F.when(good, v).otherwise(refused)

    # Both values leave each hour as one dated row apiece, so a single shuffle serves both.
    dated = hourly.select(F.inline(F.array(
        F.struct(rain_day.alias("date"), usable(rain, LOWEST_RAIN).alias("_rain"), F.lit(None).cast("double").alias("_wind")),
        F.struct(wind_day.alias("date"), F.lit(None).cast("double").alias("_rain"), usable(wind, 0.0).alias("_wind")),
    )))
    return dated.groupBy("date").agg(
        F.sum(F.greatest(F.col("_rain"), F.when(F.col("_rain").isNotNull(), F.lit(0.0)))).alias("rain_sum"),
        F.sum("_rain").alias("rain_raw_sum"),
        F.count_if(F.col("_rain") < 0).alias("rain_negative_hours"),
        F.count("_rain").alias("rain_hours"),
        F.avg("_wind").alias("wind_mean"),
        F.max("_wind").alias("wind_max"),
    )


def expected_instants(hours: DataFrame, instant: str = "instant") -> DataFrame:
    """Wind hours together with the rain stamps one hour later."""
    later = hours.select((F.col(instant) + F.expr("INTERVAL 1 HOUR")).alias(instant))
    return hours.select(instant).unionByName(later).distinct()
