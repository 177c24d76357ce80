"""Hourly forecast responses: parallel JSON arrays of epoch seconds and values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_from_json(responses: DataFrame, variables: Sequence[str], column: str = "json",
                     keep: Sequence[str] = ()) -> DataFrame:
    """One row per hour: ``instant`` and the variables. Repeated or unsorted instants fail the job."""
    fields = ", ".join(["time: array<bigint>"] + [f"`{v}`: array<double>" for v in variables])
    parsed = responses.select(*keep, F.from_json(F.col(column), f"hourly struct<{fields}>").alias("_r"))
    times = F.col("_r.hourly.time")
    # Each instant against the one after it, inside the response's own array.
    rising = F.forall(F.arrays_zip(F.slice(times, 1, F.greatest(F.size(times) - 1, F.lit(0))).alias("a"),
                                   F.slice(times, 2, F.greatest(F.size(times) - 1, F.lit(0))).alias("b")),
                      lambda p: p["a"] < p["b"])
    same_length = F.lit(True)
    for v in variables:
        same_length = same_length & (F.size(F.col(f"_r.hourly.`{v}`")) == F.size(times))
    checked = F.when(F.coalesce(rising & same_length, F.lit(False)), times).otherwise(
        F.raise_error(F.lit("forecast hours are missing, repeated, unsorted or of unequal length")).cast("array<bigint>"))
    zipped = F.arrays_zip(checked.alias("time"), *[F.col(f"_r.hourly.`{v}`").alias(v) for v in variables])
    return parsed.select(*keep, F.explode(zipped).alias("_h")).select(
        *keep, F.timestamp_seconds("_h.time").alias("instant"), *[F.col(f"_h.`{v}`").alias(v) for v in variables])


def require_hours(hours: DataFrame, first, last, instant: str = "instant") -> DataFrame:
    """Action: raise if a real hour between the two UTC instants (end excluded) is missing."""
    span = hours.sparkSession.range(1).select(F.explode(F.expr(
        f"sequence(timestamp'{first}', timestamp'{last}' - interval 1 hour, interval 1 hour)")).alias(instant))
    missing = span.join(hours.select(instant), instant, "left_anti").count()
    if missing:
        raise ValueError(f"{missing} real hours are missing; they are never filled silently")
    return hours
