"""Joins of features, forecasts, calendars and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from daymark.operators.ordered import running_totals


def with_forecast(features: DataFrame, forecast: DataFrame, on: Sequence[str] = ("date",)) -> DataFrame:
    return features.join(forecast, list(on), "left")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def require_complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Action: raise if any listed column still holds a null."""
    found = {k: v for k, v in null_counts(df, columns).first().asDict().items() if v}
    if found:
        raise ValueError(f"null values remain after the join: {found}")
    return df


def aligned(left: DataFrame, right: DataFrame, on: str = "date") -> DataFrame:
    """Full join with ``only_in`` naming the side of an unmatched row (null when matched)."""
    a = left.withColumn("_in_left", F.lit(1))
    b = right.withColumn("_in_right", F.lit(1))
    return a.join(b, on, "full").withColumn(
        "only_in", F.when(F.col("_in_right").isNull(), "left").when(F.col("_in_left").isNull(), "right")
    ).drop("_in_left", "_in_right")


def require_aligned(left: DataFrame, right: DataFrame, on: str = "date") -> DataFrame:
    """Action: raise unless both sides cover the same dates; returns their inner join."""
    apart = aligned(left.select(on), right.select(on), on).where(F.col("only_in").isNotNull()).limit(5).collect()
    if apart:
        raise ValueError(f"the two sides cover different dates, for example {[tuple(r) for r in apart]}")
    return left.join(right, on)


def without_collisions(training: DataFrame, validation: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Training rows whose predictors (null pattern included) equal no validation row.

    The validation side is reduced to distinct predictors first, so repeated rows cost one
    key each in the shuffle.
    """
    keys = validation.select(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)]).distinct()
    same = F.lit(True)
    for i, c in enumerate(columns):
        same = same & F.col(c).eqNullSafe(F.col(f"_v{i}"))
    return training.join(keys, same, "left_anti")


def as_of(requests: DataFrame, issues: DataFrame, request_time: Column, issue_time: str, carry: Sequence[str],
          keys: Sequence[str] = ()) -> DataFrame:
    """For each request, the newest issue at or before ``request_time`` (with equal keys).

    Both sides are laid on one time line, one row per (keys, time), and a running maximum of
    (issue time, values) is taken over it range by range; the answers are then joined back on
    (keys, time). So neither a whole key nor many requests of one instant meet in one task.
    If issues repeat a time, the largest values win. A request without an earlier issue keeps nulls.
    """
    payload = F.struct(F.col(issue_time).alias("t"), *[F.col(c).alias(c) for c in carry])
    kind = issues.select(payload.alias("p")).schema["p"].dataType
    timed = requests.withColumn("_t", request_time)
    asked = timed.select(*keys, "_t", F.lit(1).alias("_asked"), F.lit(None).cast(kind).alias("_issue"))
    known = issues.select(*keys, F.col(issue_time).alias("_t"), F.lit(0).alias("_asked"), payload.alias("_issue"))
    line = known.unionByName(asked).where(F.col("_t").isNotNull()).groupBy(*keys, "_t").agg(
        F.max("_asked").alias("_asked"), F.max("_issue").alias("_issue"))
    run = running_totals(line, "_t", [], keys, maxima=["_issue"]).where(F.col("_asked") == 1)
    found = run.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_t").alias("_at"),
                       F.col("_issue_upto"))
    same = F.col("_t") == F.col("_at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return timed.join(found, same, "left").select(
        *requests.columns, F.col("_issue_upto.t").alias(issue_time),
        *[F.col(f"_issue_upto.{c}").alias(c) for c in carry])


def route_with_fallback(base: DataFrame, preferred: DataFrame, on: Sequence[str], value: str, fallback: str,
                        preferred_name: str, fallback_name: str) -> DataFrame:
    """Preferred prediction where it exists, else the fallback, with ``used_model``."""
    p = preferred.select(*on, F.col(value).alias("_preferred"))
    return base.join(p, list(on), "left").withColumn(
        "prediction", F.coalesce(F.col("_preferred"), F.col(fallback).cast("double"))
    ).withColumn(
        "used_model", F.when(F.col("_preferred").isNull(), fallback_name).otherwise(preferred_name)
    ).drop("_preferred")


def largest_mistakes(scored: DataFrame, inputs: DataFrame, row_id: str, k: int = 3, cutoff: float = 0.5,
                     label: str = "label", score: str = "score") -> DataFrame:
    """The ``k`` worst misses and the ``k`` worst false alarms, joined back to their inputs."""
    missed = scored.where((F.col(label) == 1) & (F.col(score) < cutoff)).orderBy(F.col(score).asc(), row_id).limit(k)
    alarms = scored.where((F.col(label) == 0) & (F.col(score) >= cutoff)).orderBy(F.col(score).desc(), row_id).limit(k)
    worst = missed.withColumn("error_type", F.lit("false_negative")).unionByName(
        alarms.withColumn("error_type", F.lit("false_positive")))
    return F.broadcast(worst).join(inputs, row_id)  # 2k rows


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per key. Spark cuts each map task's groups to ``k`` rows before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
