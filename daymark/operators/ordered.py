"""Whole-table ordered aggregates (ranks, running totals, quantiles) without a one-task window.

A window ordered over a whole table runs in one task. Here the order column is first cut
into value ranges, each range is summed on its own, the few range totals are accumulated,
and each range then runs its own window starting from its offset. Equal values are grouped
before that, so a value held by a third of all rows is one row here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from daymark.session import materialize

_STRIDE = 16


def range_count(df: DataFrame) -> int:
    """Number of value ranges: follows the session's shuffle width."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(32, min(4096, width))


def with_value_range(df: DataFrame, order: str, weights: Sequence[str], out: str,
                     ranges: int | None = None) -> DataFrame:
    """Add ``out``: the index of the quantile range that holds ``order``.

    Any cut points give right results; quantiles only keep the ranges even. The cut points
    are one aggregate row. Reading every weight keeps the subquery's input equal to the main
    branch's, so Spark reuses that shuffle.
    """
    ranges = ranges or range_count(df)
    probabilities = [i / ranges for i in range(1, ranges)]
    used = F.lit(0.0)
    for name in weights:
        used = used + F.abs(F.col(name).cast("double"))
    cuts = df.select(
        F.percentile_approx(F.when(used >= 0, F.col(order)), probabilities, max(400, 4 * ranges)).alias("fine")
    ).select(
        F.struct(
            F.col("fine"),
            F.filter("fine", lambda _, i: i % _STRIDE == _STRIDE - 1).alias("coarse"),
        )
    ).scalar()
    coarse = F.size(F.filter(F.col("_cuts.coarse"), lambda c: c < F.col(order)))
    near = F.slice(F.col("_cuts.fine"), F.col("_coarse") * _STRIDE + 1, _STRIDE)
    return (
        df.withColumn("_cuts", cuts)
        .withColumn("_coarse", coarse)
        .withColumn(out, F.col("_coarse") * _STRIDE + F.size(F.filter(near, lambda c: c < F.col(order))))
        .drop("_cuts", "_coarse")
    )


def running_totals(df: DataFrame, order: str | Sequence[str], sums: Sequence[str], keys: Sequence[str] = (),
                   descending: bool = False, bucket: Column | None = None,
                   maxima: Sequence[str] = ()) -> DataFrame:
    """Add ``<s>_upto`` (inclusive running total along ``order``) and ``<s>_all`` per key.

    ``(keys, order)`` must be unique and not null. ``bucket`` may give a cheaper range
    expression; it must not decrease as ``order`` grows. ``maxima`` adds running maxima.
    """
    order = [order] if isinstance(order, str) else list(order)
    keys = list(keys)
    if bucket is None:
        part = with_value_range(df, order[0], sums, "_range")
    else:
        part = df.withColumn("_range", bucket)
    totals = part.groupBy(*keys, "_range").agg(
        *[F.sum(s).alias(s) for s in sums], *[F.max(m).alias(m) for m in maxima]
    )
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    across = W.partitionBy(*keys).orderBy(direction("_range"))
    before = across.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    offsets = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_range").alias("_r"),
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_all") for s in sums],
        *[F.max(m).over(before).alias(f"_off_{m}") for m in maxima],
    )
    if not keys:
        offsets = F.broadcast(offsets)  # one row per value range
    match = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = W.partitionBy(*keys, "_range").orderBy(*[direction(o) for o in order]).rowsBetween(
        W.unboundedPreceding, 0)
    joined = part.join(offsets, match, "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_off_{s}") + F.sum(s).over(inside)).alias(f"{s}_upto") for s in sums],
        *[F.col(f"{s}_all") for s in sums],
        *[F.greatest(F.col(f"_off_{m}"), F.max(m).over(inside)).alias(f"{m}_upto") for m in maxima],
    )


def numbered(df: DataFrame, order: Sequence[str], bucket: Column, keys: Sequence[str] = (),
             out: str = "position") -> DataFrame:
    """``row_number`` from 1 per key along ``order``, plus ``<out>_of`` rows per key."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    run = running_totals(ones, order, ["_one"], keys, bucket=bucket)
    return run.select(*df.columns, F.col("_one_upto").alias(out), F.col("_one_all").alias(f"{out}_of"))


def with_written_range(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Action: add ``out``, a range index over any sortable columns (text included).

    Spark samples the range bounds, so the rows are written with their range once; whatever is
    recomputed later reads the same ranges.
    """
    spread = df.repartitionByRange(range_count(df), *order).withColumn(out, F.spark_partition_id())
    return materialize(spread, "ranges")


def value_ranks(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value: ``n`` rows, running count and the mean rank of its ties."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    run = running_totals(counts, value, ["n"], keys)
    return run.withColumn("mean_rank", F.col("n_upto") - F.col("n") + (F.col("n") + 1) / F.lit(2.0))


def quantiles(df: DataFrame, value: str, probabilities: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per key; columns named by the mapping."""
    ranks = value_ranks(df, value, keys)
    first = F.col("n_upto") - F.col("n")
    picks = []
    for name, q in probabilities.items():
        position = F.lit(float(q)) * (F.col("n_all") - 1)
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            held = (first <= at) & (at < F.col("n_upto"))
            picks.append(F.max(F.when(held, F.col(value).cast("double"))).alias(f"_{side}_{name}"))
    out = ranks.groupBy(*keys).agg(F.max("n_all").alias("_rows"), *picks)
    columns = []
    for name, q in probabilities.items():
        position = F.lit(float(q)) * (F.col("_rows") - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        columns.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return out.select(*keys, *columns)
