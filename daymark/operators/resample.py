"""Bootstrap intervals. A replicate is one row, so the work spreads by replicate with no shuffle.

The resampled values are one bounded array (weeks or days of a calendar). Its circular prefix sums
are held as a scalar subquery, so the sum of a run or block of any length is one subtraction and a
replicate's work follows its runs, not its positions. Draws come from md5, four words a digest, so a rerun
or a lost executor gives the same replicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.draws import WIDTH


def _ordered_values(df: DataFrame, order: str, value: Column) -> Column:
    pairs = df.select(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.cast("double").alias("v")))).alias("p"))
    return pairs.select(F.transform("p", lambda x: x["v"])).scalar()


def _word(digest: Column, i: int) -> Column:
    """The i-th of the four 32-bit words of an md5."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def _bind(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _replicates(df: DataFrame, count: int, blocks: Sequence[int], values: Column, seed: str) -> DataFrame:
    """A row per (block, replicate): number of values ``_n``, sums ``_upto`` of the first 0 to 2n values of the
    ring, and the beginning ``_text`` of what is hashed."""
    ring = F.aggregate(
        F.concat(F.col("v"), F.col("v")), F.array(F.lit(0.0)), lambda sums, v: F.array_append(sums, F.element_at(sums, -1) + v))
    held = df.sparkSession.range(1).select(values.alias("v")).select(F.struct(F.size("v").alias("n"), ring.alias("upto"))).scalar()
    reps = df.sparkSession.range(count).select(
        F.col("id").alias("replicate"), F.explode(F.array(*[F.lit(int(b)) for b in blocks])).alias("block"))
    text = F.concat(F.lit(f"{seed}-"), F.col("block").cast("string"), F.lit("-"), F.col("replicate").cast("string"), F.lit("-"))
    return reps.withColumn("_held", held).select("block", "replicate", F.col("_held.n").alias("_n"), F.col("_held.upto").alias("_upto"), text.alias("_text"))


def _digest(position: Column) -> Column:
    return F.md5(F.concat(F.col("_text"), position.cast("string")))


def _stretch(first: Column, length: Column) -> Column:
    """Sum of ``length`` values of the ring from position ``first`` on."""
    return F.element_at("_upto", (first + length + 1).cast("int")) - F.element_at("_upto", (first + 1).cast("int"))


def stationary_draws(df: DataFrame, order: str, value: str, blocks: Sequence[int] = (2, 4, 6),
                     replicates: int = 20000, seed: str = "42") -> DataFrame:
    """Mean of each stationary-bootstrap replicate: geometric runs, circular continuation.

    A run has a uniform start and a length drawn by inversion; the last is cut where the replicate is full.
    One digest serves two runs.
    """
    reps = _replicates(df, replicates, blocks, _ordered_values(df, order, F.col(value)), seed)
    begin = F.struct(F.lit(0.0).alias("total"), F.col("_n").alias("left"))
    stay = F.ln(1 - 1 / F.col("block"))

    def run(state: Column, digest: Column, half: int) -> Column:
        first = F.pmod(_word(digest, 2 * half), F.col("_n").cast("long"))
        # Half a unit away from 0, 1 and every power of two, so that no rounding of a logarithm decides a length.
        share = (_word(digest, 2 * half + 1) + F.lit(0.5)) / F.lit(float(WIDTH))
        drawn = F.when(F.col("block") == 1, F.lit(1)).otherwise(F.least(F.floor(F.ln(share) / stay) + 1, F.col("_n")).cast("int"))
        return _bind(F.struct(first.alias("first"), F.least(state["left"], drawn).alias("n")), lambda r: F.struct(
            (state["total"] + _stretch(r["first"], r["n"])).alias("total"), (state["left"] - r["n"]).alias("left")))

    def two_runs(state: Column, position: Column) -> Column:
        both = _bind(_digest(position), lambda digest: _bind(run(state, digest, 0), lambda mid: run(mid, digest, 1)))
        return F.when(state["left"] <= 0, state).otherwise(both)

    long_enough = F.when(F.col("_n") >= 2 * F.col("block"), F.col("_n")).otherwise(
        F.raise_error(F.lit("too few observations for the block length")).cast("int"))
    reps = reps.withColumn("_n", long_enough)
    walked = reps.withColumn("_w", F.aggregate(F.sequence(F.lit(0), F.floor(F.col("_n") / 2).cast("int")), begin, two_runs))
    return walked.select("block", "replicate", (F.col("_w.total") / F.col("_n")).alias("draw"))


def stationary_bootstrap(df: DataFrame, order: str, value: str, blocks: Sequence[int] = (2, 4, 6),
                         replicates: int = 20000, seed: str = "42", confidence: float = 0.95) -> DataFrame:
    """Per block length: basic interval, standard error and centred two-sided p; plus stability."""
    if not 0 < confidence < 1 or min(blocks) < 1 or replicates < 1:
        raise ValueError("invalid confidence level, block length or replicate count")
    draws = stationary_draws(df, order, value, blocks, replicates, seed)
    point = df.select(F.avg(F.col(value).cast("double"))).scalar()
    tail = (1 - confidence) / 2
    per_block = draws.withColumn("_point", point).groupBy("block").agg(
        F.max("_point").alias("estimate"),
        F.percentile("draw", tail).alias("_low"), F.percentile("draw", 1 - tail).alias("_high"),
        F.stddev_samp("draw").alias("standard_error"),
        F.count_if(F.abs(F.col("draw") - F.col("_point")) >= F.abs("_point")).alias("extreme"))
    return per_block.select(
        F.col("block").cast("long").alias("block"), "estimate",
        (2 * F.col("estimate") - F.col("_high")).alias("ci_lower"),
        (2 * F.col("estimate") - F.col("_low")).alias("ci_upper"),
        "standard_error", "extreme",
        ((1 + F.col("extreme")) / F.lit(float(replicates + 1))).alias("p_value"))


def stable_direction(intervals: DataFrame) -> DataFrame:
    """One row: do all block lengths agree on the sign?"""
    return intervals.agg(
        (F.min("ci_lower") > 0).alias("stable_positive"), (F.max("ci_upper") < 0).alias("stable_negative"),
    ).withColumn("stable", F.col("stable_positive") | F.col("stable_negative"))


def paired_block_draws(df: DataFrame, order: str, difference: Column, blocks: Sequence[int] = (3, 7, 14),
                       replicates: int = 10000, seed: str = "42") -> DataFrame:
    """Mean difference over circular moving blocks; both models share each replicate's dates."""
    reps = _replicates(df, replicates, blocks, _ordered_values(df, order, difference), seed)
    needed = F.ceil(F.col("_n") / F.col("block")).cast("int")

    def four_blocks(total: Column, position: Column) -> Column:
        def add(digest: Column) -> Column:
            out = total
            for i in range(4):
                left = F.col("_n") - (position * 4 + i) * F.col("block")
                out = out + F.when(left <= 0, F.lit(0.0)).otherwise(block_sum(F.pmod(_word(digest, i), F.col("_n").cast("long")), left))
            return out

        def block_sum(first: Column, left: Column) -> Column:
            return _bind(first, lambda f: _stretch(f, F.least(F.col("block"), left)))

        return _bind(_digest(position), add)

    total = F.aggregate(F.sequence(F.lit(0), F.floor((needed - 1) / 4).cast("int")), F.lit(0.0), four_blocks)
    return reps.select("block", "replicate", (total / F.col("_n")).alias("draw"))


def paired_block_bootstrap(df: DataFrame, order: str, actual: str, candidate: str, control: str,
                           blocks: Sequence[int] = (3, 7, 14), replicates: int = 10000, seed: str = "42",
                           confidence: float = 0.95) -> DataFrame:
    """Percentile interval of MAE(candidate) - MAE(control) per block length."""
    gap = F.abs(F.col(candidate) - F.col(actual)) - F.abs(F.col(control) - F.col(actual))
    rows = df.select(order, gap.cast("double").alias("_gap"))
    draws = paired_block_draws(rows, order, F.col("_gap"), blocks, replicates, seed)
    tail = (1 - confidence) / 2
    return draws.withColumn("_point", rows.select(F.avg("_gap")).scalar()).groupBy(
        F.col("block").cast("long").alias("block")).agg(
        F.max("_point").alias("mae_difference"), F.percentile("draw", tail).alias("lower"),
        F.percentile("draw", 1 - tail).alias("upper"), F.count(F.lit(1)).alias("replicates"))
