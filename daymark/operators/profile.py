"""Distribution, association and missingness profiles of tabular data."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.calendar import weekday
from daymark.functions.numeric import ratio
from daymark.functions.special import chi_square_tail, two_sided_normal
from daymark.operators.audit import category_counts
from daymark.operators.ordered import quantiles, running_totals


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep, column, value double) rows, nulls left out."""
    return df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ]))).where(F.col("value").isNotNull())


def monthly_profile(daily: DataFrame, day: str = "date", value: str = "trips") -> DataFrame:
    return daily.groupBy(F.date_trunc("month", day).cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("days"), F.sum(value).alias("total"), F.avg(value).alias("mean_per_day"))


def weekday_profile(daily: DataFrame, day: str = "date", value: str = "trips") -> DataFrame:
    """Days, mean, median and sample deviation per weekday; a group is bounded by the calendar."""
    return daily.groupBy(weekday(F.col(day)).cast("long").alias("weekday")).agg(
        F.count(F.lit(1)).alias("days"), F.avg(value).alias("mean"),
        F.percentile(F.col(value).cast("double"), 0.5).alias("median"), F.stddev_samp(value).alias("std"))


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max per column."""
    long = long_values(df, columns)
    basic = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    return basic.join(quantiles(long, "value", QUARTILES, ["column"]), "column")


def iqr_bounds(df: DataFrame, columns: Sequence[str], approximate: bool = False, reach: float = 1.5) -> DataFrame:
    """Per column: Q1 - 1.5 IQR and Q3 + 1.5 IQR. ``approximate`` takes one pass with a sketch."""
    long = long_values(df, columns)
    if approximate:
        q = long.groupBy("column").agg(*[F.percentile_approx("value", p, 10000).alias(n) for n, p in QUARTILES.items()])
    else:
        q = quantiles(long, "value", QUARTILES, ["column"])
    width = F.col("q3") - F.col("q1")
    return q.select("column", "median", (F.col("q1") - reach * width).alias("lower"),
                    (F.col("q3") + reach * width).alias("upper"))


def iqr_screen(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Bounds, flagged rows, their percent of the present values, and zeros. Nothing is deleted."""
    bounds = F.broadcast(iqr_bounds(df, columns, approximate))  # one row per listed column
    joined = long_values(df, columns).join(bounds, "column")
    flagged = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return joined.groupBy("column", "lower", "upper").agg(
        F.count(F.lit(1)).alias("present"), F.count_if(flagged).alias("flagged"),
        F.count_if(F.col("value") > F.col("upper")).alias("above"),
        F.count_if(F.col("value") == 0).alias("zeros"),
    ).withColumn("flagged_percent", F.lit(100.0) * F.col("flagged") / F.col("present"))


def iqr_flagged_rows(df: DataFrame, column: str) -> DataFrame:
    """The flagged rows themselves."""
    bounds = iqr_bounds(df, [column]).select(F.struct("lower", "upper")).scalar()
    return df.withColumn("_b", bounds).where(
        (F.col(column) < F.col("_b.lower")) | (F.col(column) > F.col("_b.upper"))).drop("_b")


def association(df: DataFrame, columns: Sequence[str], label: str = "label", missing: str = "missing",
                rare_below: int = 20, p_value: bool = True) -> DataFrame:
    """Chi-square of each category (nulls are a level) against a 0/1 label, and Cramer's V.

    The table is counted once for all columns; after that there is one row per level.
    """
    levels = df.select(F.col(label).alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias("level"),
                 F.col(c).isNull().alias("_null")) for c in columns])))
    cells = levels.groupBy("column", "level", "_null").agg(
        F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
    totals = F.broadcast(cells.groupBy("column").agg(
        F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg")))  # one row per listed column
    size = F.col("pos") + F.col("neg")
    n = F.col("all_pos") + F.col("all_neg")
    expected_pos = size * F.col("all_pos") / n
    expected_neg = size * F.col("all_neg") / n
    part = ratio(F.pow(F.col("pos") - expected_pos, 2), expected_pos) + ratio(
        F.pow(F.col("neg") - expected_neg, 2), expected_neg)
    out = cells.join(totals, "column").groupBy("column").agg(
        F.count(F.lit(1)).alias("table_levels"),
        F.count_if(~F.col("_null")).alias("categories"),
        F.count_if(~F.col("_null") & (size < rare_below)).alias("rare_categories"),
        F.sum(size).alias("rows"),
        F.sum(part).alias("chi2"),
    )
    out = out.withColumn("cramers_v", F.when(F.col("table_levels") > 1, F.sqrt(F.col("chi2") / F.col("rows"))))
    if p_value:
        out = out.withColumn("p_value", chi_square_tail("chi2", (F.col("table_levels") - 1).cast("double")))
    return out


def missingness_association(df: DataFrame, columns: Sequence[str], label: str = "label", p_value: bool = True) -> DataFrame:
    """Positive share when missing and when present, with the Yates-corrected 2x2 chi-square."""
    counts = df.agg(*[F.count_if(F.col(c).isNull() == gone).alias(f"_{i}_{int(gone)}") for i, c in enumerate(columns)
                      for gone in (True, False)],
                    *[F.count_if((F.col(c).isNull() == gone) & (F.col(label) == 1)).alias(f"_{i}_{int(gone)}p")
                      for i, c in enumerate(columns) for gone in (True, False)])
    long = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_{i}_1").alias("gone"), F.col(f"_{i}_1p").alias("gone_pos"),
                 F.col(f"_{i}_0").alias("here"), F.col(f"_{i}_0p").alias("here_pos")) for i, c in enumerate(columns)])))
    n = F.col("gone") + F.col("here")
    positives = F.col("gone_pos") + F.col("here_pos")
    chi2 = F.lit(0.0)
    for size, hit in (("gone", "gone_pos"), ("here", "here_pos")):
        for observed, total in ((F.col(hit), positives), (F.col(size) - F.col(hit), n - positives)):
            expected = F.col(size) * total / n
            off = F.abs(observed - expected)
            chi2 = chi2 + ratio(F.pow(off - F.least(F.lit(0.5), off), 2), expected)
    out = long.select(
        "column", (F.lit(100.0) * F.col("gone") / n).alias("missing_percent"),
        ratio(F.col("gone_pos"), F.col("gone")).alias("share_if_missing"),
        ratio(F.col("here_pos"), F.col("here")).alias("share_if_present"), chi2.alias("chi2"))
    if p_value:
        out = out.withColumn("p_value", chi_square_tail("chi2", F.lit(1.0)))
    return out


def mann_whitney(df: DataFrame, columns: Sequence[str], label: str = "label", p_value: bool = True) -> DataFrame:
    """U of the positive group with mean ranks for ties, z with tie and continuity corrections."""
    long = long_values(df, columns, [label])
    counts = long.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos"))
    run = running_totals(counts, "value", ["n", "pos"], ["column"])
    rank = F.col("n_upto") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    sums = run.groupBy("column").agg(
        F.max("n_all").alias("n"), F.max("pos_all").alias("n1"), F.sum(F.col("pos") * rank).alias("_r1"),
        F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("_ties"))
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    n2 = n - n1
    u1 = F.col("_r1") - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n2 / 12 * (n + 1 - ratio(F.col("_ties"), n * (n - 1))))
    out = sums.select("column", F.col("n1"), (F.col("n") - F.col("n1")).alias("n2"), u1.alias("u"),
                      ratio(F.greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5, spread).alias("z"))
    return out.withColumn("p_value", two_sided_normal("z")) if p_value else out


def group_medians(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    return quantiles(long_values(df, columns, [label]), "value", {"median": 0.5}, ["column", label])


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of every pair over the rows where both are present."""
    pairs = list(combinations(columns, 2))
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(a).cast("double").alias("x"),
                 F.col(b).cast("double").alias("y")) for a, b in pairs]))).dropna()
    cells = long.groupBy("first", "second", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    key = ["first", "second"]

    def ranks(side: str) -> DataFrame:
        by_value = cells.groupBy(*key, side).agg(F.sum("n").alias("n"))
        run = running_totals(by_value, side, ["n"], key)
        centred = F.col("n_upto") - F.col("n") + (F.col("n") + 1) / F.lit(2.0) - (F.col("n_all") + 1) / F.lit(2.0)
        return run.select(*key, side, centred.alias(f"_{side}"))

    both = cells.join(ranks("x"), [*key, "x"]).join(ranks("y"), [*key, "y"])
    n = F.col("n")
    sums = both.groupBy(*key).agg(
        F.sum("n").alias("rows"), F.sum(n * F.col("_x") * F.col("_y")).alias("_xy"),
        F.sum(n * F.col("_x") * F.col("_x")).alias("_xx"), F.sum(n * F.col("_y") * F.col("_y")).alias("_yy"))
    return sums.select(*key, "rows", ratio(F.col("_xy"), F.sqrt(F.col("_xx") * F.col("_yy"))).alias("rho"))


def shuffled_copy_test(df: DataFrame, original: str, copies: Sequence[str]) -> DataFrame:
    """Share of equal values where both are present against the chance of a match."""
    shares = df.where(F.col(original).isNotNull()).groupBy(original).agg(F.count(F.lit(1)).alias("n"))
    chance = shares.agg((F.sum(F.col("n") * F.col("n").cast("double")) /
                         F.pow(F.sum("n").cast("double"), 2)).alias("v")).scalar()
    one = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(original).isNotNull()).alias(f"_b{i}")
                   for i, c in enumerate(copies)],
                 *[F.count_if(F.col(c) == F.col(original)).alias(f"_e{i}") for i, c in enumerate(copies)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_b{i}").alias("both_present"),
                 ratio(F.col(f"_e{i}"), F.col(f"_b{i}")).alias("equal_share")) for i, c in enumerate(copies)
    ]))).withColumn("chance_share", chance)


def category_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of each level among the present values of its column."""
    counts = category_counts(df, columns, missing="\u0000").where(F.col("level") != "\u0000")
    totals = F.broadcast(counts.groupBy("column").agg(F.sum("rows").alias("_all")))  # one row per column
    return counts.join(totals, "column").select("column", "level", (F.col("rows") / F.col("_all")).alias("share"))


def input_schema_profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Observed range per number and one row per category, in long form so no list grows in a task."""
    numbers = df.agg(*[F.min(F.col(c).cast("double")).alias(f"_a{i}") for i, c in enumerate(numeric)],
                     *[F.max(F.col(c).cast("double")).alias(f"_b{i}") for i, c in enumerate(numeric)])
    ranges = numbers.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit("number").alias("kind"), F.lit(None).cast("string").alias("level"),
                 F.col(f"_a{i}").alias("observed_min"), F.col(f"_b{i}").alias("observed_max"))
        for i, c in enumerate(numeric)])))
    levels = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in categorical
    ]))).where(F.col("level").isNotNull()).distinct()
    return ranges.unionByName(levels.withColumn("kind", F.lit("category")), allowMissingColumns=True)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int, by: str) -> DataFrame:
    """Counts per equal-width bin and group; the last bin is closed and empty bins are kept."""
    width = (high - low) / bins
    value = F.col(column).cast("double")
    inside = (value >= low) & (value <= high)
    index = F.least(F.floor((value - low) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = df.where(inside).groupBy(by, index.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    spine = df.select(by).distinct().select(by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(counts, [by, "bin"], "left").select(
        by, F.col("bin").cast("long").alias("bin"), (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
        F.coalesce("rows", F.lit(0)).alias("rows"))


def complete_cases(df: DataFrame, columns: Sequence[str], joint: Column | None = None) -> DataFrame:
    """One row: rows, rows without a missing input, rows that meet a joint condition."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    out = [F.count(F.lit(1)).alias("rows"), F.count_if(whole).alias("complete_rows")]
    if joint is not None:
        out.append(F.count_if(joint).alias("joint_rows"))
    return df.agg(*out)


