"""Forecast and classification metrics, operating points and error slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.calendar import weekday
from daymark.functions.numeric import ratio
from daymark.operators.ordered import running_totals

# Fixed value: the next double above 1, so that nothing is flagged even when a score is 1.
NOTHING_FLAGGED = 1.0000000000000002
LOG_CLIP = 1e-7
GRID = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
RECALL_TARGETS = [0.80, 0.90, 0.95]
# Missing-count bins, open on the left and closed on the right.
MISSING_BINS = (("0-2", -1, 2), ("3-4", 2, 4), ("5-10", 4, 10))


def regression_aggregates(actual: str = "actual", predicted: str = "prediction") -> list[Column]:
    """Aggregate expressions for any ``agg``: mae, rmse, wape, bias and days."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return [
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        ratio(F.sum(F.abs(y - p)), F.sum(y)).alias("wape"),
        F.avg(p - y).alias("bias"),
        F.count(F.lit(1)).alias("days"),
    ]


def regression_metrics(df: DataFrame, keys: Sequence[str] = (), **names) -> DataFrame:
    return df.groupBy(*keys).agg(*regression_aggregates(**names))


def grouped_metrics(df: DataFrame, day: str = "date", **names) -> DataFrame:
    """The same metrics by weekday and by month, in one pass over grouping sets."""
    d = df.withColumns({"_weekday": weekday(F.col(day)), "_month": F.month(day)})
    sets = [[F.col("_weekday")], [F.col("_month")]]
    out = d.groupingSets(sets, F.col("_weekday"), F.col("_month")).agg(
        *regression_aggregates(**names), F.grouping("_weekday").alias("_g"))
    return out.select(
        F.when(F.col("_g") == 0, "weekday").otherwise("month").alias("group"),
        F.coalesce("_weekday", "_month").cast("long").alias("value"), "mae", "rmse", "wape", "bias", "days")


def classification_aggregates(cutoff: Column | float = 0.5, label: str = "label", score: str = "score") -> list[Column]:
    """tn, fp, fn, tp and everything derived from them, as aggregate expressions."""
    cutoff = F.lit(float(cutoff)) if not isinstance(cutoff, Column) else cutoff
    y, s = F.col(label), F.col(score).cast("double")
    flag = s >= cutoff
    tn, fp = F.count_if((y == 0) & ~flag), F.count_if((y == 0) & flag)
    fn, tp = F.count_if((y == 1) & ~flag), F.count_if((y == 1) & flag)
    clipped = F.least(F.lit(1 - LOG_CLIP), F.greatest(F.lit(LOG_CLIP), s))
    zero = F.lit(0.0)
    return [
        tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp"),
        ratio(tn + tp, F.count(F.lit(1))).alias("accuracy"),
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        ratio(tn, tn + fp).alias("specificity"),
        F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        ratio(fn, fn + tp).alias("false_negative_rate"),
        (-F.avg(F.when(y == 1, F.ln(clipped)).otherwise(F.ln(1 - clipped)))).alias("log_loss"),
    ]


def classification_metrics(df: DataFrame, cutoff: float = 0.5, keys: Sequence[str] = (), **names) -> DataFrame:
    return df.groupBy(*keys).agg(*classification_aggregates(cutoff, **names))


def score_counts(df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: rows and positives. Scores outside [0, 1] fail the job."""
    s = F.col(score).cast("double")
    checked = F.when(s.between(0.0, 1.0), s).otherwise(F.raise_error(F.lit("score is not in [0, 1]")).cast("double"))
    return df.groupBy(*keys, checked.alias("threshold")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos"))


def threshold_table(df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """Every operating point: equal scores move together, and one point flags nothing."""
    run = running_totals(score_counts(df, label, score, keys), "threshold", ["n", "pos"], keys, descending=True)
    tp, fp = F.col("pos_upto"), F.col("n_upto") - F.col("pos_upto")
    top = F.col("n_upto") == F.col("n")
    here = F.struct(F.col("threshold"), tp.alias("tp"), fp.alias("fp"))
    nothing = F.struct(F.lit(NOTHING_FLAGGED).alias("threshold"), F.lit(0).cast("long").alias("tp"),
                       F.lit(0).cast("long").alias("fp"))
    points = run.select(*keys, F.col("pos_all").alias("positive"), (F.col("n_all") - F.col("pos_all")).alias("negative"),
                        F.inline(F.when(top, F.array(nothing, here)).otherwise(F.array(here))))
    tp, fp, positive, negative = F.col("tp"), F.col("fp"), F.col("positive"), F.col("negative")
    return points.select(
        *keys, "threshold", (negative - fp).alias("tn"), fp, (positive - tp).alias("fn"), tp,
        F.coalesce(ratio(tp, tp + fp), F.lit(0.0)).alias("precision"),
        ratio(tp, positive).alias("recall"), ratio(negative - fp, negative).alias("specificity"),
        ratio(2 * tp, positive + tp + fp).alias("f1"))


def _per_target(table: DataFrame, targets: Sequence[float], best, keys: Sequence[str]) -> DataFrame:
    picks = table.groupBy(*keys).agg(*[best(F.col("recall") >= F.lit(t)).alias(f"_t{i}") for i, t in enumerate(targets)])
    return picks.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(float(t)).alias("target"), F.col(f"_t{i}.threshold").alias("threshold"),
                 F.col(f"_t{i}.specificity").alias("specificity"), F.col(f"_t{i}.precision").alias("precision"),
                 F.col(f"_t{i}.recall").alias("recall")) for i, t in enumerate(targets)])))


def _check_targets(targets: Sequence[float]) -> None:
    if not all(0 < t <= 1 for t in targets):
        raise ValueError("recall targets must lie in (0, 1]")


def select_cutoff(table: DataFrame, targets: Sequence[float] = (0.9,), keys: Sequence[str] = ()) -> DataFrame:
    """Highest specificity with recall at or above each target; ties take the largest cutoff."""
    _check_targets(targets)
    best = lambda ok: F.max(F.when(ok, F.struct("specificity", "threshold", "precision", "recall")))
    return _per_target(table, targets, best, keys)


def select_cutoff_precision(table: DataFrame, targets: Sequence[float] = (0.9,), keys: Sequence[str] = ()) -> DataFrame:
    """Highest precision with recall at or above each target; ties take the lowest cutoff."""
    _check_targets(targets)
    real = table.where(F.col("threshold") <= 1.0)
    best = lambda ok: F.max_by(
        F.struct("threshold", "specificity", "precision", "recall"),
        F.when(ok, F.struct(F.col("precision"), (-F.col("threshold")).alias("t"))))
    return _per_target(real, targets, best, keys)


def select_cutoff_fpr(table: DataFrame, targets: Sequence[float] = (0.9,), keys: Sequence[str] = ()) -> DataFrame:
    """First point (from the highest cutoff) of least false alarms among those at the target."""
    best = lambda ok: F.max_by(
        F.struct("threshold", "specificity", "precision", "recall"),
        F.when(ok, F.struct((-F.col("fp")).alias("a"), F.col("threshold").alias("t"))))
    return _per_target(table, targets, best, keys)


def ranking_metrics(df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """Average precision (sum of recall steps times precision) and ROC AUC with half credit for ties."""
    return counted_ranking(score_counts(df, label, score, keys), keys)


def counted_ranking(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """:func:`ranking_metrics` of rows counted per score, as :func:`score_counts` returns them."""
    run = running_totals(counts, "threshold", ["n", "pos"], keys, descending=True)
    pos, neg = F.col("pos").cast("double"), (F.col("n") - F.col("pos")).cast("double")
    higher_pos = (F.col("pos_upto") - F.col("pos")).cast("double")
    sums = run.groupBy(*keys).agg(
        F.max("pos_all").alias("_p"), F.max(F.col("n_all") - F.col("pos_all")).alias("_q"),
        F.sum(pos * F.col("pos_upto") / F.col("n_upto")).alias("_ap"),
        F.sum(neg * (higher_pos + pos / 2)).alias("_auc"))
    return sums.select(*keys, ratio(F.col("_ap"), F.col("_p")).alias("average_precision"),
                       ratio(F.col("_auc"), F.col("_p").cast("double") * F.col("_q")).alias("roc_auc"))


def tradeoff_grid(df: DataFrame, label: str = "label", score: str = "score", grid: Sequence[float] = GRID,
                  targets: Sequence[float] = RECALL_TARGETS) -> DataFrame:
    """Metrics at fixed cutoffs and at the cutoffs chosen for each recall target.

    A row is counted once per score; each cutoff is then a conditional sum over the scores.
    """
    counts = score_counts(df, label, score)
    n, pos = F.col("n"), F.col("pos")
    chosen = select_cutoff(threshold_table(df, label, score), targets).select(
        F.collect_list(F.struct("target", "threshold"))).scalar()
    fixed = F.array(*[F.struct(F.lit("fixed grid").alias("selection"), F.lit(None).cast("double").alias("target"),
                               F.lit(float(t)).alias("cutoff")) for t in grid])
    # len(grid) + len(targets) cutoffs, a constant of the report.
    cutoffs = F.concat(fixed, F.transform("_chosen", lambda c: F.struct(
        F.lit("recall target").alias("selection"), c["target"].alias("target"), c["threshold"].alias("cutoff"))))
    rows = counts.withColumn("_chosen", chosen).select("threshold", "n", "pos", F.inline(cutoffs))
    flag = F.col("threshold") >= F.col("cutoff")
    tp = F.sum(F.when(flag, pos).otherwise(0))
    fp = F.sum(F.when(flag, n - pos).otherwise(0))
    fn = F.sum(F.when(flag, 0).otherwise(pos))
    tn = F.sum(F.when(flag, 0).otherwise(n - pos))
    return rows.groupBy("selection", "target", "cutoff").agg(
        tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp"),
        ratio(tn + tp, F.sum(n)).alias("accuracy"),
        F.coalesce(ratio(tp, tp + fp), F.lit(0.0)).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(tn, tn + fp).alias("specificity"))


def fold_summary(folds: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation over folds."""
    out = []
    for c in columns:
        out += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return folds.groupBy(*keys).agg(F.count(F.lit(1)).alias("folds"), *out)


def paired_folds(candidate: DataFrame, baseline: DataFrame, metric: str, on: str = "fold") -> DataFrame:
    """Candidate minus baseline per fold."""
    b = baseline.select(on, F.col(metric).alias("baseline"))
    return candidate.select(on, F.col(metric).alias("candidate")).join(b, on).withColumn(
        "difference", F.col("candidate") - F.col("baseline"))


def paired_summary(pairs: DataFrame, higher_is_better: bool = True) -> DataFrame:
    win = F.col("difference") > 0 if higher_is_better else F.col("difference") < 0
    return pairs.agg(F.count(F.lit(1)).alias("folds"), F.count_if(win).alias("wins"),
                     F.avg("difference").alias("mean_difference"))


def error_slices(df: DataFrame, label: str = "label", predicted: str = "predicted",
                 missing: str = "missing_feature_count") -> DataFrame:
    """Misses and false alarms by how many inputs are missing. Empty bins stay; rates may be null."""
    index = F.coalesce(*[F.when((F.col(missing) > low) & (F.col(missing) <= high), F.lit(i))
                         for i, (_, low, high) in enumerate(MISSING_BINS)])
    y, p = F.col(label), F.col(predicted)
    counts = df.groupBy(index.alias("_bin")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("positive_n"), F.count_if(y == 0).alias("negative_n"),
        F.count_if((y == 1) & (p == 0)).alias("false_negatives"),
        F.count_if((y == 0) & (p == 1)).alias("false_positives"))
    spine = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("_bin"), F.lit(name).alias("missing_features")) for i, (name, _, _) in enumerate(MISSING_BINS)])))
    measures = ["n", "positive_n", "negative_n", "false_negatives", "false_positives"]
    filled = spine.join(counts, "_bin", "left").select(
        "missing_features", *[F.coalesce(c, F.lit(0)).alias(c) for c in measures])
    return filled.withColumns({
        "false_negative_rate": ratio(F.col("false_negatives"), F.col("positive_n")),
        "false_positive_rate": ratio(F.col("false_positives"), F.col("negative_n")),
    })


def trial_board(trials: DataFrame, learner: str = "learner", loss: str = "loss") -> DataFrame:
    return trials.where(F.col(learner).isNotNull()).groupBy(learner).agg(
        F.count(F.lit(1)).alias("trials"), F.min(loss).alias("best_loss"))


def confident_contradictions(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives scored below 0.1 and negatives scored above 0.9. No label is changed."""
    return df.agg(
        F.count_if((F.col(label) == 1) & (F.col(score) < 0.1)).alias("positive_but_low"),
        F.count_if((F.col(label) == 0) & (F.col(score) > 0.9)).alias("negative_but_high"))


def extreme_rows(df: DataFrame, by: Column, k: int, largest: bool, tie: Sequence[str]) -> DataFrame:
    """The ``k`` largest or smallest rows with all their columns."""
    return df.orderBy(by.desc() if largest else by.asc(), *tie).limit(k)


def leaderboard(results: DataFrame, baseline: str = "lag_7", model: str = "model", loss: str = "mae") -> DataFrame:
    """Models by loss then name, with the improvement over the baseline model."""
    reference = results.where(F.col(model) == baseline).select(F.max(loss)).scalar()
    return results.withColumn("_base", reference).withColumn(
        "improvement", 1 - F.col(loss) / F.col("_base")).drop("_base").orderBy(loss, model)
