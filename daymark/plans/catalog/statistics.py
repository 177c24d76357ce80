"""Profiles, metrics, operating points and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.functions.numeric import r6
from daymark.functions.special import clopper_pearson
from daymark.operators import history, joins, profile, resample, scoring, weekly
from daymark.plans import bindings as b
from daymark.plans.catalog.features import FRAME, LAGGED, WEEKS, r, rounded, rs
from daymark.plans.registry import query

MONEY = ["c_acctbal", "c_nationkey"]
SIZES = ["size", "price", "width"]


def _union(parts):
    return " union all ".join(parts)


@query("a12_monthly_profile", f"""
with {b.DAILY}, x as (select cast(date_trunc('month', date) as date) as month, count(*) as days, cast(sum(trips) as bigint) as total, avg(trips) as m from daily group by 1)
select month, days, total, {r('m', 'mean_per_day')} from x
""")
def _(spark, d):
    return rounded(profile.monthly_profile(b.daily_shipments(spark, d)), skip=())


@query("a12_weekday_profile", f"""
with {b.DAILY}, x as (select cast(isodow(date) - 1 as bigint) as weekday, count(*) as days, avg(trips) as mean, quantile_cont(trips, 0.5) as median, stddev_samp(trips) as std from daily group by 1)
select weekday, days, {rs('mean', 'median', 'std')} from x
""")
def _(spark, d):
    return rounded(profile.weekday_profile(b.daily_shipments(spark, d)), skip=())


@query("a13_describe", f"with {b.PARTS} " + _union(
    f"select '{c}' as \"column\", count({c}) as count, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')}, min({c}) as min, "
    f"{r(f'quantile_cont({c}, 0.25)', 'q1')}, {r(f'quantile_cont({c}, 0.5)', 'median')}, {r(f'quantile_cont({c}, 0.75)', 'q3')}, max({c}) as max from parts" for c in SIZES))
def _(spark, d):
    return rounded(profile.describe(b.incomplete(spark, d), SIZES), skip=())


@query("a14_iqr_screen", _union(
    f"select '{c}' as \"column\", {r('lower')}, {r('upper')}, count(*) as present, count(*) filter (where v < lower or v > upper) as flagged, count(*) filter (where v > upper) as above, "
    f"count(*) filter (where v = 0) as zeros, {r('100.0 * count(*) filter (where v < lower or v > upper) / count(*)', 'flagged_percent')} from (select cast({c} as double) as v from customer), "
    f"(select q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from (select quantile_cont(cast({c} as double), 0.25) as q1, quantile_cont(cast({c} as double), 0.75) as q3 from customer)) group by lower, upper"
    for c in MONEY))
def _(spark, d):
    return rounded(profile.iqr_screen(b.table(spark, d, "customer"), MONEY), skip=())


@query("a14_iqr_flagged_rows", """
with n as (select l_orderkey, count(*) as lines from lineitem group by 1), q as (select quantile_cont(lines, 0.25) as q1, quantile_cont(lines, 0.75) as q3 from n)
select l_orderkey, lines from n, q where lines < q1 - 1.5 * (q3 - q1) or lines > q3 + 1.5 * (q3 - q1)
""")
def _(spark, d):
    orders = b.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return profile.iqr_flagged_rows(orders, "lines")


_KINDS = ["brand", "kind", "noise_0"]


def _chi(c):
    return (f"select '{c}' as \"column\", count(*) as table_levels, count(*) filter (where not gone) as categories, count(*) filter (where not gone and n < 20) as rare_categories, "
            f"cast(sum(n) as bigint) as rows, {r('sum(x)', 'chi2')}, {r('sqrt(sum(x) / sum(n))', 'cramers_v')} from ("
            f"select gone, n, (pos - n * p / t) * (pos - n * p / t) / (n * p / t) + (neg - n * q / t) * (neg - n * q / t) / (n * q / t) as x from ("
            f"select {c} is null as gone, cast(count(*) as double) as n, count(*) filter (where class = 'p') as pos, count(*) filter (where class = 'e') as neg from parts group by {c}), "
            f"(select cast(count(*) as double) as t, count(*) filter (where class = 'p') as p, count(*) filter (where class = 'e') as q from parts))")


@query("a15_association", f"with {b.PARTS} " + _union(_chi(c) for c in _KINDS))
def _(spark, d):
    rows = b.incomplete(spark, d).withColumn("label", (F.col("class") == "p").cast("int"))
    return rounded(profile.association(rows, _KINDS, p_value=False), skip=())


@query("a15_association_p_values")
def _(spark, d):
    rows = b.incomplete(spark, d).withColumn("label", (F.col("class") == "p").cast("int"))
    return profile.association(rows, _KINDS)


def _yates(c):
    cells = " + ".join(f"pow(abs({o} - {n} * {t} / (g + h)) - least(0.5, abs({o} - {n} * {t} / (g + h))), 2) / nullif({n} * {t} / (g + h), 0)"
                       for o, n, t in (("gp", "g", "(gp + hp)"), ("(g - gp)", "g", "(g + h - gp - hp)"), ("hp", "h", "(gp + hp)"), ("(h - hp)", "h", "(g + h - gp - hp)")))
    return (f"select '{c}' as \"column\", {r('100.0 * g / (g + h)', 'missing_percent')}, {r('gp / nullif(g, 0)', 'share_if_missing')}, {r('hp / nullif(h, 0)', 'share_if_present')}, {r(cells, 'chi2')} "
            f"from (select cast(count(*) filter (where {c} is null) as double) as g, cast(count(*) filter (where {c} is null and class = 'p') as double) as gp, "
            f"cast(count({c}) as double) as h, cast(count(*) filter (where {c} is not null and class = 'p') as double) as hp from parts)")


@query("a16_missingness_association", f"with {b.PARTS} " + _union(_yates(c) for c in SIZES + _KINDS))
def _(spark, d):
    rows = b.incomplete(spark, d).withColumn("label", (F.col("class") == "p").cast("int"))
    return rounded(profile.missingness_association(rows, SIZES + _KINDS, p_value=False), skip=())


@query("a17_mann_whitney", f"""
with {b.SCORED}, v as (select label, cast(n_chars as double) as v from scored), c as (select v, count(*) as n, count(*) filter (where label = 1) as pos from v group by 1),
 k as (select *, sum(n) over (order by v) - n + (n + 1) / cast(2 as double) as rnk from c), s as (select cast(sum(n) as double) as n, cast(sum(pos) as double) as n1, sum(pos * rnk) as r1,
 sum(pow(cast(n as double), 3) - n) as ties from k), u as (select *, n - n1 as n2, r1 - n1 * (n1 + 1) / 2 as u from s)
select 'n_chars' as "column", cast(n1 as bigint) as n1, cast(n2 as bigint) as n2, {r('u')},
 {r('(greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))', 'z')} from u
""")
def _(spark, d):
    return rounded(profile.mann_whitney(b.scored(spark, d), ["n_chars"], p_value=False), skip=())


@query("a17_group_medians", f"with {b.PARTS} " + _union(
    f"select '{c}' as \"column\", class, {r(f'quantile_cont({c}, 0.5)', 'median')} from parts group by class" for c in SIZES))
def _(spark, d):
    return rounded(profile.group_medians(b.incomplete(spark, d), SIZES, "class"), skip=())


def _rho(a, c):
    return (f"select '{a}' as first, '{c}' as second, count(*) as rows, {r('corr(x, y)', 'rho')} from ("
            f"select avg(i) over (partition by {a}) as x, avg(j) over (partition by {c}) as y from ("
            f"select {a}, {c}, row_number() over (order by {a}) as i, row_number() over (order by {c}) as j from parts where {a} is not null and {c} is not null))")


@query("a18_spearman_matrix", f"with {b.PARTS} " + _union([_rho("size", "price"), _rho("size", "width"), _rho("price", "width")]))
def _(spark, d):
    return rounded(profile.spearman_matrix(b.incomplete(spark, d), SIZES), skip=())


@query("a19_shuffled_copy_test", f"""
with {b.PARTS}, s as (select sum(n * cast(n as double)) / pow(sum(n), 2) as chance from (select count(*) as n from parts where brand is not null group by brand))
select 'noise_0' as "column", count(*) filter (where brand is not null and noise_0 is not null) as both_present,
 {r('count(*) filter (where brand = noise_0) / cast(count(*) filter (where brand is not null and noise_0 is not null) as double)', 'equal_share')}, {r('any_value(chance)', 'chance_share')} from parts, s
""")
def _(spark, d):
    return rounded(profile.shuffled_copy_test(b.incomplete(spark, d), "brand", ["noise_0"]), skip=())


@query("a19_category_shares", f"with {b.PARTS} " + _union(
    f"select '{c}' as \"column\", {c} as level, {r(f'count(*) / cast(sum(count(*)) over () as double)', 'share')} from parts where {c} is not null group by {c}" for c in ("brand", "noise_0")))
def _(spark, d):
    return rounded(profile.category_shares(b.incomplete(spark, d), ["brand", "noise_0"]), skip=())


@query("a26_input_schema_profile", f"with {b.PARTS} " + _union(
    [f"select '{c}' as \"column\", 'number' as kind, null as level, min({c}) as observed_min, max({c}) as observed_max from parts" for c in SIZES]
    + [f"select distinct '{c}', 'category', {c}, cast(null as double), cast(null as double) from parts where {c} is not null" for c in b.CATEGORICAL]))
def _(spark, d):
    return profile.input_schema_profile(b.incomplete(spark, d), SIZES, b.CATEGORICAL)


@query("a31_histogram", f"""
with {b.SCORED}, c as (select label, least(cast(floor((score - 0.0) / cast(0.04 as double)) as integer), 24) as bin, count(*) as n from scored where score between 0 and 1 group by 1, 2)
select s.label, cast(s.bin as bigint) as bin, {r('s.bin * cast(0.04 as double)', 'bin_start')}, coalesce(n, 0) as rows
from (select label, unnest(generate_series(0, 24)) as bin from (select distinct label from scored)) s left join c on c.label = s.label and c.bin = s.bin
""")
def _(spark, d):
    return profile.histogram(b.scored(spark, d), "score", 0.0, 1.0, 25, "label").withColumn("bin_start", r6("bin_start"))


@query("a32_complete_cases", f"""
with {b.PARTS} select count(*) as rows, count(*) filter (where size is not null and price is not null and width is not null and brand is not null and kind is not null) as complete_rows,
 count(*) filter (where width = 0 and size > 10) as joint_rows from parts
""")
def _(spark, d):
    return profile.complete_cases(b.incomplete(spark, d), b.NUMERIC + b.CATEGORICAL, (F.col("width") == 0) & (F.col("size") > 10))


# Forecast metrics -----------------------------------------------------------------------

NAIVE = f"{LAGGED}, naive as (select date, cast(trips as double) as actual, cast(lag_7 as double) as prediction, cast(lag_1 as double) as other from lagged where lag_7 is not null)"
METRICS = "avg(abs(actual - prediction)) as mae, sqrt(avg(pow(actual - prediction, 2))) as rmse, sum(abs(actual - prediction)) / nullif(sum(actual), 0) as wape, avg(prediction - actual) as bias, count(*) as days"
MEASURES = rs("mae", "rmse", "wape", "bias")


def naive(spark, d):
    return history.lags(b.daily_shipments(spark, d), [1, 7]).where("lag_7 is not null").select(
        "date", F.col("trips").cast("double").alias("actual"), F.col("lag_7").cast("double").alias("prediction"),
        F.col("lag_1").cast("double").alias("other"))


@query("a20_regression_metrics", f"with {NAIVE}, m as (select {METRICS} from naive) select {MEASURES}, days from m")
def _(spark, d):
    return rounded(scoring.regression_metrics(naive(spark, d)), skip=())


@query("a21_grouped_metrics", f"""
with {NAIVE}, m as (select 'weekday' as "group", cast(isodow(date) - 1 as bigint) as value, {METRICS} from naive group by 2
 union all select 'month', cast(month(date) as bigint), {METRICS} from naive group by 2) select "group", value, {MEASURES}, days from m
""")
def _(spark, d):
    return rounded(scoring.grouped_metrics(naive(spark, d)), skip=())


@query("t1_largest_errors", f"with {NAIVE} select date, actual, prediction, abs(actual - prediction) as absolute_error from naive order by 4 desc, date limit 10")
def _(spark, d):
    n = naive(spark, d).drop("other").withColumn("absolute_error", F.abs(F.col("actual") - F.col("prediction")))
    return scoring.extreme_rows(n, F.col("absolute_error"), 10, True, ["date"])


@query("t1_extreme_days", f"""
with {b.DAILY} select * from (select date, trips, 'low' as end from daily order by trips, date limit 5) union all select * from (select date, trips, 'high' as end from daily order by trips desc, date limit 5)
""")
def _(spark, d):
    daily = b.daily_shipments(spark, d).drop("series")
    low, high = (scoring.extreme_rows(daily, F.col("trips"), 5, big, ["date"]).withColumn("end", F.lit(end)) for big, end in ((False, "low"), (True, "high")))
    return low.unionByName(high)


KINDS = ("lag_1", "lag_7", "mean_7", "mean_28")
BOARD = f"{FRAME}, results as (" + _union(
    f"select '{k}' as model, {METRICS.replace('prediction', k).replace('actual', 'trips')} from frame where lag_28 is not null" for k in KINDS) + ")"


def board(spark, d):
    f = history.past_statistics(history.lags(b.daily_shipments(spark, d), (1, 7, 28)), (7, 28), kinds=("mean",)).where("lag_28 is not null")
    long = f.select(F.col("trips").alias("actual"), F.inline(F.array(*[
        F.struct(F.lit(k).alias("model"), F.col(k).cast("double").alias("prediction")) for k in KINDS])))
    return scoring.regression_metrics(long, ["model"])


@query("t2_leaderboard", f"""
with {BOARD} select model, {MEASURES}, days, {r("1 - mae / (select mae from results where model = 'lag_7')", 'improvement')} from results
""")
def _(spark, d):
    return rounded(scoring.leaderboard(board(spark, d)), skip=())


@query("a27_trial_board", f"""
with {BOARD} select split_part(model, '_', 1) as learner, count(*) as trials, {r('min(mae)', 'best_loss')} from results group by 1
""")
def _(spark, d):
    trials = board(spark, d).select(F.element_at(F.split("model", "_"), 1).alias("learner"), F.col("mae").alias("loss"))
    return rounded(scoring.trial_board(trials), skip=())


YEARS = f"{NAIVE}, folds as (select cast(year(date) as bigint) as fold, avg(abs(actual - prediction)) as mae, avg(abs(actual - other)) as other_mae from naive group by 1)"


@query("a24_paired_folds", f"with {YEARS} select fold, {r('mae', 'baseline')}, {r('other_mae', 'candidate')}, {r('other_mae - mae', 'difference')} from folds")
def _(spark, d):
    return rounded(_pairs(spark, d), skip=())


def _pairs(spark, d):
    n = naive(spark, d).withColumn("fold", F.year("date").cast("long"))
    base = scoring.regression_metrics(n, ["fold"])
    return scoring.paired_folds(scoring.regression_metrics(n, ["fold"], predicted="other"), base, "mae")


@query("a24_paired_summary", f"""
with {YEARS} select count(*) as folds, count(*) filter (where other_mae < mae) as wins, {r('avg(other_mae - mae)', 'mean_difference')} from folds
""")
def _(spark, d):
    return rounded(scoring.paired_summary(_pairs(spark, d), higher_is_better=False), skip=())


# Classification metrics -----------------------------------------------------------------

CONFUSION = """count(*) filter (where label = 0 and score < c) as tn, count(*) filter (where label = 0 and score >= c) as fp,
 count(*) filter (where label = 1 and score < c) as fn, count(*) filter (where label = 1 and score >= c) as tp"""
RATES = f"""{r('(tn + tp) / cast(tn + fp + fn + tp as double)', 'accuracy')}, {r('coalesce(tp / nullif(cast(tp + fp as double), 0), 0)', 'precision')},
 {r('coalesce(tp / nullif(cast(tp + fn as double), 0), 0)', 'recall')}, {r('tn / nullif(cast(tn + fp as double), 0)', 'specificity')}"""


@query("a22_classification_metrics", f"""
with {b.SCORED}, m as (select {CONFUSION.replace(' c)', ' 0.5)')}, -avg(case when label = 1 then ln(least(1 - 1e-7, greatest(1e-7, score))) else ln(1 - least(1 - 1e-7, greatest(1e-7, score))) end) as ll from scored)
select tn, fp, fn, tp, {RATES}, {r('coalesce(2 * tp / nullif(cast(2 * tp + fp + fn as double), 0), 0)', 'f1')}, {r('fn / nullif(cast(fn + tp as double), 0)', 'false_negative_rate')}, {r('ll', 'log_loss')} from m
""")
def _(spark, d):
    return rounded(scoring.classification_metrics(b.scored(spark, d), 0.5), skip=())


FOLDS = """f as (select *, cast(row_id % 5 as bigint) as fold from scored)"""


@query("a23_fold_summary", f"""
with {b.SCORED}, {FOLDS}, m as (select fold, avg(cast((score >= 0.5) = (label = 1) as integer)) as accuracy, avg(score) as mean_score from f group by 1)
select count(*) as folds, {r('avg(accuracy)', 'accuracy_mean')}, {r('stddev_pop(accuracy)', 'accuracy_std')}, {r('avg(mean_score)', 'mean_score_mean')}, {r('stddev_pop(mean_score)', 'mean_score_std')} from m
""")
def _(spark, d):
    rows = b.scored(spark, d).withColumn("fold", F.col("row_id") % 5)
    folds = scoring.classification_metrics(rows, 0.5, ["fold"]).select("fold", "accuracy").join(
        rows.groupBy("fold").agg(F.avg("score").alias("mean_score")), "fold")
    return rounded(scoring.fold_summary(folds, ["accuracy", "mean_score"]), skip=())


@query("a25_error_slices", f"""
with {b.SCORED}, p as (select *, cast(score >= 0.5 as integer) as predicted, case when missing_feature_count <= 2 then '0-2' when missing_feature_count <= 4 then '3-4' else '5-10' end as bin from scored),
 c as (select bin, count(*) as n, count(*) filter (where label = 1) as positive_n, count(*) filter (where label = 0) as negative_n,
 count(*) filter (where label = 1 and predicted = 0) as false_negatives, count(*) filter (where label = 0 and predicted = 1) as false_positives from p group by 1)
select bin as missing_features, n, positive_n, negative_n, false_negatives, false_positives, {r('false_negatives / nullif(cast(positive_n as double), 0)', 'false_negative_rate')},
 {r('false_positives / nullif(cast(negative_n as double), 0)', 'false_positive_rate')} from c
""")
def _(spark, d):
    return rounded(scoring.error_slices(b.scored(spark, d).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))), skip=())


CURVE = f"""{b.SCORED}, sc as (select score as threshold, count(*) as n, count(*) filter (where label = 1) as pos from scored group by 1),
 tot as (select cast(sum(n) as bigint) as n, cast(sum(pos) as bigint) as p from sc),
 run as (select threshold, cast(sum(pos) over w as bigint) as tp, cast(sum(n - pos) over w as bigint) as fp from sc window w as (order by threshold desc)
  union all select cast(1.0000000000000002 as double), 0, 0),
 curve as (select threshold, n - p - fp as tn, fp, p - tp as fn, tp, coalesce(tp / nullif(cast(tp + fp as double), 0), 0) as precision, tp / cast(p as double) as recall,
  (n - p - fp) / cast(n - p as double) as specificity, 2 * tp / cast(p + tp + fp as double) as f1 from run, tot)"""


@query("w12_threshold_table", f"with {CURVE} select {rs('threshold', 'precision', 'recall', 'specificity', 'f1')}, tn, fp, fn, tp from curve")
def _(spark, d):
    return rounded(scoring.threshold_table(b.scored(spark, d)), skip=())


def _pick(order, extra=""):
    return _union(f"select * from (select cast({t} as double) as target, {rs('threshold', 'specificity', 'precision', 'recall')} from curve where recall >= {t} {extra} order by {order} limit 1)"
                  for t in (0.8, 0.9, 0.95, 1.0))


TARGETS = (0.8, 0.9, 0.95, 1.0)


@query("w13_select_cutoff", f"with {CURVE} " + _pick("curve.specificity desc, curve.threshold desc"))
def _(spark, d):
    return rounded(scoring.select_cutoff(scoring.threshold_table(b.scored(spark, d)), TARGETS), skip=())


@query("w14_select_cutoff_precision", f"with {CURVE} " + _pick("curve.precision desc, curve.threshold", "and threshold <= 1"))
def _(spark, d):
    return rounded(scoring.select_cutoff_precision(scoring.threshold_table(b.scored(spark, d)), TARGETS), skip=())


@query("w15_select_cutoff_fpr", f"with {CURVE} " + _pick("curve.fp, curve.threshold desc"))
def _(spark, d):
    return rounded(scoring.select_cutoff_fpr(scoring.threshold_table(b.scored(spark, d)), TARGETS), skip=())


@query("w16_ranking_metrics", f"""
with {b.SCORED}, sc as (select score, count(*) as n, count(*) filter (where label = 1) as pos from scored group by 1),
 k as (select *, sum(pos) over w as up, sum(n) over w as un from sc window w as (order by score desc)), t as (select cast(sum(pos) as double) as p, cast(sum(n - pos) as double) as q,
 sum(cast(pos as double) * up / un) as ap, sum(cast(n - pos as double) * (up - pos + pos / cast(2 as double))) as auc from k)
select {r('ap / p', 'average_precision')}, {r('auc / (p * q)', 'roc_auc')} from t
""")
def _(spark, d):
    return rounded(scoring.ranking_metrics(b.scored(spark, d)), skip=())


@query("a28_tradeoff_grid", f"""
with {CURVE}, cuts as (select 'fixed grid' as selection, cast(null as double) as target, cast(i as double) / 10 as c from (select unnest(generate_series(0, 10)) as i) union all
 select 'recall target', target, threshold from ({_union(f"select * from (select cast({t} as double) as target, threshold from curve where recall >= {t} order by specificity desc, threshold desc limit 1)" for t in (0.8, 0.9, 0.95))})),
 m as (select selection, target, c, {CONFUSION} from scored, cuts group by 1, 2, 3)
select selection, target, {r('c', 'cutoff')}, tn, fp, fn, tp, {RATES} from m
""")
def _(spark, d):
    return rounded(scoring.tradeoff_grid(b.scored(spark, d)), skip=())


@query("a30_confident_contradictions", f"""
with {b.SCORED} select count(*) filter (where label = 1 and score < 0.1) as positive_but_low, count(*) filter (where label = 0 and score > 0.9) as negative_but_high from scored
""")
def _(spark, d):
    return scoring.confident_contradictions(b.scored(spark, d))


@query("j9_largest_mistakes", f"""
with {b.SCORED}, e as (select * from (select row_id, label, score, 'false_negative' as error_type from scored where label = 1 and score < 0.5 order by score, row_id limit 3) union all
 select * from (select row_id, label, score, 'false_positive' from scored where label = 0 and score >= 0.5 order by score desc, row_id limit 3))
select e.row_id, e.label, {r('score')}, error_type, d.lang, d.source, d.n_chars from e join documents d on d.doc_id = e.row_id
""")
def _(spark, d):
    inputs = b.table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), "lang", "source", "n_chars")
    out = joins.largest_mistakes(b.scored(spark, d).select("row_id", "label", "score"), inputs, "row_id")
    return out.withColumn("score", r6("score"))


@query("m23_calibrate_cutoff", f"""
with {b.SCORED}, cal as (select * from scored where row_id % 4 = 0), oth as (select * from scored where row_id % 4 <> 0),
 cut as (select max(score) as c from cal where score <= (select min(score) from cal where label = 1)),
 m as (select c, {CONFUSION} from oth, cut group by 1) select {r('c', 'cutoff')}, tn, fp, fn, tp, {RATES} from m
""")
def _(spark, d):
    rows = b.scored(spark, d)
    table = scoring.threshold_table(rows.where("row_id % 4 = 0"))
    cutoff = scoring.select_cutoff_fpr(table, [1.0]).select("threshold").scalar()
    other = rows.where("row_id % 4 <> 0").withColumn("cutoff", cutoff)
    out = other.groupBy("cutoff").agg(*scoring.classification_aggregates(F.col("cutoff")))
    return rounded(out.select("cutoff", "tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "specificity"), skip=())


# Resampling -----------------------------------------------------------------------------

REPLICATES, PAIRED_REPLICATES = 20000, 10000
HEX = "cast('0x' || substr({0}, {1}, 8) as bigint)"


STATIONARY = f"""
with {WEEKS}, w as (select row_number() over (order by week_start) - 1 as i, contrast from weeks), n as (select count(*) as n, avg(contrast) as m from w),
 ring as (select i, contrast from w union all select i + n, contrast from w, n),
 upto as (select i + 1 as i, sum(contrast) over (order by i) as s from ring union all select 0, 0),
 g as (select b, rep, k, n, md5('42-' || b || '-' || rep || '-' || (k // 2)) as h from (select unnest([2, 4, 6]) as b), (select unnest(generate_series(0, {REPLICATES - 1})) as rep), n,
  (select i as k from w)),
 drawn as (select b, rep, k, n, {HEX.format('h', '1 + 16 * (k % 2)')} % n as f,
  least(n, cast(floor(ln(({HEX.format('h', '9 + 16 * (k % 2)')} + 0.5) / cast(4294967296 as double)) / ln(1 - 1 / cast(b as double))) as bigint) + 1) as len from g),
 runs as (select b, rep, n, f, len, sum(len) over (partition by b, rep order by k rows unbounded preceding) - len as done from drawn),
 dr as (select b, rep, sum(e.s - o.s) / any_value(n) as draw from runs join upto o on o.i = f join upto e on e.i = f + least(len, n - done) where done < n group by 1, 2),
 q as (select b, any_value(m) as m, quantile_cont(draw, 0.025) as lo, quantile_cont(draw, 0.975) as hi, stddev_samp(draw) as se, count(*) filter (where abs(draw - m) >= abs(m)) as x from dr, n group by 1)
select cast(b as bigint) as block, {r('m', 'estimate')}, {r('2 * m - hi', 'ci_lower')}, {r('2 * m - lo', 'ci_upper')}, {r('se', 'standard_error')}, x as extreme, {r(f'(1 + x) / cast({REPLICATES + 1} as double)', 'p_value')} from q
"""


@query("m20_stationary_bootstrap", STATIONARY)
def _(spark, d):
    weeks = weekly.week_contrast(b.daily_shipments(spark, d))
    return rounded(resample.stationary_bootstrap(weeks, "week_start", "contrast", replicates=REPLICATES), skip=())


@query("m20_stable_direction", f"""
select min(ci_lower) > 0 as stable_positive, max(ci_upper) < 0 as stable_negative, min(ci_lower) > 0 or max(ci_upper) < 0 as stable from ({STATIONARY})
""")
def _(spark, d):
    weeks = weekly.week_contrast(b.daily_shipments(spark, d))
    return resample.stable_direction(resample.stationary_bootstrap(weeks, "week_start", "contrast", replicates=REPLICATES))


@query("m21_paired_block_bootstrap", f"""
with {NAIVE}, v as (select row_number() over (order by date) - 1 as i, abs(other - actual) - abs(prediction - actual) as gap from naive), n as (select count(*) as n, avg(gap) as m from v),
 g as (select b, rep, n, unnest(generate_series(0, cast(ceil(n / cast(b as double)) as bigint) - 1)) as k from (select unnest([3, 7, 14]) as b), (select unnest(generate_series(0, {PAIRED_REPLICATES - 1})) as rep), n),
 s as (select b, rep, n, k, {HEX.format("md5('42-' || b || '-' || rep || '-' || (k // 4))", '1 + 8 * (k % 4)')} % n as f, unnest(generate_series(0, least(b, n - k * b) - 1)) as o from g),
 dr as (select b, rep, avg(gap) as draw from s join v on v.i = (f + o) % n group by 1, 2)
select cast(b as bigint) as block, {r('any_value(m)', 'mae_difference')}, {r('quantile_cont(draw, 0.025)', 'lower')}, {r('quantile_cont(draw, 0.975)', 'upper')}, count(*) as replicates from dr, n group by 1
""")
def _(spark, d):
    return rounded(resample.paired_block_bootstrap(naive(spark, d), "date", "actual", "other", "prediction", replicates=PAIRED_REPLICATES), skip=())


@query("m22_clopper_pearson")
def _(spark, d):
    m = scoring.classification_metrics(b.scored(spark, d), 0.5, ["lang"])
    out = m.withColumn("ci", clopper_pearson(F.col("tp"), F.col("tp") + F.col("fn"), F.lit(0.95)))
    return out.select("lang", F.col("tp").alias("successes"), (F.col("tp") + F.col("fn")).alias("trials"),
                      F.col("recall").alias("estimate"), "ci.lower", "ci.upper")
