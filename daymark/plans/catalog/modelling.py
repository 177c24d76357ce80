"""Model jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators import history, scoring
from daymark.plans import bindings as b
from daymark.plans import classifying, forecasting, linear, requests
from daymark.plans.catalog.features import FRAME, LAGGED, r, rounded, rs
from daymark.plans.catalog.preparation import FOLDED
from daymark.plans.catalog.statistics import METRICS
from daymark.plans.registry import query
from daymark.session import materialize

TRAIN_UNTIL = "2000-12-31"


def frame(spark, d):
    """The feature frame, written once: every fit reads it many times."""
    return materialize(b.feature_frame(spark, d).where("lag_28 is not null"), "frame")


def halves(rows):
    early = F.col("date") <= F.lit(TRAIN_UNTIL).cast("date")
    return rows.where(early), rows.where(~early)


def labelled(spark, d):
    return b.scored(spark, d).select("row_id", "label", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
                                     F.when(F.col("row_id") % 6 != 0, F.col("quality").cast("double")).alias("quality"))


NUMERIC, CATEGORICAL = ["n_chars", "quality"], ["lang", "source"]


@query("m11_fit_regressors")
def _(spark, d):
    train, check = halves(frame(spark, d))

    def run(family):
        model = forecasting.ResidualForecaster(family, "compact").fit(train)
        return scoring.regression_metrics(model.transform(check), actual="trips").withColumn("family", F.lit(family))

    return reduce(DataFrame.unionByName, classifying.pooled(spark, run, forecasting.FAMILIES, 5))


@query("m12_fit_classifiers")
def _(spark, d):
    rows = materialize(labelled(spark, d).withColumn("held", F.col("row_id") % 5 == 0), "rows")

    def run(family):
        model = classifying.classifier(family, NUMERIC, CATEGORICAL).fit(rows.where("not held"))
        scored = classifying.score_rows(model, rows.where("held"), ["row_id", "label"])
        return scoring.classification_metrics(scored).withColumn("family", F.lit(family))

    return reduce(DataFrame.unionByName, classifying.pooled(spark, run, classifying.FAMILIES, 4))


@query("m13_residual_forecaster")
def _(spark, d):
    train, check = halves(frame(spark, d))
    model = forecasting.ResidualForecaster("ridge", "full", "residual7", half_life=90, alpha=10.0).fit(train)
    return model.transform(check).select("date", "trips", "prediction")


@query("m14_blend", f"""
with {FRAME}, x as (select date, greatest(0, 0.75 * lag_7 + 0.25 * mean_7) as p from frame where mean_7 is not null) select date, {r('p', 'prediction')} from x
""")
def _(spark, d):
    rows = history.past_statistics(history.lags(b.daily_shipments(spark, d), [7]), [7], kinds=("mean",)).where("mean_7 is not null")
    return rounded(rows.select("date", forecasting.blend({"lag_7": 0.75, "mean_7": 0.25}).alias("prediction")))


@query("m14_blend_models")
def _(spark, d):
    train, check = halves(frame(spark, d))
    members = [(forecasting.ResidualForecaster("ridge", "full", "residualblend").fit(train), 0.75),
               (forecasting.BaselineForecaster("seasonal_average", decay=0.75, adjustment=0.5).fit(train), 0.25)]
    return forecasting.blend_models(members, check).select("date", "trips", "prediction")


@query("m15_grid_search_chrono")
def _(spark, d):
    candidates = [forecasting.ResidualForecaster("ridge", s, t, alpha=a)
                  for a in (0.01, 0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0) for s in ("compact", "full") for t in ("direct", "residual7")]
    train, _ = halves(frame(spark, d))
    return forecasting.search_board(forecasting.grid_search_chrono(train, candidates))


@query("m15_baseline_search", f"""
with {FRAME}, f as (select *, row_number() over (order by date desc) - 1 as back from frame where lag_28 is not null and date <= date '{TRAIN_UNTIL}'),
 c as (select cast(i as int) as candidate, cast(0.5 + 0.25 * (i // 3) as double) as d, cast(0.5 * (i % 3) as double) as a from (select unnest(range(9)) as i)),
 p as (select candidate, k, back, 21 * (2 - k) as cut, abs(trips - (lag_7 + d * lag_14 + d * d * lag_21 + d * d * d * lag_28) / (1 + d + d * d + d * d * d)
  * pow(least(2, greatest(0.5, mean_7 / greatest(1, mean_28))), a)) as error from f, c, (select unnest(range(3)) as k)),
 m as (select candidate, k, avg(error) filter (where back >= cut and back < cut + 21) as mae, avg(error) filter (where back >= cut + 21) as train from p group by 1, 2)
select candidate, {r('avg(mae)', 'mean_mae')}, {r('stddev_pop(mae)', 'std_mae')}, {r('avg(train)', 'mean_train_mae')}, count(*) as folds from m group by 1
""")
def _(spark, d):
    candidates = [forecasting.BaselineForecaster("seasonal_average", decay=w, adjustment=a) for w in (0.5, 0.75, 1.0) for a in (0.0, 0.5, 1.0)]
    train, _ = halves(frame(spark, d))
    return rounded(forecasting.search_board(forecasting.grid_search_chrono(train, candidates)).drop("setting"), skip=())


ELASTIC = [(a, l) for a in (0.01, 0.1, 1.0, 10.0) for l in (0.1, 0.5, 0.9)]
HUBER = [(a, e) for a in (0.0001, 0.01, 1.0) for e in (1.2, 1.35, 1.75)]


@query("m11_elastic_optimality", f"""
with {LAGGED}, t as (select count(*) as days from lagged where lag_28 is not null and date <= date '{TRAIN_UNTIL}')
select cast(a as double) as alpha, cast(l as double) as l1_ratio, days, true as optimal from t, (select unnest({[a for a in sorted({a for a, _ in ELASTIC})]}) as a), (select unnest({sorted({l for _, l in ELASTIC})}) as l)
""")
def _(spark, d):
    """Every elastic-net setting meets its optimality conditions, recomputed from the rows alone."""
    train, _ = halves(frame(spark, d))
    candidates = [forecasting.ResidualForecaster("elastic", "full", alpha=a, l1_ratio=l) for a, l in ELASTIC]
    design = linear.Design(candidates)
    rows = materialize(design.rows(train.withColumns({"fold": F.lit(0), "role": F.lit("train")}), "date", "trips", ["series"]), "linear")
    lines = linear.solved_lines(rows, design, candidates)[0]
    checks = []
    for at, (c, (a, l)) in enumerate(zip(candidates, ELASTIC)):
        line = [float(lines[0, at]), *(float(lines[i, at]) for i in design.picked(c))]
        checks.append(linear.elastic_optimality(train, c, line).select(
            F.lit(a).alias("alpha"), F.lit(l).alias("l1_ratio"), "days", (F.col("off") < 1e-7).alias("optimal")))
    return reduce(DataFrame.unionByName, checks)


@query("m15_linear_board")
def _(spark, d):
    """Elastic-net and Huber grids on all folds: settings x targets, from shared passes."""
    train, _ = halves(frame(spark, d))
    candidates = [forecasting.ResidualForecaster("elastic", "full", t, alpha=a, l1_ratio=l) for a, l in ELASTIC for t in ("direct", "residual7")]
    candidates += [forecasting.ResidualForecaster("huber", "full", t, alpha=a, epsilon=e) for a, e in HUBER for t in ("direct", "residual7")]
    return forecasting.search_board(forecasting.grid_search_chrono(train, candidates))


ONE_FEATURE = [("ridge", 0.1, 0.0), ("ridge", 100.0, 0.0)] + [("elastic", a, l) for a in (0.1, 1.0, 5.0) for l in (0.2, 0.9)]


@query("m15_one_feature_board", f"""
with {LAGGED}, f as (select trips, cast(lag_7 as double) as x, row_number() over (order by date desc) - 1 as back from lagged where lag_28 is not null and date <= date '{TRAIN_UNTIL}'),
 k as (select unnest(range(3)) as k), tr as (select k, count(*) as n, avg(x) as mx, stddev_pop(x) as sx, avg(trips) as my, covar_pop(x, trips) as cxy from f, k where back >= 21 * (3 - k) group by 1),
 c as (select * from (values {', '.join(f"({i}, '{f}', cast({a} as double), cast({l} as double))" for i, (f, a, l) in enumerate(ONE_FEATURE))}) v(candidate, family, alpha, l1)),
 w as (select candidate, tr.*, n * cxy / sx as pull, case when family = 'ridge' then n * cxy / sx / (n + alpha)
  else sign(cxy) * greatest(0, abs(n * cxy / sx) - n * alpha * l1) / (n + n * alpha * (1 - l1)) end as slope from tr, c),
 p as (select candidate, w.k, back, 21 * (2 - w.k) as cut, abs(trips - greatest(0, my + slope * (x - mx) / sx)) as error from f, w),
 m as (select candidate, k, avg(error) filter (where back >= cut and back < cut + 21) as mae, avg(error) filter (where back >= cut + 21) as train from p group by 1, 2)
select cast(candidate as int) as candidate, {r('avg(mae)', 'mean_mae')}, {r('stddev_pop(mae)', 'std_mae')}, {r('avg(train)', 'mean_train_mae')}, count(*) as folds from m group by 1
""")
def _(spark, d):
    """Ridge and elastic settings over one feature, where both have a closed form."""
    train, _ = halves(frame(spark, d))
    candidates = [forecasting.ResidualForecaster(f, "last_week", alpha=a, **({"l1_ratio": l} if f == "elastic" else {})) for f, a, l in ONE_FEATURE]
    return rounded(forecasting.search_board(forecasting.grid_search_chrono(train, candidates)).drop("setting"), skip=())


@query("m17_evaluate_oof")
def _(spark, d):
    scores = classifying.held_out_scores(labelled(spark, d), lambda: classifying.classifier("logistic", NUMERIC, CATEGORICAL),
                                         predictors=NUMERIC + CATEGORICAL, exclude_collisions=True)
    return classifying.row_scores(classifying.require_each_row(scores, 2))


@query("m17_fold_metrics", f"""
with {FOLDED}, f as (select rep, fold, count(*) as n, count(*) filter (where label = 1) as p from folded group by 1, 2)
select cast(rep as bigint) as repeat, cast(fold as bigint) as fold, {r('p / cast(n as double)', 'average_precision')}, cast(0.5 as double) as roc_auc, n - p as tn, cast(0 as bigint) as fp, p as fn, cast(0 as bigint) as tp from f
""")
def _(spark, d):
    scores = classifying.held_out_scores(labelled(spark, d), lambda: classifying.classifier("majority", NUMERIC, CATEGORICAL))
    out = classifying.fold_metrics(scores).select("repeat", "fold", "average_precision", "roc_auc", "tn", "fp", "fn", "tp")
    return rounded(out, skip=())


SHARED = "t.lang is not distinct from h.lang and t.source is not distinct from h.source and t.n_chars is not distinct from h.n_chars and t.q is not distinct from h.q"
FOLD_REPORT = f"""
{FOLDED}, x as (select s.row_id, s.lang, s.source, s.n_chars, case when s.row_id % 6 <> 0 then s.quality end as q from scored s),
 r as (select f.*, lang, source, n_chars, q from folded f join x using (row_id)),
 fo as (select distinct rep, fold from folded),
 tr as (select fo.rep, fo.fold, count(*) as training_rows, count(*) filter (where label = 1) as p from fo join r t on t.rep = fo.rep and t.fold <> fo.fold
  where not exists (select 1 from r h where h.rep = fo.rep and h.fold = fo.fold and {SHARED}) group by 1, 2),
 va as (select rep, fold, count(*) as validation_rows, count(*) filter (where label = 1) as p from folded group by 1, 2),
 report as (select rep, fold, training_rows, validation_rows, (select count(*) from scored) - training_rows - validation_rows as excluded,
  tr.p / cast(training_rows as double) as train_ap, va.p / cast(validation_rows as double) as ap, validation_rows - va.p as tn, va.p as fn from tr join va using (rep, fold))"""


@query("m17_fold_report", f"""
with {FOLD_REPORT} select cast(rep as bigint) as repeat, cast(fold as bigint) as fold, training_rows, validation_rows, cast(excluded as bigint) as collision_training_exclusions,
 {r('train_ap', 'train_average_precision')}, {r('ap', 'average_precision')}, cast(0.5 as double) as roc_auc, tn, fn from report
""")
def _(spark, d):
    """Rows, exclusions and metrics of every fold; the majority class scores all rows alike, so SQL can tell them."""
    rows = classifying.fold_rows(labelled(spark, d), lambda: classifying.classifier("majority", NUMERIC, CATEGORICAL),
                                 predictors=NUMERIC + CATEGORICAL, exclude_collisions=True)
    out = classifying.fold_report(rows).select("repeat", "fold", "training_rows", "validation_rows", "collision_training_exclusions",
                                               "train_average_precision", "average_precision", "roc_auc", "tn", "fn")
    return rounded(out, skip=())


@query("m17_evaluation_summary", f"""
with {FOLD_REPORT}, o as (select count(*) as n, count(*) filter (where label = 1) as p from scored)
select count(*) as folds, {r('avg(ap)', 'cv_average_precision')}, {r('stddev_pop(ap)', 'cv_average_precision_std')}, cast(0.5 as double) as cv_roc_auc, cast(0 as double) as cv_roc_auc_std,
 {r('avg(train_ap)', 'train_average_precision')}, cast(sum(excluded) as bigint) as collision_training_exclusions, {r('any_value(o.p) / cast(any_value(o.n) as double)', 'oof_average_precision')},
 cast(0.5 as double) as oof_roc_auc, any_value(o.n - o.p) as oof_tn, any_value(o.p) as oof_fn from report, o
""")
def _(spark, d):
    rows = classifying.fold_rows(labelled(spark, d), lambda: classifying.classifier("majority", NUMERIC, CATEGORICAL),
                                 predictors=NUMERIC + CATEGORICAL, exclude_collisions=True)
    out = classifying.evaluation_summary(rows)
    return rounded(out.select("folds", "cv_average_precision", "cv_average_precision_std", "cv_roc_auc", "cv_roc_auc_std", "train_average_precision",
                              "collision_training_exclusions", "oof_average_precision", "oof_roc_auc", "oof_tn", "oof_fn"), skip=())


@query("m18_nested_cutoff")
def _(spark, d):
    return classifying.nested_cutoff(labelled(spark, d), lambda: classifying.classifier("logistic", NUMERIC, CATEGORICAL, rounds=3000))


@query("m19_feature_ablation")
def _(spark, d):
    train, _ = halves(frame(spark, d))
    return forecasting.feature_ablation(train, lambda s: forecasting.ResidualForecaster("ridge", s, alpha=10.0), ["compact", "full", "weekly", "recent"])


#: ``source`` is the noise column, ``quality`` the one that is often missing.
VERSIONS = {
    "all columns": (NUMERIC, CATEGORICAL, True),
    "no source": (NUMERIC, ["lang"], True),
    "no source, no quality": (["n_chars"], ["lang"], True),
    "no source, quality as flag": (["n_chars", "quality_recorded"], ["lang"], True),
    "no source, no missing flags": (NUMERIC, ["lang"], False),
}
#: Trees grow to Spark's greatest depth, since those of the plan have no limit.
ABLATION_SETTINGS = {"logistic": {"rounds": 3000}, "forest": {"trees": 200, "leaf": 3, "depth": 30}}


@query("m19_preparation_ablation")
def _(spark, d):
    rows = labelled(spark, d).withColumn("quality_recorded", F.col("quality").isNotNull().cast("double"))
    return classifying.preparation_ablation(rows, VERSIONS, ("logistic", "forest"), k=5, repeats=2, settings=ABLATION_SETTINGS)


@query("m24_rolling_evaluation", f"""
with {LAGGED}, {b.DAILY_ORDERS}, full_history as (select date, count(*) over (order by date range between interval 28 days preceding and interval 1 day preceding) as held from daily),
 h as (select l.date, cast(l.trips as double) as actual, cast(l.lag_7 as double) as lag_7,
  coalesce(cast(o.trips * 4 as double), (lag_1 + lag_2 + lag_3 + lag_4 + lag_5 + lag_6 + lag_7) / cast(7 as double)) as prediction, o.date is not null as whole
 from lagged l left join odaily o on l.date = o.date where l.date >= date '2001-01-01' and l.date in (select date from full_history where held = 28)),
 s as (select 'all' as subset, * from h union all select 'weather_complete', * from h where whole),
 m as (select subset, {METRICS}, avg(abs(actual - lag_7)) as lag_7_mae from s group by 1)
select subset, {rs('mae', 'rmse', 'wape', 'bias')}, days, {rs('lag_7_mae')}, {r('1 - mae / lag_7_mae', 'improvement')} from m
""")
def _(spark, d):
    preferred = b.daily_orders(spark, d).select("date", (F.col("trips") * 4).cast("double").alias("prediction"))
    return rounded(forecasting.rolling_evaluation(b.daily_shipments(spark, d), preferred, "2001-01-01"), skip=())


@query("m25_batch_score")
def _(spark, d):
    rows = materialize(labelled(spark, d), "rows")
    model = classifying.classifier("logistic", NUMERIC, CATEGORICAL).fit(rows)
    requests = rows.withColumn("n_chars", F.when(F.col("row_id") % 8 == 0, -F.col("n_chars")).otherwise(F.col("n_chars")))
    return classifying.batch_score(model, requests, NUMERIC, CATEGORICAL, 0.1)


def _every(day: str, step: int) -> str:
    return f"cast(dayofyear({day}) as integer) % {step} = 0"


@query("m25_forecast_requests", f"""
with {FRAME}, {b.WEATHER}, {b.REQUEST_DAYS}, mean as (select avg(trips) as m from frame where lag_28 is not null and date <= date '{TRAIN_UNTIL}'),
 x as (select f.*, model as requested_model, {_every('f.date', 13)} as wrong, model = 'weather_week' and {_every('f.date', 10)} as missing, m
  from frame f join request_days q on f.date = q.date, mean, (select unnest(['counts', 'weather_day', 'weather_week']) as model)),
 y as (select *, case when missing then 'counts' else requested_model end as model from x),
 z as (select *, case when not wrong then case model when 'weather_day' then m when 'weather_week' then greatest(0, 0.75 * lag_7 + 0.25 * mean_7 + 0.5 * (mean_7 - mean_14))
  else (lag_7 + 0.75 * lag_14 + 0.5625 * lag_21 + 0.421875 * lag_28) / cast(2.734375 as double) * pow(least(2, greatest(0.5, mean_7 / greatest(1, mean_28))), 0.5) end end as p from y)
select date, requested_model, model, missing as missing_forecast_fallback, case when wrong then 'history_values' else '' end as errors,
 {r('p', 'unrounded_prediction')}, cast(round_even(p, 0) as bigint) as prediction, case when missing then '{requests.FALLBACK_NOTE}' end as note from z
""")
def _(spark, d):
    """A batch of requests answered by the models they name; missing weather falls back, broken histories are refused."""
    train, _ = halves(frame(spark, d))
    models = {"counts": forecasting.BaselineForecaster("seasonal_average", decay=0.75, adjustment=0.5),
              "weather_day": forecasting.BaselineForecaster("training_mean"),
              "weather_week": forecasting.BaselineForecaster("lag_7", blend=0.25, trend=0.5)}
    needs = {"counts": ["lag_7", "lag_14", "lag_21", "lag_28", "mean_7", "mean_28"], "weather_day": ["temp_mean"],
             "weather_week": ["lag_7", "mean_7", "mean_14", "temp_change_7"]}
    day = F.to_date("prediction_date")
    asked = b.forecast_requests(spark, d).withColumns({
        "forecasts": F.when((F.col("model") == "weather_week") & (F.dayofyear(day) % 10 == 0), F.slice("forecasts", 1, 0)).otherwise(F.col("forecasts")),
        "prior_counts": F.when(F.dayofyear(day) % 13 == 0, F.transform("prior_counts", lambda v, i: F.when(i == 5, -v - 1).otherwise(v))).otherwise(F.col("prior_counts")),
        "asked": day})
    fitted = {n: (m.fit(train), needs[n]) for n, m in models.items()}
    out = requests.forecast_requests(asked, fitted, ["asked"])
    return rounded(out.select(F.col("asked").alias("date"), "requested_model", "model", "missing_forecast_fallback",
                              F.concat_ws(",", "errors").alias("errors"), "unrounded_prediction", "prediction", "note"))


@query("x1_feature_design_stage", f"""
with {b.PARTS} select row_id, size, price, width, brand, kind, {r('size / nullif(width, 0)', 'size_over_width')}, {r('price / nullif(size, 0)', 'price_over_size')},
 {r('ln(1 + size)', 'size_log1p')}, {r('ln(1 + price)', 'price_log1p')}, {r('ln(1 + width)', 'width_log1p')} from parts
""")
def _(spark, d):
    stage = classifying.FeatureDesign(b.NUMERIC, b.CATEGORICAL, ratios=b.RATIOS, engineered=True, keep=["row_id"])
    return rounded(stage.transform(b.incomplete(spark, d)), skip=())
