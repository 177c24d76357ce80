"""Splits, folds and fold-fitted preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.operators import history, neighbours, prep, split
from daymark.plans import bindings as b
from daymark.plans.catalog.features import LAGGED, r, rounded, rs
from daymark.plans.registry import query

SIZES = ["size", "price", "width"]


def _union(parts):
    return " union all ".join(parts)


NUMBERED = """numbered as (select *, row_number() over (partition by label order by md5('42-' || row_id), row_id) as pos, count(*) over (partition by label) as of_label from scored)"""


@query("m1_stratified_split", f"""
with {b.SCORED}, {NUMBERED} select row_id, label, case when (pos - 1) * 10 < 6 * of_label then 'train' when (pos - 1) * 10 < 8 * of_label then 'validation' else 'test' end as split from numbered
""")
def _(spark, d):
    return split.stratified_split(b.scored(spark, d).select("row_id", "label"), "row_id", "label")


FOLDED = f"""{b.SCORED}, reps as (select s.row_id, s.label, rep from scored s, (select unnest([0, 1]) as rep)),
 folded as (select row_id, label, rep, (row_number() over (partition by rep, label order by md5('42-' || rep || '-' || row_id), row_id) - 1) % 5 as fold from reps)"""


@query("m2_stratified_folds", f"with {FOLDED} select row_id, label, cast(rep as bigint) as repeat, cast(fold as bigint) as fold from folded")
def _(spark, d):
    return rounded(split.stratified_folds(b.scored(spark, d).select("row_id", "label"), "row_id", "label", 5, 2), skip=())


@query("m3_group_stratified_folds", f"""
with {b.PARTS}, g as (select size, brand, kind, min(row_id) as group_id, cast(count(*) filter (where class = 'p') * 2 >= count(*) as integer) as major from parts group by 1, 2, 3),
 f as (select *, (row_number() over (partition by major order by md5('42-' || group_id), group_id) - 1) % 3 as fold from g)
select p.row_id, f.group_id, cast(f.fold as bigint) as fold from parts p join f on p.size is not distinct from f.size and p.brand is not distinct from f.brand and p.kind is not distinct from f.kind
""")
def _(spark, d):
    rows = b.incomplete(spark, d).select("row_id", "size", "brand", "kind", (F.col("class") == "p").cast("int").alias("label"))
    out = split.group_stratified_folds(rows, ["size", "brand", "kind"], "row_id", "label")
    return rounded(out.select("row_id", "group_id", "fold"), skip=())


@query("m4_expanding_folds", f"""
with {b.DAILY}, back as (select date, row_number() over (order by date desc) - 1 as k from daily), f as (select date, k, fold, (2 - fold) * 21 as e from back, (select unnest([0, 1, 2]) as fold)),
 x as (select fold, date, case when k >= e and k < e + 21 then 'check' when k >= e + 21 then 'train' end as role from f)
select cast(fold as bigint) as fold, role, min(date) as first_date, max(date) as last_date, count(*) as rows from x where role is not null group by 1, 2
""")
def _(spark, d):
    return rounded(split.fold_bounds(split.expanding_folds(b.daily_shipments(spark, d))), skip=())


def _tree(level):
    return f"""l{level} as (select repeat, fold, up as node, cast(floor(up / cast(65536 as double)) as bigint) as up, sha256(string_agg(txt, ',' order by node)) as txt from l{level - 1} group by 1, 2, 3)"""


@query("m5_fold_fingerprint", f"""
with {FOLDED}, l0 as (select cast(rep as bigint) as repeat, cast(fold as bigint) as fold, row_id as node, cast(floor(row_id / cast(65536 as double)) as bigint) as up, cast(row_id as varchar) as txt from folded),
 {_tree(1)}, {_tree(2)}, {_tree(3)}, {_tree(4)} select repeat, fold, txt as fingerprint from l4
""")
def _(spark, d):
    folds = split.stratified_folds(b.scored(spark, d).select("row_id", "label"), "row_id", "label", 5, 2)
    return rounded(split.membership_fingerprint(folds, "row_id", ["repeat", "fold"]), skip=())


TRAINING = f"{b.PARTS}, training as (select * from parts where row_id % 5 <> 0)"


@query("m6_median_impute", f"""
with {TRAINING} select row_id, {', '.join(r(f'coalesce({c}, (select quantile_cont({c}, 0.5) from training))', c) for c in SIZES)} from parts
""")
def _(spark, d):
    rows = b.incomplete(spark, d).select("row_id", *SIZES)
    medians = prep.fit_medians(rows.where("row_id % 5 <> 0"), SIZES)
    return rounded(prep.apply_medians(rows, medians, SIZES), skip=())


@query("m7_iterative_impute")
def _(spark, d):
    rows = b.incomplete(spark, d).select("row_id", *SIZES)
    return prep.ChainedImputer(SIZES, rounds=10).fit(rows.where("row_id % 5 <> 0")).transform(rows)


def _scaled(how):
    e = {"standard": "({0} - (select avg({0}) from training)) / (select stddev_pop({0}) from training)",
         "robust": "({0} - (select quantile_cont({0}, 0.5) from training)) / (select quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25) from training)"}[how]
    return ", ".join(r(e.format(c), c) for c in SIZES)


def _scale(spark, d, how):
    rows = b.incomplete(spark, d).select("row_id", *SIZES)
    return rounded(prep.apply_scale(rows, prep.fit_scale(rows.where("row_id % 5 <> 0"), SIZES), SIZES, how), skip=())


@query("m9_scale_standard", f"with {TRAINING} select row_id, {_scaled('standard')} from parts")
def _(spark, d):
    return _scale(spark, d, "standard")


@query("m9_scale_robust", f"with {TRAINING} select row_id, {_scaled('robust')} from parts")
def _(spark, d):
    return _scale(spark, d, "robust")


@query("m9_scale_quantile_normal")
def _(spark, d):
    rows = b.incomplete(spark, d).select("row_id", "price")
    return prep.apply_quantile_normal(rows, "price", prep.fit_landmarks(rows.where("row_id % 5 <> 0"), "price"))


FREQUENT = 60


def _levels(c):
    return f"""{c}_l as (select {c} as level, count(*) as n from training where {c} is not null group by 1),
 {c}_k as (select level, row_number() over (order by level) - 1 as i from {c}_l where n >= {FREQUENT})"""


@query("m10_encode", f"""
with {TRAINING}, {_levels('brand')}, {_levels('kind')} select p.row_id, case when bk.level is not null then bk.level when bl.level is not null then '__POOLED__' end as brand_level,
 coalesce(bk.i, case when bl.level is not null then -2 else -1 end) as brand_index, case when kk.level is not null then kk.level when kl.level is not null then '__POOLED__' end as kind_level,
 coalesce(kk.i, case when kl.level is not null then -2 else -1 end) as kind_index, cast(coalesce(bk.level = 'Brand#7', false) as bigint) as brand_7
from parts p left join brand_l bl on bl.level = p.brand left join brand_k bk on bk.level = p.brand left join kind_l kl on kl.level = p.kind left join kind_k kk on kk.level = p.kind
""")
def _(spark, d):
    rows = b.incomplete(spark, d).select("row_id", *b.CATEGORICAL)
    levels = prep.fit_levels(rows.where("row_id % 5 <> 0"), b.CATEGORICAL, FREQUENT)
    out = prep.one_hot(prep.apply_levels(rows, levels, b.CATEGORICAL), "brand", ["Brand#7"])
    return rounded(out.select("row_id", "brand_level", "brand_index", "kind_level", "kind_index",
                              F.col("`brand=Brand#7`").alias("brand_7")), skip=())


def _donors(target):
    others = [c for c in SIZES if c != target]
    shared = [f"(t.{c} is not null and q.{c} is not null)" for c in others]
    gap = " + ".join(f"coalesce(pow((q.{c} - t.{c}) / s.{c}, 2), 0)" for c in others)
    n = " + ".join(f"cast({x} as integer)" for x in shared)
    return f"""select row_id, '{target}' as col, case when count(*) filter (where dist = 0) > 0 then avg(v) filter (where dist = 0) else sum(v / nullif(dist, 0)) / sum(1 / nullif(dist, 0)) end as v from (
 select q.row_id, t.{target} as v, round(round(sqrt({gap}), 9) * sqrt(3 / cast({n} as double)), 9) as dist, row_number() over (partition by q.row_id order by round(round(sqrt({gap}), 9) * sqrt(3 / cast({n} as double)), 9), t.row_id) as k
 from parts q join training t on q.{target} is null and t.{target} is not null and ({' or '.join(shared)}), spread s) where k <= 7 group by row_id"""


@query("m8_knn_impute", f"""
with {TRAINING}, spread as (select {', '.join(f'stddev_pop({c}) as {c}' for c in SIZES)} from training), found as ({_union(_donors(c) for c in SIZES)})
select p.row_id, {', '.join(r(f"coalesce(p.{c}, (select v from found f where f.row_id = p.row_id and f.col = '{c}'), (select avg({c}) from training))", c) for c in SIZES)} from parts p
""")
def _(spark, d):
    rows = b.incomplete(spark, d).select("row_id", *SIZES)
    return rounded(neighbours.knn_impute(rows.where("row_id % 5 <> 0"), rows, SIZES, "row_id"), skip=())


NEAR = ["lag_1", "lag_7", "lag_14"]


@query("m16_knn_regress", f"""
with {LAGGED}, tr as (select * from lagged where lag_14 is not null and date < date '2000-01-01'), te as (select * from lagged where date >= date '2000-01-01'),
 s as (select {', '.join(f'stddev_pop({c}) as {c}' for c in NEAR)} from tr),
 k as (select te.date, tr.trips, row_number() over (partition by te.date order by round(sqrt({' + '.join(f'pow((te.{c} - tr.{c}) / s.{c}, 2)' for c in NEAR)}), 9), tr.date) as k from te, tr, s)
select date, {r('avg(trips)', 'prediction')} from k where k <= 5 group by 1
""")
def _(spark, d):
    rows = history.lags(b.daily_shipments(spark, d), (1, 7, 14)).where("lag_14 is not null")
    early = F.col("date") < F.lit("2000-01-01").cast("date")
    out = neighbours.knn_regress(rows.where(early), rows.where(~early), NEAR, "trips", "date")
    return rounded(out.select("date", "prediction"))
