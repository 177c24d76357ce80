"""Causal features, calendar terms, joins with forecasts, weekly contrast (F, W1-W11, W17-W20, J1-J8, P14, M26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.functions import calendar as cal
from daymark.functions.numeric import TARGETS, count_sql, fitted_sql, r6
from daymark.operators import history, joins, sets, weekly
from daymark.plans import bindings as b
from daymark.plans import requests
from daymark.plans.registry import query

SPANS = history.SPANS
PI2 = "2 * pi()"


def rounded(df, skip=("date", "series")):
    """Six places for every double, plain bigint for every whole number."""
    out = []
    for name, kind in df.dtypes:
        if name in skip:
            continue
        if kind == "double":
            out.append(r6(name).alias(name))
        elif kind in ("int", "bigint", "smallint"):
            out.append(F.col(name).cast("long").alias(name))
        else:
            out.append(F.col(name))
    keep = ["date"] if "date" in df.columns and "date" in skip else []
    return df.select(*keep, *out)


LAGGED = f"{b.DAILY}, lagged as (select date, trips, " + ", ".join(
    f"lag(trips, {n}) over w as lag_{n}" for n in range(1, 29)) + " from daily window w as (order by date))"


def _list(n):
    return "[" + ", ".join(f"lag_{i}" for i in range(1, n + 1)) + "]"


def _stats(n):
    full = f"lag_{n} is not null"
    return (f"case when {full} then list_avg({_list(n)}) end as mean_{n}, "
            f"case when {full} then list_stddev_pop({_list(n)}) end as std_{n}, "
            f"case when {full} then cast(list_median({_list(n)}) as double) end as median_{n}")


STATS = f"{LAGGED}, stats as (select *, " + ", ".join(_stats(n) for n in SPANS) + " from lagged)"
FRAME = f"""{STATS}, frame as (select *, lag_7 - lag_14 as weekly_change, lag_1 - lag_7 as recent_change, mean_7 - mean_14 as mean_change,
 lag_1 / nullif(mean_7, 0) as relative_recent, lag_7 / nullif(mean_28, 0) as relative_weekly,
 list_avg([lag_7, lag_14]) as weekly_mean_2, list_avg([lag_7, lag_14, lag_21]) as weekly_mean_3,
 list_avg([lag_7, lag_14, lag_21, lag_28]) as weekly_mean_4, cast(list_median([lag_7, lag_14, lag_21, lag_28]) as double) as weekly_median_4,
 case when lag_7 is not null then least({', '.join(f'lag_{i}' for i in range(1, 8))}) end as recent_low,
 case when lag_7 is not null then greatest({', '.join(f'lag_{i}' for i in range(1, 8))}) end as recent_high from stats)"""


def r(e, alias=None):
    return f"round({e}, 6) + cast(0 as double) as {alias or e}"


def rs(*names):
    return ", ".join(r(n) for n in names)


@query("w6_one_step_features", f"""
with {b.DAILY_EVENTS}, x as (select date, trips, cast(isodow(date) - 1 as bigint) as weekday, cast(month(date) as bigint) as month,
 lag(trips, 1) over w as lag_1, lag(trips, 7) over w as lag_7, avg(trips) over (order by date rows between 7 preceding and 1 preceding) as m
 from edaily window w as (order by date))
select date, trips, weekday, month, lag_1, lag_7, {r('m', 'past_7_day_mean')} from x where lag_7 is not null
""")
def _(spark, d):
    return rounded(history.one_step_features(b.daily_events(spark, d)))


@query("w1_lags", f"with {LAGGED} select * from lagged")
def _(spark, d):
    return history.lags(b.daily_shipments(spark, d)).drop("series")


@query("w2_past_statistics", f"with {STATS} select date, trips, " + ", ".join(
    rs(f"mean_{n}", f"std_{n}", f"median_{n}") for n in SPANS) + " from stats")
def _(spark, d):
    out = history.past_statistics(history.lags(b.daily_shipments(spark, d)))
    return rounded(out.drop(*[f"lag_{n}" for n in range(1, 29)]))


@query("w3_past_extremes", f"with {FRAME} select date, recent_low, recent_high from frame")
def _(spark, d):
    out = history.past_extremes(b.daily_shipments(spark, d))
    return out.select("date", "recent_low", "recent_high")


@query("w4_change_features", f"""
with {FRAME} select date, weekly_change, recent_change, {rs('mean_change', 'relative_recent', 'relative_weekly')} from frame
""")
def _(spark, d):
    f = history.change_features(history.past_statistics(history.lags(b.daily_shipments(spark, d), (1, 7, 14)), (7, 14, 28), kinds=("mean",)))
    return rounded(f.select("date", "weekly_change", "recent_change", "mean_change", "relative_recent", "relative_weekly"))


@query("w5_same_weekday", f"""
with {FRAME} select date, {rs('weekly_mean_2', 'weekly_mean_3', 'weekly_mean_4', 'weekly_median_4')} from frame
""")
def _(spark, d):
    f = history.same_weekday(history.lags(b.daily_shipments(spark, d), (7, 14, 21, 28)))
    return rounded(f.select("date", "weekly_mean_2", "weekly_mean_3", "weekly_mean_4", "weekly_median_4"))


@query("w7_trailing_mean", f"""
with {b.DAILY}, x as (select date, trips, case when count(*) over w = 7 then avg(trips) over w end as t from daily window w as (order by date rows between 6 preceding and current row))
select date, trips, {r('t', 'trailing_mean_7')} from x
""")
def _(spark, d):
    return rounded(history.trailing_mean(b.daily_shipments(spark, d)))


@query("w8_weather_changes", f"""
with {b.WEATHER}, x as (select date, temp_max - temp_min as temp_range, temp_mean - lag(temp_mean, 1) over w as temp_change_1,
 temp_mean - lag(temp_mean, 7) over w as temp_change_7, case when isodow(date) >= 6 then temp_mean else 0 end as temp_weekend,
 greatest(0, temp_mean - 18) as warm_degree, greatest(0, 10 - temp_mean) as cold_degree, ln(1 + rain_sum) as rain_log,
 rain_sum - lag(rain_sum, 7) over w as rain_change_7, wind_mean - lag(wind_mean, 7) over w as wind_change_7 from weather window w as (order by date))
select date, {rs('temp_range', 'temp_change_1', 'temp_change_7', 'temp_weekend', 'warm_degree', 'cold_degree', 'rain_log', 'rain_change_7', 'wind_change_7')} from x
""")
def _(spark, d):
    out = history.weather_changes(b.daily_weather(spark, d))
    return rounded(out.select("date", *history.DERIVED_WEATHER[6:]))


@query("w9_autocorrelation", f"with {LAGGED}, x as (" + " union all ".join(
    f"select cast({n} as bigint) as lag, count(lag_{n}) as pairs, case when max(trips) filter (where lag_{n} is not null) > min(trips) filter (where lag_{n} is not null) "
    f"and max(lag_{n}) > min(lag_{n}) then corr(trips, lag_{n}) end as c from lagged" for n in range(1, 29)) + f") select lag, pairs, {r('c', 'correlation')} from x")
def _(spark, d):
    return rounded(history.autocorrelation(b.daily_shipments(spark, d)), skip=("series",))


WEEKS = f"""{b.DAILY}, weeks as (select *, weekday_mean - weekend_mean as difference, (weekday_mean - weekend_mean) / week_mean as contrast from (
 select cast(date_trunc('week', date) as date) as week_start, count(*) as n, avg(trips) filter (where isodow(date) < 6) as weekday_mean,
 avg(trips) filter (where isodow(date) >= 6) as weekend_mean, avg(trips) as week_mean from daily group by 1) where n = 7)"""


@query("w10_week_contrast", f"with {WEEKS} select week_start, {rs('weekday_mean', 'weekend_mean', 'week_mean', 'difference', 'contrast')} from weeks")
def _(spark, d):
    return rounded(weekly.week_contrast(b.daily_shipments(spark, d)), skip=())


@query("w10_excluded_dates", f"""
with {b.DAILY_ORDERS} select date, cast(date_trunc('week', date) as date) as week_start from odaily where date_trunc('week', date) in
 (select date_trunc('week', date) from odaily group by 1 having count(*) < 7)
""")
def _(spark, d):
    return weekly.excluded_dates(b.daily_orders(spark, d))


@query("w11_contrast_summary", f"""
with {WEEKS}, s as (select count(*) as complete_weeks, count(*) filter (where contrast > 0) as positive_weeks, count(*) filter (where contrast < 0) as negative_weeks,
 avg(weekday_mean) as mean_weekday, avg(weekend_mean) as mean_weekend, avg(difference) as mean_difference, avg(contrast) as estimate,
 min(week_start) as first_date, max(week_start) + 6 as last_date from weeks)
select complete_weeks, positive_weeks, negative_weeks, {rs('mean_weekday', 'mean_weekend', 'mean_difference', 'estimate')}, first_date, last_date from s
""")
def _(spark, d):
    return rounded(weekly.contrast_summary(weekly.week_contrast(b.daily_shipments(spark, d))), skip=())


@query("w11_quarter_summary", f"""
with {WEEKS}, s as (select cast(quarter(week_start) as bigint) as quarter, count(*) as weeks, avg(contrast) as c from weeks group by 1)
select quarter, weeks, {r('c', 'mean_contrast')} from s
""")
def _(spark, d):
    return rounded(weekly.quarter_summary(weekly.week_contrast(b.daily_shipments(spark, d))), skip=())


@query("w17_seasonal_average", f"""
with {FRAME}, x as (select date, (lag_7 + 0.75 * lag_14 + 0.5625 * lag_21 + 0.421875 * lag_28) / cast(2.734375 as double)
 * pow(least(2, greatest(0.5, mean_7 / greatest(1, mean_28))), 0.5) as p from frame where lag_28 is not null)
select date, {r('p', 'prediction')} from x
""")
def _(spark, d):
    f = history.past_statistics(history.lags(b.daily_shipments(spark, d)), (7, 28), kinds=("mean",)).where("lag_28 is not null")
    return rounded(f.select("date", history.seasonal_average(0.75, 0.5).alias("prediction")))


@query("w18_naive_forecasts", f"""
with {FRAME}, m as (select avg(trips) as training_mean from daily where date < date '2000-01-01'),
x as (select date, (select training_mean from m) as training_mean, lag_1, lag_7, mean_7,
 greatest(0, 0.75 * lag_7 + 0.25 * mean_7 + 0.5 * (mean_7 - mean_14)) as blended from frame where lag_14 is not null and date >= date '2000-01-01')
select date, {rs('training_mean', 'lag_1', 'lag_7', 'mean_7', 'blended')} from x
""")
def _(spark, d):
    daily = b.daily_shipments(spark, d)
    f = history.past_statistics(history.lags(daily, (1, 7, 14)), (7, 14), kinds=("mean",)).where("lag_14 is not null and date >= date'2000-01-01'")
    mean = daily.where("date < date'2000-01-01'").select(F.avg("trips")).scalar()
    out = f.withColumn("training_mean", mean).select(
        "date", "training_mean", *[F.col(c).cast("double").alias(c) for c in ("lag_1", "lag_7", "mean_7")],
        history.historical_baseline("lag_7", 0.25, 0.5).alias("blended"))
    return rounded(out)


@query("w19_recency_weights", f"""
with {b.DAILY}, x as (select date, pow(2, -(count(*) over () - row_number() over (order by date)) / cast(60 as double)) as w from daily) select date, {r('w', 'weight')} from x
""")
def _(spark, d):
    return rounded(history.recency_weights(b.daily_shipments(spark, d), 60).select("date", "weight"))


@query("w20_sequence_array", f"""
with {FRAME}, x as (select date, unnest([{', '.join(f'struct_pack(step := {28 - i}, v := ln(1 + lag_{i}) - ln(1 + mean_28))' for i in range(28, 0, -1))}]) as s
 from frame where lag_28 is not null)
select date, cast(s.step as bigint) as step, round(cast(cast(s.v as float) as double), 4) + cast(0 as double) as value from x
""")
def _(spark, d):
    f = history.past_statistics(history.lags(b.daily_shipments(spark, d)), (28,), kinds=("mean",)).where("lag_28 is not null")
    out = history.sequence_array(f).select("date", F.posexplode("sequence").alias("step", "value"))
    return out.select("date", F.col("step").cast("long").alias("step"), r6(F.col("value"), 4).alias("value"))


CALENDAR_ONLY = f"""c as (select date, {PI2} * (isodow(date) - 1) / 7 as a, (dayofyear(date) - 1) / cast(case when (year(date) % 4 = 0 and year(date) % 100 <> 0)
 or year(date) % 400 = 0 then 366 else 365 end as double) as f, isodow(date) - 1 as wd from daily)"""
CALENDAR = f"{b.DAILY}, {CALENDAR_ONLY}"


@query("f1_calendar_features", f"""
with {CALENDAR} select date, {r('sin(a)', 'weekday_sin')}, {r('cos(a)', 'weekday_cos')}, {r(f'sin({PI2} * f)', 'year_sin')}, {r(f'cos({PI2} * f)', 'year_cos')},
 cast(wd >= 5 as bigint) as weekend from c
""")
def _(spark, d):
    return rounded(b.daily_shipments(spark, d).select("date", *[v.alias(k) for k, v in cal.calendar_terms(F.col("date")).items()]))


def _nth(month, isodow, nth, since):
    first = f"make_date(y, {month}, 1)"
    if nth > 0:
        e = f"{first} + cast(({isodow} - isodow({first}) + 7) % 7 + {7 * (nth - 1)} as integer)"
    else:
        last = f"(make_date(y, {month + 1}, 1) - 1)"
        e = f"{last} - cast((isodow({last}) - {isodow} + 7) % 7 as integer)"
    return f"select cast({e} as date) as h from ys where y >= {since}"


def _moved(month, day, since):
    m = f"make_date(y, {month}, {day})"
    return f"select cast(case isodow({m}) when 6 then {m} - 1 when 7 then {m} + 1 else {m} end as date) as h from ys where y >= {since}"


HOLIDAYS = "ys as (select unnest(generate_series(1990, 2030)) as y), hol as (" + " union ".join(
    [_moved(*x) for x in cal.FIXED_DATES] + [_nth(*x) for x in cal.FLOATING_DAYS]) + ")"


@query("f2_us_federal_holidays", f"""
with {b.DAILY}, {HOLIDAYS} select date, cast(date in (select h from hol) as bigint) as holiday, cast(date + 1 in (select h from hol) as bigint) as before_holiday,
 cast(date - 1 in (select h from hol) as bigint) as after_holiday from daily
""")
def _(spark, d):
    return rounded(cal.holiday_flags(b.daily_shipments(spark, d).select("date"), "date"))


@query("j4_calendar_membership", f"with {b.DAILY}, {HOLIDAYS} select date, trips from daily where date in (select h from hol)")
def _(spark, d):
    holidays = cal.federal_holidays(spark, 1990, 2030)
    return b.daily_shipments(spark, d).join(F.broadcast(holidays), F.col("date") == F.col("holiday"), "left_semi").drop("series")


@query("x5_holiday_table_function", f"with {b.DAILY}, {HOLIDAYS} select h as holiday, trips from hol join daily on h = date")
def _(spark, d):
    cal.register_holiday_table(spark)
    b.daily_shipments(spark, d).createOrReplaceTempView("daymark_daily")
    return spark.sql("select holiday, trips from us_holidays(date'1995-01-01', date'2002-12-31') join daymark_daily on holiday = date")


@query("f3_harmonics", f"with {CALENDAR} select date, {r("(date - date '2023-01-01') / cast(365 as double)", 'trend')}, " + ", ".join(
    f"cast(wd = {n} as bigint) as weekday_{n}" for n in range(7)) + ", " + ", ".join(
    r(f"{g}({n} * {PI2} * f)", f"year_{g}_{n}") for n in (2, 3) for g in ("sin", "cos")) + " from c")
def _(spark, d):
    return rounded(b.daily_shipments(spark, d).select("date", *[v.alias(k) for k, v in cal.harmonic_terms(F.col("date")).items()]))


BASES = {"direct": "0", "residual7": "lag_7", "residualweekly": "weekly_mean_4", "residualblend": "(lag_7 + mean_7) / 2", "delta1": "lag_1"}


@query("f6_target_transform", f"with {FRAME}, x as (select date, ln(1 + trips) as log_to, greatest(0, exp(least(16, greatest(0, ln(1 + trips) + 0.1))) - 1) as log_back, "
       + ", ".join(f"trips - {e} as {n}_to, greatest(0, trips - {e} - 40 + {e}) as {n}_back" for n, e in BASES.items())
       + " from frame where lag_28 is not null) select date, " + rs(*[f"{n}_{s}" for n in ("log", *BASES) for s in ("to", "back")]) + " from x")
def _(spark, d):
    f = history.same_weekday(history.past_statistics(history.lags(b.daily_shipments(spark, d), (1, 7, 14, 21, 28)), (7,), kinds=("mean",))).where("lag_28 is not null")
    out = []
    for t in TARGETS:
        moved = fitted_sql("trips", t)
        out.append(F.expr(moved).alias(f"{t}_to"))
        out.append(F.expr(count_sql(f"{moved} {'+ 0.1D' if t == 'log' else '- 40D'}", t)).alias(f"{t}_back"))
    return rounded(f.select("date", *out))


@query("f7_records_json", f"with {WEEKS} select strftime(week_start, '%Y-%m-%d') as week_start, n as days, {r('contrast')} from weeks")
def _(spark, d):
    weeks = weekly.week_contrast(b.daily_shipments(spark, d)).select("week_start", F.lit(7).cast("long").alias("days"), "contrast")
    back = weekly.records_from_json(weekly.records_to_json(weeks), "week_start string, days bigint, contrast double")
    return rounded(back, skip=())


@query("f7_event_properties", "select event_type, cast(sum(cast(props->>'$.k' as bigint)) as bigint) as total, count(*) as rows from events group by 1")
def _(spark, d):
    return b.table(spark, d, "events").groupBy("event_type").agg(
        F.sum(F.get_json_object("props", "$.k").cast("long")).alias("total"), F.count(F.lit(1)).alias("rows"))


@query("p14_select_features", f"""
with {FRAME}, {CALENDAR_ONLY} select frame.date, {r('sin(a)', 'weekday_sin')}, {r('cos(a)', 'weekday_cos')}, {r(f'sin({PI2} * f)', 'year_sin')},
 {r(f'cos({PI2} * f)', 'year_cos')}, cast(wd >= 5 as bigint) as weekend, lag_1, lag_7, lag_14, {rs('mean_7', 'mean_28')} from frame join c on frame.date = c.date
""")
def _(spark, d):
    return rounded(history.select_features(b.feature_frame(spark, d), "compact"))


@query("p14_feature_frame", f"""
with {FRAME}, {HOLIDAYS}, {CALENDAR_ONLY} select frame.date, {', '.join(f'lag_{n}' for n in (1, 2, 3, 7, 14, 21, 28))},
 {rs('mean_3', 'mean_7', 'mean_14', 'mean_28', 'std_7')}, weekly_change, recent_change, {r('sin(a)', 'weekday_sin')}, {r('cos(a)', 'weekday_cos')},
 {r(f'sin({PI2} * f)', 'year_sin')}, {r(f'cos({PI2} * f)', 'year_cos')}, cast(wd >= 5 as bigint) as weekend,
 cast(frame.date in (select h from hol) as bigint) as holiday, cast(frame.date + 1 in (select h from hol) as bigint) as before_holiday,
 cast(frame.date - 1 in (select h from hol) as bigint) as after_holiday from frame join c on frame.date = c.date
""")
def _(spark, d):
    return rounded(history.select_features(b.feature_frame(spark, d), "full"))


_WEATHER_TERMS = f"""terms as (select date, temp_mean, temp_min, temp_max, rain_sum, wind_mean, wind_max, temp_max - temp_min as temp_range,
 temp_mean - lag(temp_mean, 1) over w as temp_change_1, temp_mean - lag(temp_mean, 7) over w as temp_change_7,
 case when isodow(date) >= 6 then temp_mean else 0 end as temp_weekend, greatest(0, temp_mean - 18) as warm_degree,
 greatest(0, 10 - temp_mean) as cold_degree, ln(1 + rain_sum) as rain_log, rain_sum - lag(rain_sum, 7) over w as rain_change_7,
 wind_mean - lag(wind_mean, 7) over w as wind_change_7 from weather window w as (order by date))"""
_COUNT_COLUMNS = [f"{kind}_{n}" for n in SPANS for kind in ("mean", "std", "median")] + [
    "mean_change", "relative_recent", "relative_weekly", "weekly_mean_2", "weekly_mean_3", "weekly_mean_4", "weekly_median_4"]
_CHANGES = ("temp_change_1", "temp_change_7", "rain_change_7", "wind_change_7")
_LEVELS = [n for n in history.DERIVED_WEATHER if n not in _CHANGES]


@query("p9_request_features", f"""
with {FRAME}, {HOLIDAYS}, {CALENDAR_ONLY}, {b.WEATHER}, {b.REQUEST_DAYS}, {_WEATHER_TERMS}
select frame.date, model, {', '.join(f'cast(lag_{n} as double) as lag_{n}' for n in range(1, 29))}, {rs(*_COUNT_COLUMNS)},
 cast(weekly_change as double) as weekly_change, cast(recent_change as double) as recent_change, cast(recent_low as double) as recent_low,
 cast(recent_high as double) as recent_high, {r('sin(a)', 'weekday_sin')}, {r('cos(a)', 'weekday_cos')},
 {r(f'sin({PI2} * f)', 'year_sin')}, {r(f'cos({PI2} * f)', 'year_cos')}, {r(f'sin(2 * {PI2} * f)', 'year_sin_2')}, {r(f'cos(3 * {PI2} * f)', 'year_cos_3')},
 {r("date_diff('day', date '2023-01-01', frame.date) / cast(365 as double)", 'trend')}, cast(wd >= 5 as bigint) as weekend,
 {', '.join(f'cast(wd = {n} as bigint) as weekday_{n}' for n in range(7))},
 cast(frame.date in (select h from hol) as bigint) as holiday, cast(frame.date + 1 in (select h from hol) as bigint) as before_holiday,
 cast(frame.date - 1 in (select h from hol) as bigint) as after_holiday,
 {', '.join(f"case when model <> 'counts' then {r(n, '').rsplit(' as ', 1)[0]} end as {n}" for n in _LEVELS)},
 {', '.join(f"case when model = 'weather_week' then {r(n, '').rsplit(' as ', 1)[0]} end as {n}" for n in _CHANGES)}
from frame join c on frame.date = c.date join terms on frame.date = terms.date join request_days on frame.date = request_days.date,
 (select unnest(['counts', 'weather_day', 'weather_week']) as model)
""")
def _(spark, d):
    """The feature row of every request equals the feature table on its date."""
    out = requests.request_features(b.forecast_requests(spark, d))
    names = [f"lag_{n}" for n in range(1, 29)] + _COUNT_COLUMNS + ["weekly_change", "recent_change", "recent_low", "recent_high", *history.CALENDAR,
             "year_sin_2", "year_cos_3", "trend", *[f"weekday_{n}" for n in range(7)], *history.HOLIDAYS, *_LEVELS, *_CHANGES]
    return rounded(out.where(F.size("errors") == 0).select("date", "model", *names))


@query("j1_features_with_forecast", f"""
with {LAGGED}, {b.WEATHER} select l.date, lag_1, {rs('temp_mean', 'rain_sum', 'wind_max')} from lagged l left join weather w on l.date = w.date
""")
def _(spark, d):
    features = history.lags(b.daily_shipments(spark, d), [1]).select("date", "lag_1")
    forecast = b.daily_weather(spark, d).select("date", "temp_mean", "rain_sum", "wind_max")
    return rounded(joins.require_complete(joins.with_forecast(features, forecast), ["temp_mean", "rain_sum", "wind_max"]))


@query("j2_aligned", f"""
with {b.DAILY}, {b.DAILY_ORDERS} select coalesce(a.date, o.date) as date, case when o.date is null then 'left' when a.date is null then 'right' end as only_in,
 a.trips as shipped, o.trips as ordered from daily a full join odaily o on a.date = o.date
""")
def _(spark, d):
    left = b.daily_shipments(spark, d).select("date", F.col("trips").alias("shipped"))
    right = b.daily_orders(spark, d).select("date", F.col("trips").alias("ordered"))
    return joins.aligned(left, right)


@query("j5_without_collisions", f"""
with {b.PARTS} select t.row_id, t.size, t.brand, t.kind from parts t where t.row_id % 5 <> 0 and not exists (select 1 from parts v where v.row_id % 5 = 0
 and v.size is not distinct from t.size and v.brand is not distinct from t.brand and v.kind is not distinct from t.kind)
""")
def _(spark, d):
    rows = b.incomplete(spark, d).select("row_id", "size", "brand", "kind")
    return joins.without_collisions(rows.where("row_id % 5 <> 0"), rows.where("row_id % 5 = 0"), ["size", "brand", "kind"])


@query("j6_history_arrays", f"""
with {b.DAILY}, h as (select date, list(trips) over w as p, count(*) over w as n from daily window w as (order by date range between interval 28 days preceding and interval 1 day preceding))
select date, list_aggregate(p, 'string_agg', ',') as prior from h where n = 28
""")
def _(spark, d):
    out = history.history_arrays(b.daily_shipments(spark, d))
    return out.select("date", F.concat_ws(",", F.transform("prior_counts", lambda v: v.cast("string"))).alias("prior"))


@query("j7_as_of", f"""
with {b.HOURLY}, ask as (select event_id, user_id % 3 as k, ts from events), iss as (select event_id % 3 as k, ts as issued_at, value from events where event_type = 'view')
select event_id, issued_at, value from (select ask.event_id, iss.issued_at, iss.value, row_number() over (partition by ask.event_id order by iss.issued_at desc) as n
 from ask left join iss on iss.k = ask.k and iss.issued_at <= ask.ts - interval 48 hours) where n = 1
""")
def _(spark, d):
    events = b.table(spark, d, "events")
    requests = events.select("event_id", (F.col("user_id") % 3).alias("k"), F.col("ts").alias("valid_at"))
    issues = events.where("event_type = 'view'").select((F.col("event_id") % 3).alias("k"), F.col("ts").alias("issued_at"), "value")
    out = joins.as_of(requests, issues, F.col("valid_at") - F.expr("INTERVAL 48 HOURS"), "issued_at", ["value"], ["k"])
    return out.select("event_id", "issued_at", "value")


@query("j8_fallback_routing", f"""
with {LAGGED}, {b.DAILY_ORDERS} select l.date, cast(coalesce(o.trips * 4, l.lag_7) as double) as prediction,
 case when o.date is null then 'counts' else 'weather' end as used_model from lagged l left join odaily o on l.date = o.date where l.lag_7 is not null
""")
def _(spark, d):
    base = history.lags(b.daily_shipments(spark, d), [7]).where("lag_7 is not null").select("date", "lag_7")
    preferred = b.daily_orders(spark, d).select("date", (F.col("trips") * 4).cast("double").alias("p"))
    return joins.route_with_fallback(base, preferred, ["date"], "p", "lag_7", "weather", "counts").drop("lag_7")


@query("m26_causality_check", "select cast(0 as bigint) as differing_rows, true as equal")
def _(spark, d):
    daily = b.daily_shipments(spark, d)
    changed = daily.withColumn("trips", F.when(F.col("date") >= F.lit("2000-01-01").cast("date"), F.col("trips") * 3 + 11).otherwise(F.col("trips")))
    upto = F.col("date") <= F.lit("2000-01-01").cast("date")
    a, c = (history.select_features(history.feature_frame(x), "full").where(upto) for x in (daily, changed))
    return sets.frames_equal(a, c)
