"""Strictly causal features over daily series.

Every function takes one row per (series, date). A series is bounded by the calendar (one
row per day), so a window per series is bounded too; many series spread over the cluster.
All lags and past statistics share one window order, so Spark plans one shuffle and one sort
for the whole feature table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from daymark.functions import calendar as cal
from daymark.functions.numeric import ratio

HISTORY_DAYS = 28
SPANS = (2, 3, 5, 7, 10, 14, 21, 28)

# The named feature sets.
CALENDAR = ["weekday_sin", "weekday_cos", "year_sin", "year_cos", "weekend"]
HOLIDAYS = ["holiday", "before_holiday", "after_holiday"]
COMPACT = CALENDAR + ["lag_1", "lag_7", "lag_14", "mean_7", "mean_28"]
FULL = CALENDAR + [f"lag_{n}" for n in (1, 2, 3, 7, 14, 21, 28)] + [
    "mean_3", "mean_7", "mean_14", "mean_28", "std_7", "weekly_change", "recent_change"] + HOLIDAYS
WEEKLY = CALENDAR + [f"lag_{n}" for n in (1, 7, 14, 21, 28)] + [
    "weekly_mean_2", "weekly_mean_4", "weekly_median_4", "mean_7", "mean_28", "weekly_change", "holiday"]
RECENT = CALENDAR + [f"lag_{n}" for n in range(1, 8)] + [
    "mean_3", "mean_7", "mean_14", "mean_28", "std_7", "holiday"]
LINEAR = [f"weekday_{n}" for n in range(7)] + ["year_sin", "year_cos", "year_sin_2", "year_cos_2", "trend"] + \
    HOLIDAYS + [f"lag_{n}" for n in (1, 2, 3, 7, 14, 21, 28)] + [
    "mean_3", "mean_7", "mean_14", "mean_28", "std_7", "weekly_change", "recent_change"]
BASE_WEATHER = ["temp_mean", "temp_min", "temp_max", "rain_sum", "wind_mean", "wind_max"]
DERIVED_WEATHER = BASE_WEATHER + [
    "temp_range", "temp_change_1", "temp_change_7", "temp_weekend", "warm_degree", "cold_degree",
    "rain_log", "rain_change_7", "wind_change_7"]
EXPANDED = CALENDAR + HOLIDAYS + [f"lag_{n}" for n in range(1, HISTORY_DAYS + 1)] + [
    f"{kind}_{n}" for n in SPANS for kind in ("mean", "std", "median")] + [
    "recent_low", "recent_high", "weekly_change", "recent_change", "mean_change", "relative_recent", "relative_weekly",
    "weekly_mean_2", "weekly_mean_3", "weekly_mean_4", "weekly_median_4"] + [f"weekday_{n}" for n in range(7)] + [
    "year_sin_2", "year_cos_2", "year_sin_3", "year_cos_3", "trend"]
FEATURE_SETS = {"compact": COMPACT, "expanded": EXPANDED, "full": FULL, "weekly": WEEKLY, "recent": RECENT, "linear": LINEAR, "last_week": ["lag_7"]}
for _base in ("compact", "full", "weekly", "linear"):
    FEATURE_SETS[f"weather_{_base}"] = FEATURE_SETS[_base] + BASE_WEATHER
    FEATURE_SETS[f"weather_derived_{_base}"] = FEATURE_SETS[_base] + DERIVED_WEATHER


def _by_day(series: Sequence[str], day: str):
    return W.partitionBy(*series).orderBy(day)


def lags(df: DataFrame, steps: Sequence[int] = range(1, HISTORY_DAYS + 1), value: str = "trips",
         series: Sequence[str] = ("series",), day: str = "date") -> DataFrame:
    window = _by_day(series, day)
    return df.withColumns({f"lag_{n}": F.lag(value, n).over(window) for n in steps})


def _middle(columns: Sequence[Column]) -> Column:
    """Median of the given columns, none of them null."""
    n = len(columns)
    ordered = F.sort_array(F.array(*[c.cast("double") for c in columns]))
    return (F.element_at(ordered, (n + 1) // 2) + F.element_at(ordered, n // 2 + 1)) / F.lit(2.0)


def past_statistics(df: DataFrame, spans: Sequence[int] = SPANS, value: str = "trips",
                    series: Sequence[str] = ("series",), day: str = "date",
                    kinds: Sequence[str] = ("mean", "std", "median")) -> DataFrame:
    """``mean_n``, ``std_n`` (population) and ``median_n`` of the previous ``n`` days.

    Null unless all ``n`` days hold a value. Frames end one row before the current day. The
    median reads the lag columns, since a quantile over a sliding frame is rebuilt per row.
    """
    window = _by_day(series, day)
    out = {}
    for n in spans:
        frame = window.rowsBetween(-n, -1)
        whole = F.count(value).over(frame) == n
        if "mean" in kinds:
            out[f"mean_{n}"] = F.when(whole, F.avg(value).over(frame))
        if "std" in kinds:
            out[f"std_{n}"] = F.when(whole, F.stddev_pop(value).over(frame))
        if "median" in kinds:
            out[f"median_{n}"] = F.when(whole, _middle([F.col(f"lag_{i}") for i in range(1, n + 1)]))
    return df.withColumns(out)


def past_extremes(df: DataFrame, n: int = 7, value: str = "trips", series: Sequence[str] = ("series",),
                  day: str = "date") -> DataFrame:
    """``recent_low`` and ``recent_high`` of the previous ``n`` days."""
    frame = _by_day(series, day).rowsBetween(-n, -1)
    whole = F.count(value).over(frame) == n
    return df.withColumns({
        "recent_low": F.when(whole, F.min(value).over(frame)),
        "recent_high": F.when(whole, F.max(value).over(frame)),
    })


def change_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "weekly_change": F.col("lag_7") - F.col("lag_14"),
        "recent_change": F.col("lag_1") - F.col("lag_7"),
        "mean_change": F.col("mean_7") - F.col("mean_14"),
        "relative_recent": ratio(F.col("lag_1"), F.col("mean_7")),
        "relative_weekly": ratio(F.col("lag_7"), F.col("mean_28")),
    })


def same_weekday(df: DataFrame) -> DataFrame:
    """Means of the last 2, 3 and 4 same weekdays (null days left out) and the median of 4."""
    matching = [F.col(f"lag_{n}") for n in (7, 14, 21, 28)]
    out = {}
    for k in (2, 3, 4):
        total, held = F.lit(0), F.lit(0)
        for c in matching[:k]:
            total = total + F.coalesce(c, F.lit(0))
            held = held + c.isNotNull().cast("int")
        out[f"weekly_mean_{k}"] = ratio(total, held)
    kept = F.sort_array(F.array_compact(F.array(*[c.cast("double") for c in matching])))
    n = F.size(kept)
    low = F.element_at(kept, F.greatest(F.lit(1), F.floor((n + 1) / 2).cast("int")))
    high = F.element_at(kept, F.greatest(F.lit(1), F.floor(n / 2).cast("int") + 1))
    out["weekly_median_4"] = F.when(n > 0, (low + high) / F.lit(2.0))
    return df.withColumns(out)


def one_step_features(daily: DataFrame, series: Sequence[str] = ("series",), value: str = "trips",
                      day: str = "date") -> DataFrame:
    """weekday, month, lag 1, lag 7 and the mean of the previous seven days; whole rows only."""
    window = _by_day(series, day)
    past = window.rowsBetween(-7, -1)
    out = daily.withColumns({
        "weekday": cal.weekday(F.col(day)),
        "month": F.month(day),
        "lag_1": F.lag(value, 1).over(window),
        "lag_7": F.lag(value, 7).over(window),
        "past_7_day_mean": F.when(F.count(value).over(past) == 7, F.avg(value).over(past)),
    })
    return out.dropna(subset=["lag_1", "lag_7", "past_7_day_mean"])


def trailing_mean(daily: DataFrame, n: int = 7, series: Sequence[str] = ("series",), value: str = "trips",
                  day: str = "date") -> DataFrame:
    """Descriptive only: the frame holds the current day, so it must never be a feature."""
    frame = _by_day(series, day).rowsBetween(-(n - 1), 0)
    return daily.withColumn(
        f"trailing_mean_{n}", F.when(F.count(value).over(frame) == n, F.avg(value).over(frame)))


def feature_frame(daily: DataFrame, series: Sequence[str] = ("series",), value: str = "trips",
                  day: str = "date", origin: str = "2023-01-01") -> DataFrame:
    """The wide feature table: calendar, holidays, lags, past statistics, changes, harmonics."""
    where = {"value": value, "series": series, "day": day}
    out = past_extremes(past_statistics(lags(daily, **where), **where), **where)
    out = same_weekday(change_features(out))
    out = out.withColumns(cal.calendar_terms(F.col(day)))
    out = out.withColumns(cal.harmonic_terms(F.col(day), origin))
    return cal.holiday_flags(out, day)


def select_features(frame: DataFrame, name: str, keep: Sequence[str] = ("date",)) -> DataFrame:
    if name not in FEATURE_SETS:
        raise ValueError(f"unknown feature set {name!r}; choose from {sorted(FEATURE_SETS)}")
    return frame.select(*keep, *FEATURE_SETS[name])


def history_arrays(daily: DataFrame, n: int = HISTORY_DAYS, series: Sequence[str] = ("series",),
                   value: str = "trips", day: str = "date") -> DataFrame:
    """Add ``prior_counts``: the totals of [d-n, d-1], oldest first; rows without all n days go.

    The frame is by date, not by row, so a gap leaves fewer than ``n`` values and the row is
    dropped instead of reaching further back.
    """
    number = F.unix_date(F.col(day))
    window = W.partitionBy(*series).orderBy(number).rangeBetween(-n, -1)
    out = daily.withColumn("prior_counts", F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(day).alias("d"), F.col(value).alias("v"))).over(window)),
        lambda x: x["v"]))
    return out.where(F.size("prior_counts") == n)


def weather_changes(daily: DataFrame, series: Sequence[str] = ("series",), day: str = "date") -> DataFrame:
    """Differences, degree terms and interactions of the six daily forecast columns."""
    window = _by_day(series, day)

    def change(name: str, n: int) -> Column:
        return F.col(name) - F.lag(name, n).over(window)

    weekend = (cal.weekday(F.col(day)) >= 5).cast("int")
    return daily.withColumns({
        "temp_range": F.col("temp_max") - F.col("temp_min"),
        "temp_change_1": change("temp_mean", 1),
        "temp_change_7": change("temp_mean", 7),
        "temp_weekend": F.col("temp_mean") * weekend,
        "warm_degree": F.greatest(F.lit(0.0), F.col("temp_mean") - 18.0),
        "cold_degree": F.greatest(F.lit(0.0), F.lit(10.0) - F.col("temp_mean")),
        "rain_log": F.log1p("rain_sum"),
        "rain_change_7": change("rain_sum", 7),
        "wind_change_7": change("wind_mean", 7),
    })


def autocorrelation(daily: DataFrame, max_lag: int = HISTORY_DAYS, series: Sequence[str] = ("series",),
                    value: str = "trips", day: str = "date") -> DataFrame:
    """Pearson correlation with the value ``k`` rows earlier; null when either side is constant."""
    lagged = lags(daily.select(*series, day, value), range(1, max_lag + 1), value, series, day)
    pairs = lagged.select(*series, F.col(value).cast("double").alias("_x"), F.inline(F.array(*[
        F.struct(F.lit(k).cast("long").alias("lag"), F.col(f"lag_{k}").cast("double").alias("_y"))
        for k in range(1, max_lag + 1)])))
    pairs = pairs.where(F.col("_y").isNotNull() & F.col("_x").isNotNull())
    return pairs.groupBy(*series, "lag").agg(
        F.count(F.lit(1)).alias("pairs"),
        ratio(F.covar_pop("_x", "_y"), F.stddev_pop("_x") * F.stddev_pop("_y")).alias("correlation"),
    )


def seasonal_average(decay: float = 1.0, adjustment: float = 0.0) -> Column:
    """Decay-weighted mean of lags 7, 14, 21, 28 with a bounded recent-level correction."""
    weights = [decay ** i for i in range(4)]
    total = F.lit(0.0)
    for w, n in zip(weights, (7, 14, 21, 28)):
        total = total + F.lit(w) * F.col(f"lag_{n}")
    level = F.col("mean_7") / F.greatest(F.lit(1.0), F.col("mean_28"))
    bounded = F.least(F.lit(2.0), F.greatest(F.lit(0.5), level))
    return total / F.lit(sum(weights)) * F.pow(bounded, F.lit(adjustment))


def historical_baseline(kind: str = "lag_7", blend: float = 0.0, trend: float = 0.0) -> Column:
    """A named past value, optionally blended with the 7-day mean and moved by the mean change."""
    primary = F.lit(1.0 - blend) * F.col(kind) + F.lit(blend) * F.col("mean_7")
    return F.greatest(F.lit(0.0), primary + F.lit(trend) * (F.col("mean_7") - F.col("mean_14")))


def recency_weights(df: DataFrame, half_life: float, series: Sequence[str] = ("series",),
                    day: str = "date") -> DataFrame:
    """Add ``weight``: 1 for the newest row, halved every ``half_life`` rows back."""
    rows_after = F.row_number().over(W.partitionBy(*series).orderBy(F.col(day).desc())) - 1
    return df.withColumn("weight", F.pow(F.lit(2.0), -rows_after / F.lit(float(half_life))))


def sequence_array(df: DataFrame, n: int = HISTORY_DAYS) -> DataFrame:
    """Add ``sequence``: log1p of each past count less log1p of the 28-day mean, oldest first."""
    past = F.array(*[F.col(f"lag_{i}").cast("double") for i in range(n, 0, -1)])
    return df.withColumn("sequence", F.transform(
        past, lambda v: (F.log1p(v) - F.log1p(F.col("mean_28"))).cast("float")))
