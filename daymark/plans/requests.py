"""From forecast requests to feature rows and forecasts, for whole batches.

A request brings its own history: 28 counts, oldest first, and the dated weather records that its model
needs. All features are expressions over that one array, so a request is one row in and one row out: no
window, no shuffle and no join with a stored series. The names and values are those of
``history.feature_frame`` and ``history.weather_changes`` on the same days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions import calendar as cal
from daymark.operators import history, validate

COUNTS_MODEL = "counts"
FALLBACK_NOTE = "Weather forecasts unavailable: answered by the counts model."


def _span(n: int) -> Column:
    """The last ``n`` counts."""
    return F.slice(F.col("prior_counts"), -n, n)


def _mean(values: Column, n: int) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / F.lit(float(n))


def _deviation(n: int) -> Column:
    mean = F.col(f"mean_{n}")
    return F.sqrt(F.aggregate(_span(n), F.lit(0.0), lambda total, v: total + (v - mean) * (v - mean)) / F.lit(float(n)))


def _median(n: int) -> Column:
    ordered = F.sort_array(_span(n))
    return (F.element_at(ordered, (n + 1) // 2) + F.element_at(ordered, n // 2 + 1)) / F.lit(2.0)


def count_features(requests: DataFrame, day: str = "date", origin: str = "2023-01-01",
                   spans: Sequence[int] = history.SPANS) -> DataFrame:
    """Add the columns of ``history.feature_frame`` from ``prior_counts``, an array of 28 doubles, oldest first."""
    counts = F.col("prior_counts")
    out = requests.withColumns({f"lag_{n}": F.element_at(counts, -n) for n in range(1, history.HISTORY_DAYS + 1)})
    out = out.withColumns({f"mean_{n}": _mean(_span(n), n) for n in spans})
    out = out.withColumns({f"std_{n}": _deviation(n) for n in spans} | {f"median_{n}": _median(n) for n in spans})
    out = out.withColumns({"recent_low": F.array_min(_span(7)), "recent_high": F.array_max(_span(7))})
    out = history.same_weekday(history.change_features(out))
    out = out.withColumns(cal.calendar_terms(F.col(day)) | cal.harmonic_terms(F.col(day), origin))
    return cal.holiday_flags(out, day)


def weather_features(requests: DataFrame, day: str = "date") -> DataFrame:
    """Add the weather columns from ``forecasts``, dated records of which the last is the requested day's.

    Null without records; the changes need the eight records of a week.
    """
    records = F.col("forecasts")
    newest = F.try_element_at(records, F.lit(-1))
    out = requests.withColumns({n: newest[n] for n in history.BASE_WEATHER})

    def change(name: str, back: int) -> Column:
        return F.when(F.size(records) >= 8, F.col(name) - F.try_element_at(records, F.lit(-1 - back))[name])

    known = F.col("temp_mean").isNotNull()  # ``greatest`` would pass over a missing mean
    weekend = (cal.weekday(F.col(day)) >= 5).cast("int")
    return out.withColumns({
        "temp_range": F.col("temp_max") - F.col("temp_min"),
        "temp_change_1": change("temp_mean", 1), "temp_change_7": change("temp_mean", 7),
        "temp_weekend": F.col("temp_mean") * weekend,
        "warm_degree": F.when(known, F.greatest(F.lit(0.0), F.col("temp_mean") - 18.0)),
        "cold_degree": F.when(known, F.greatest(F.lit(0.0), F.lit(10.0) - F.col("temp_mean"))),
        "rain_log": F.log1p("rain_sum"),
        "rain_change_7": change("rain_sum", 7), "wind_change_7": change("wind_mean", 7),
    })


def all_finite(names: Sequence[str]) -> Column:
    ok = F.lit(True)
    for name in names:
        value = F.col(name).cast("double")
        ok = ok & value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return ok


def request_features(requests: DataFrame, weather_days: dict[str, int] | None = None, required: Sequence[str] = (),
                     origin: str = "2023-01-01") -> DataFrame:
    """Validated requests with ``date``, ``errors`` and every feature.

    A refused request keeps its row and errors and has null features. ``required`` names features
    that must come out finite; a history that cannot give them is the error ``features``.
    """
    checked = validate.validate_forecast_request(requests, weather_days)
    sound = F.size("errors") == 0
    usable = checked.withColumns({
        "date": F.when(sound, F.try_to_date("prediction_date", "yyyy-MM-dd")),
        "prior_counts": F.when(sound, F.col("prior_counts")), "forecasts": F.when(sound, F.col("forecasts"))})
    featured = weather_features(count_features(usable, origin=origin))
    kept = featured.drop("prior_counts", "forecasts")
    return kept.withColumn("errors", F.when(sound & ~all_finite(required), F.array_append("errors", F.lit("features"))).otherwise(F.col("errors")))


def with_fallback(requests: DataFrame, fallback_of: dict[str, str]) -> DataFrame:
    """Add ``requested_model`` and ``missing_forecast_fallback``; a request without any weather record
    goes to the counts model that ``fallback_of`` names for its model."""
    other = F.coalesce(*[F.when(F.col("model") == m, F.lit(to)) for m, to in fallback_of.items()], F.lit(None).cast("string"))
    missing = F.coalesce(other.isNotNull() & (F.size("forecasts") == 0), F.lit(False))
    return requests.withColumn("requested_model", F.col("model")).withColumn("missing_forecast_fallback", missing).withColumn(
        "model", F.when(missing, other).otherwise(F.col("model")))


def forecast_requests(requests: DataFrame, models: dict[str, tuple[PipelineModel, Sequence[str]]], keep: Sequence[str] = (),
                      weather_days: dict[str, int] | None = None, fallback_of: dict[str, str] | None = None,
                      output: str = "prediction") -> DataFrame:
    """One row per request: ``keep``, requested_model, model, missing_forecast_fallback, errors, prediction,
    unrounded_prediction and note.

    ``models`` holds each model with the features it reads. Every sound request is scored by its model alone;
    a forecast that is not finite or below zero is withheld with the error ``prediction``.
    """
    routed = with_fallback(requests, fallback_of if fallback_of is not None else {"weather_week": COUNTS_MODEL})
    featured = request_features(routed, weather_days)
    told = ["requested_model", "model", "missing_forecast_fallback", "errors"]
    sound = F.size("errors") == 0
    refused = featured.where(~sound | ~F.coalesce(F.col("model").isin(*models), F.lit(False)))
    parts = [refused.select(*keep, *told, F.lit(None).cast("double").alias("unrounded_prediction"))]
    for name, (model, needed) in models.items():
        mine = featured.where(sound & (F.col("model") == name))
        finite = all_finite(needed)
        mine = mine.withColumn("errors", F.when(~finite, F.array_append("errors", F.lit("features"))).otherwise(F.col("errors")))
        # A history that gives no finite features is scored as zeros, then its forecast is withheld.
        safe = mine.withColumns({f: F.when(finite, F.col(f)).otherwise(F.lit(0).cast(dict(mine.dtypes)[f])) for f in needed})
        out = model.transform(safe)
        value = F.when(F.size("errors") == 0, F.col(output).cast("double"))
        parts.append(out.select(*keep, *told, value.alias("unrounded_prediction")))
    answers = parts[0]
    for part in parts[1:]:
        answers = answers.unionByName(part)
    value = F.col("unrounded_prediction")
    wrong = value.isNotNull() & (F.isnan(value) | (F.abs(value) == float("inf")) | (value < 0))
    answers = answers.withColumn("errors", F.when(wrong, F.array_append("errors", F.lit("prediction"))).otherwise(F.col("errors")))
    answers = answers.withColumn("unrounded_prediction", F.when(~wrong, value))
    return answers.withColumns({
        "prediction": F.rint("unrounded_prediction").cast("long"),
        "note": F.when(F.col("missing_forecast_fallback"), F.lit(FALLBACK_NOTE)),
    })
