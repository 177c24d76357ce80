"""Schema and content gates. Lazy checks return booleans or error lists as rows;
``require_*`` functions run one aggregate and raise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.numeric import ratio

REQUIRED_TRIP_COLUMNS = ("ride_id", "started_at", "ended_at")
MISSING_LEVEL = "__MISSING__"
# Weather records each forecast model needs, and the longest category code.
WEATHER_DAYS = {"counts": 0, "weather_week": 8, "weather_day": 1}
LONGEST_CATEGORY = 32
HISTORY_DAYS = 28


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_TRIP_COLUMNS) -> DataFrame:
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"required columns are absent: {absent}")
    return df


def _finite(column: Column) -> Column:
    number = column.cast("double")
    return ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))


def validate_daily(daily: DataFrame, day: str = "date", value: str = "trips", series: Sequence[str] = ()) -> DataFrame:
    """One row of booleans per series (or in all)."""
    number = F.col(value).cast("double")
    good_value = F.coalesce(_finite(F.col(value)) & (number >= 0) & (number == F.floor(number)), F.lit(False))
    midnight = F.coalesce(F.col(day).cast("date").cast("timestamp_ntz") == F.col(day).cast("timestamp_ntz"), F.lit(False))
    per_day = daily.groupBy(*series, F.col(day).cast("date").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~good_value).alias("_bad"), F.count_if(~midnight).alias("_clock"))
    days = F.count(F.lit(1))
    out = per_day.groupBy(*series).agg(
        (days > 0).alias("nonempty"),
        (F.coalesce(F.max("_n"), F.lit(1)) == 1).alias("unique_dates"),
        F.coalesce(F.datediff(F.max("_day"), F.min("_day")) + 1 == days, F.lit(False)).alias("consecutive"),
        (F.coalesce(F.sum("_clock"), F.lit(0)) == 0).alias("midnight_only"),
        (F.coalesce(F.sum("_bad"), F.lit(0)) == 0).alias("whole_counts"),
    )
    return out.withColumn("valid", F.col("nonempty") & F.col("unique_dates") & F.col("consecutive")
                          & F.col("midnight_only") & F.col("whole_counts"))


def require_daily(daily: DataFrame, **kw) -> DataFrame:
    """Action: raise unless every series passes :func:`validate_daily`."""
    bad = validate_daily(daily, **kw).where(~F.col("valid")).limit(5).collect()
    if bad:
        raise ValueError(f"daily series refused: {[r.asDict() for r in bad]}")
    return daily


def drop_noise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns if present; every row stays."""
    return df.drop(*[c for c in columns if c in df.columns])


def encode_label(df: DataFrame, label: str = "class", positive: str = "p", negative: str = "e",
                 out: str = "label") -> DataFrame:
    """1 for the positive class, 0 for the negative; anything else fails the job."""
    refused = F.raise_error(F.concat(F.lit("label is not one of the two classes: "),
                                     F.coalesce(F.col(label).cast("string"), F.lit("null")))).cast("int")
    return df.withColumn(out, F.when(F.col(label) == positive, 1).when(F.col(label) == negative, 0).otherwise(refused))


def require_both_labels(df: DataFrame, label: str = "class", positive: str = "p", negative: str = "e") -> DataFrame:
    """Action: raise unless the label is complete and both classes occur."""
    seen = {r[0] for r in df.select(label).distinct().limit(4).collect()}
    if seen != {positive, negative}:
        raise ValueError(f"expected labels {{{positive}, {negative}}}, found {seen}")
    return df


def _errors(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in rules.items()]))


def validate_records(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                     keep: Sequence[str] = ()) -> DataFrame:
    """Empty categories become null; ``errors`` lists the fields that break a rule."""
    expected = set(numeric) | set(categorical) | set(keep)
    if set(df.columns) != expected:
        raise ValueError(f"supply exactly these fields: {sorted(expected)}")
    rules = {}
    for c in numeric:
        rules[c] = F.col(c).isNotNull() & ~(_finite(F.col(c)) & (F.col(c) >= 0))
    for c in categorical:
        rules[c] = F.col(c).isNotNull() & (F.length(c) > LONGEST_CATEGORY)
    cleaned = df.withColumn("errors", _errors(rules))
    return cleaned.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in categorical})


def _iso_date(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_date(text, "yyyy-MM-dd"))


def validate_forecast_request(df: DataFrame, weather_days: dict[str, int] | None = None) -> DataFrame:
    """Add ``errors`` to requests of (model, prediction_date, prior_counts, forecasts)."""
    needed = F.coalesce(*[F.when(F.col("model") == m, F.lit(n)) for m, n in (weather_days or WEATHER_DAYS).items()])
    day = _iso_date(F.col("prediction_date"))
    counts, records = F.col("prior_counts"), F.col("forecasts")
    whole = F.forall(counts, lambda v: v.isNotNull() & _finite(v) & (v >= 0) & (v == F.floor(v)))
    total = F.aggregate(counts, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))
    names = ("temp_mean", "temp_min", "temp_max", "rain_sum", "wind_mean", "wind_max")

    def each(check):
        return F.forall(records, lambda r: F.coalesce(check(r), F.lit(False)))

    def finite_record(r):
        ok = _finite(r[names[0]])
        for n in names[1:]:
            ok = ok & _finite(r[n])
        return ok

    first_day = F.date_sub(day, needed - 1)
    dated = F.transform(records, lambda r, i: F.coalesce(_iso_date(r["date"]) == F.date_add(first_day, i), F.lit(False)))
    return df.withColumn("errors", _errors({
        "model": needed.isNull(),
        "prediction_date": day.isNull(),
        "history_length": F.size(counts) != HISTORY_DAYS,
        "history_values": ~whole | (total == 0),
        "forecast_count": F.size(records) != needed,
        "forecast_dates": ~F.forall(dated, lambda ok: ok),
        "forecast_numbers": ~each(finite_record),
        "temperature_order": ~each(lambda r: (r["temp_min"] <= r["temp_mean"]) & (r["temp_mean"] <= r["temp_max"])),
        "wind_order": ~each(lambda r: r["wind_mean"] <= r["wind_max"]),
        "negative_weather": ~each(lambda r: (r["rain_sum"] >= 0) & (r["wind_mean"] >= 0) & (r["wind_max"] >= 0)),
    }))


def feature_design(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], noise: Sequence[str] = (),
                   ratios: Sequence[tuple[str, str]] = (), include_noise: bool = False, engineered: bool = False,
                   missing_counts: bool = False, drop: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Stateless feature hypotheses; nothing here is learned from the label."""
    columns = [c for c in [*numeric, *categorical, *(noise if include_noise else ())] if c not in drop]
    out = [F.col(c) for c in [*keep, *columns]]
    if engineered:
        out += [F.when(F.col(c).isNotNull(), F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))))
                .alias(f"{c}_log1p") for c in numeric]
        out += [ratio(F.col(a), F.col(b)).alias(f"{a}_over_{b}") for a, b in ratios]
    if missing_counts:
        out.append(count_missing(numeric).alias("missing_numeric_count"))
        out.append(count_missing(categorical).alias("missing_categorical_count"))
    return df.select(*out)


def count_missing(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNull().cast("int")
    return total


def fill_and_flag(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = (),
                  token: str = MISSING_LEVEL) -> DataFrame:
    """Categorical null becomes a level of its own; each listed numeric gets a 0/1 flag."""
    out = {c: F.coalesce(F.col(c), F.lit(token)) for c in categorical}
    out.update({f"{c}_was_missing": F.col(c).isNull().cast("int") for c in numeric})
    return df.withColumns(out)


def cut_reserved(df: DataFrame, last_allowed: str, day: str = "date") -> DataFrame:
    """Remove reserved targets before anything is computed from them."""
    return df.where(F.col(day) <= F.lit(last_allowed).cast("date"))


def require_before(df: DataFrame, reserved_from: str, day: str = "date") -> DataFrame:
    """Action: raise if any row reaches the reserved period."""
    newest = df.agg(F.max(day).cast("string")).first()[0]
    if newest is not None and newest[:10] >= reserved_from:
        raise ValueError(f"rows reach {newest}, inside the reserved period from {reserved_from}")
    return df
