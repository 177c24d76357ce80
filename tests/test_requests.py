"""Requests to features and forecasts: plans without shuffles, agreement with the stored series, refusals."""

import pytest
from pyspark.sql import functions as F

from daymark.operators import history
from daymark.plans import bindings as b
from daymark.plans import forecasting, requests

RECORD = "array<struct<date string, temp_mean double, temp_min double, temp_max double, rain_sum double, wind_mean double, wind_max double>>"
SCHEMA = f"asked int, model string, prediction_date string, prior_counts array<double>, forecasts {RECORD}"
COUNTS = [float(20 + i % 7) for i in range(28)]


def week(last=8, rain=0.5):
    return [(f"2024-03-0{d}", 5.0 + d, 1.0, 20.0, rain, 3.0, 6.0) for d in range(1, last + 1)]


@pytest.fixture(scope="module")
def models(spark):
    rows = b.daily_shipments(spark, "/root/testdata/sf0.01")
    frame = history.feature_frame(rows).join(history.weather_changes(b.daily_weather(spark, "/root/testdata/sf0.01")).drop("series"), "date")
    frame = frame.where("lag_28 is not null and temp_change_7 is not null").cache()
    fit = lambda s: forecasting.ResidualForecaster("ridge", s, alpha=10.0).fit(frame)
    sets = {"counts": "full", "weather_day": "weather_full", "weather_week": "weather_derived_full"}
    return frame, {n: (fit(s), history.FEATURE_SETS[s]) for n, s in sets.items()}


def test_features_take_no_shuffle(spark, models):
    df = spark.createDataFrame([(1, "counts", "2024-03-08", COUNTS, [])], SCHEMA)
    for out in (requests.request_features(df), requests.forecast_requests(df, models[1])):
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Window" not in text and "EvalPython" not in text


def test_batch_forecasts_equal_those_on_the_stored_series(spark, models):
    frame, fitted = models
    asked = b.forecast_requests(spark, "/root/testdata/sf0.01")
    got = requests.forecast_requests(asked, fitted, ["prediction_date"])
    assert got.where(F.size("errors") > 0).count() == 0
    for name, (model, _) in fitted.items():
        want = {str(r["date"]): r["prediction"] for r in model.transform(frame).select("date", "prediction").collect()}
        mine = {r["prediction_date"]: r["unrounded_prediction"] for r in got.where(F.col("model") == name).collect()}
        assert len(mine) > 2000
        for day, value in mine.items():
            assert value == pytest.approx(want[day], rel=1e-9)


def test_refusals_fallback_and_withheld_forecasts(spark, models):
    rows = [
        (1, "counts", "2024-03-08", COUNTS, []), (2, "weather_week", "2024-03-08", COUNTS, week()), (3, "weather_week", "2024-03-08", COUNTS, []),
        (4, "weather_day", "2024-03-08", COUNTS, []), (5, "counts", "2024-03-08", COUNTS[:27], []), (6, "counts", "2024-3-8", COUNTS, []),
        (7, "other", "2024-03-08", COUNTS, []), (8, None, None, None, None), (9, "counts", "2024-03-08", [0.0] * 28, []),
        (10, "counts", "2024-03-08", [1.0] + [0.0] * 27, []), (11, "weather_day", "2024-03-08", COUNTS, week(1, -0.5)),
        (12, "weather_day", "2024-03-01", COUNTS, week(1)), (13, "counts", "2024-03-08", COUNTS[:27] + [None], [])]
    got = {r["asked"]: r for r in requests.forecast_requests(spark.createDataFrame(rows, SCHEMA), models[1], ["asked"]).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["prediction"] == round(got[i]["unrounded_prediction"]) for i in (1, 2, 3, 12))
    assert got[3]["model"] == "counts" and got[3]["requested_model"] == "weather_week" and got[3]["missing_forecast_fallback"]
    assert got[3]["unrounded_prediction"] == got[1]["unrounded_prediction"] and got[3]["note"] == requests.FALLBACK_NOTE
    assert got[4]["errors"] == ["forecast_count"] and got[5]["errors"] == ["history_length"] and got[6]["errors"] == ["prediction_date"]
    assert "model" in got[7]["errors"] and "model" in got[8]["errors"] and got[9]["errors"] == ["history_values"]
    assert "negative_weather" in got[11]["errors"] and got[13]["errors"] == ["history_values"]
    assert got[10]["errors"] in ([], ["prediction"]) and all(got[i]["prediction"] is None for i in (4, 5, 6, 7, 8, 9, 11, 13))


def test_a_history_without_finite_features_is_refused(spark):
    df = spark.createDataFrame([(1, "counts", "2024-03-08", [5.0] + [0.0] * 27, [])], SCHEMA)
    assert requests.request_features(df, required=["relative_recent"]).first()["errors"] == ["features"]
    assert requests.request_features(df, required=["lag_28", "mean_28"]).first()["errors"] == []
    wide = forecasting.BaselineForecaster("lag_7").fit(df)
    out = requests.forecast_requests(df, {"counts": (wide, ["lag_7", "relative_recent"])}).first()
    assert out["errors"] == ["features"] and out["prediction"] is None
