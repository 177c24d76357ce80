"""Hand-computed micro-tables: clocks, ids, gaps, zones, requests, archives, reports."""

import io
import math
import zipfile
import zlib
from datetime import date, datetime

import pandas as pd
import pytest
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from daymark.functions import calendar as cal
from daymark.functions import clock, numeric, special
from daymark.operators import audit, history, joins, profile, resample, scoring, sets, split, validate, weather, weekly
from daymark.sources import hourly_json, tables, zip_csv


def days(spark, first, values, series="all"):
    start = date.fromisoformat(first).toordinal()
    return spark.createDataFrame([(series, date.fromordinal(start + i), v) for i, v in enumerate(values)],
                                 "series string, date date, trips long")


# Clocks and ids -------------------------------------------------------------------------

def test_clock_labels(spark):
    texts = ["2023-01-01 00:00:05", "2023-01-01 00:00:05.250", "1/31/2015 13:05", "2/30/2015 13:05", "12:30:00", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(clock.parse_clock(F.col("t"))).collect()]
    assert got == [datetime(2023, 1, 1, 0, 0, 5), datetime(2023, 1, 1, 0, 0, 5, 250000), datetime(2015, 1, 31, 13, 5), None, None, None, None]


def test_labels_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2023-03-12 02:30:00", "2023-03-12 03:30:00")], "s string, e string")
    clocks = df.select(clock.parse_clock(F.col("s")).alias("s"), clock.parse_clock(F.col("e")).alias("e"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = clocks.select("s", clock.seconds_between(F.col("s"), F.col("e")).alias("gap")).first()
        day = hours(spark, "2023-11-05 00:00:00", "2023-11-05 23:00:00").withColumn("temp", F.lit(1.0))
        assert weather.hourly_to_daily(day, ["temp"]).collect()[0]["hours"] == 25
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row["s"], row["gap"]) == (datetime(2023, 3, 12, 2, 30), 3600.0)


@pytest.mark.parametrize("text", ["2023-01-01 00:00:05+05:00", "2023-01-01T00:00:05Z", "2023-01-01 00:00 -0400"])
def test_an_offset_is_an_error(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="offset"):
        df.select(clock.parse_clock(F.col("t"))).collect()


def test_hex_ids(spark):
    ids = ["0123456789abcdef", "0123456789ABCDEF", "0123456789abcde", "0123456789abcdeg", "0123456789abcdef\n", None]
    df = spark.createDataFrame([(i,) for i in ids], "i string")
    assert [r[0] for r in df.select(clock.is_hex_id(F.col("i"))).collect()] == [True, True, False, False, False, False]


def test_issue_counts(spark):
    rows = [
        ("2022-12-31 23:59:00", "2023-01-01 00:05:00"),  # starts in the year before
        ("2023-03-12 02:30:00", "2023-03-12 02:30:00"),  # hour that does not exist, zero seconds
        ("2023-11-05 01:10:00", "2023-11-05 01:09:00"),  # repeated hour, negative
        ("2023-05-01 10:00:00", "2023-05-01 10:00:30"),  # thirty seconds
        ("2023-05-01 10:00:00", "2023-05-02 11:00:00"),  # twenty-five hours
        (None, "2023-05-01 10:00:00"),
    ]
    df = spark.createDataFrame(rows, "s string, e string").select(
        clock.parse_clock(F.col("s")).alias("started_at"), clock.parse_clock(F.col("e")).alias("ended_at"),
        F.lit("a.zip!/202305-trips_1.csv").alias("_member"))
    got = audit.issue_counts(df, 2023, member="_member", spring_date="2023-03-12", autumn_date="2023-11-05").first().asDict()
    assert got == {
        "unparsed_start": 1, "unparsed_end": 0, "outside_selected_year": 1, "negative_clock_duration": 1,
        "zero_clock_duration": 1, "under_60_second_clock_duration": 2, "over_24_hour_clock_duration": 1,
        "start_outside_filename_month": 3, "end_outside_filename_month": 3,
        "spring_nonexistent_clock_hour": 1, "autumn_ambiguous_clock_hour": 1}


def test_reconcile_refuses_unparsed_rows(spark):
    df = spark.createDataFrame([("2023-01-01",), ("2022-01-01",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("started_at"))
    with pytest.raises(ValueError, match="reconcile"):
        audit.require_reconciled(df, 2023)
    assert audit.require_reconciled(df.where("started_at is not null"), 2023)["counted"] == 1


# Calendar -------------------------------------------------------------------------------

def test_holidays_match_the_public_calendar(spark):
    first, last = date(1985, 1, 1), date(2035, 12, 31)
    df = spark.sql(f"select explode(sequence(date'{first}', date'{last}')) as day")
    got = {r[0] for r in df.where(cal.is_federal_holiday(F.col("day"))).collect()}
    want = {d.date() for d in USFederalHolidayCalendar().holidays(str(first), str(last))}
    assert got == want
    rules = {d for y in range(1984, 2037) for d in cal.observed_holidays(y) if first <= d <= last}
    assert rules == want
    assert {date(2021, 12, 31), date(2021, 6, 18)} <= got


def test_leap_year_fraction(spark):
    df = spark.createDataFrame([(date(2024, 12, 31),), (date(2023, 12, 31),)], "d date")
    assert [r[0] for r in df.select(cal.year_fraction(F.col("d"))).collect()] == [365 / 366, 364 / 365]


# Daily series ---------------------------------------------------------------------------

def test_validate_daily_finds_each_fault(spark):
    good = days(spark, "2023-02-26", [1, 2, 3, 4])
    assert validate.validate_daily(good).first()["valid"]
    gap = good.where("trips <> 2")
    assert not validate.validate_daily(gap).first()["consecutive"]
    twice = good.unionByName(good.limit(1))
    assert not validate.validate_daily(twice).first()["unique_dates"]
    for bad in ("-1", "0.5", "cast(null as double)", "double('nan')", "double('inf')"):
        assert not validate.validate_daily(good.withColumn("trips", F.expr(bad))).first()["whole_counts"]
    clocked = good.withColumn("date", F.expr("cast(date as timestamp_ntz) + interval 1 hour"))
    assert not validate.validate_daily(clocked).first()["midnight_only"]
    assert not validate.validate_daily(good.limit(0)).first()["valid"]
    with pytest.raises(ValueError):
        sets.union_history(good, gap, strict=True)


def test_features_use_only_the_past(spark):
    daily = days(spark, "2023-01-01", list(range(100, 140)))
    last = history.feature_frame(daily).orderBy(F.col("date").desc()).first()
    past = list(range(111, 139))  # the 28 days before the last
    assert (last["lag_1"], last["lag_28"]) == (138, 111)
    assert last["mean_28"] == pytest.approx(sum(past) / 28)
    assert last["std_7"] == pytest.approx(2.0)
    assert last["median_28"] == pytest.approx(124.5)
    assert (last["recent_low"], last["recent_high"]) == (132, 138)
    assert last["weekly_median_4"] == pytest.approx((125 + 118) / 2)
    first = history.feature_frame(daily).orderBy("date").first()
    assert first["mean_2"] is None and first["weekly_mean_2"] is None


def test_constant_series_has_no_autocorrelation(spark):
    got = history.autocorrelation(days(spark, "2023-01-01", [5] * 40), 3).collect()
    assert {r["correlation"] for r in got} == {None}


def test_history_needs_all_days(spark):
    daily = days(spark, "2023-01-01", list(range(60)))
    assert history.history_arrays(daily).count() == 32
    broken = daily.where("date <> date'2023-01-20'")
    dates = {r["date"] for r in history.history_arrays(broken).collect()}
    assert min(dates) == date(2023, 2, 18)


def test_weekly_contrast_needs_positive_counts(spark):
    daily = days(spark, "2023-01-02", [10] * 5 + [5, 5] + [7] * 3)
    got = weekly.week_contrast(daily).collect()
    assert len(got) == 1 and got[0]["contrast"] == pytest.approx(5 / (60 / 7))
    assert weekly.excluded_dates(daily).count() == 3
    with pytest.raises(Exception, match="positive"):
        weekly.week_contrast(daily.withColumn("trips", F.lit(0))).collect()


def test_reserved_rows_are_refused(spark):
    daily = days(spark, "2023-09-25", [1] * 10)
    assert validate.cut_reserved(daily, "2023-09-30").count() == 6
    with pytest.raises(ValueError, match="reserved"):
        validate.require_before(daily, "2023-10-01")


# Zones and weather ----------------------------------------------------------------------

def hours(spark, first, last):
    return spark.sql(f"select explode(sequence(timestamp'{first}', timestamp'{last}', interval 1 hour)) as instant")


@pytest.mark.parametrize("day, length, first, last", [
    ("2023-03-12", 23, "2023-03-12 05:00:00", "2023-03-13 03:00:00"),
    ("2023-11-05", 25, "2023-11-05 04:00:00", "2023-11-06 04:00:00")])
def test_day_lengths_follow_the_zone(spark, day, length, first, last):
    df = hours(spark, first, last).withColumn("temp", F.lit(1.0))
    got = weather.hourly_to_daily(df, ["temp"]).collect()
    assert [(str(r["date"]), r["hours"]) for r in got] == [(day, length)]


def test_one_null_hour_nulls_the_day(spark):
    df = hours(spark, "2023-06-01 04:00:00", "2023-06-02 03:00:00").select(
        "instant", F.when(F.hour("instant") != 9, F.lit(2.0)).alias("temp"))
    assert weather.hourly_to_daily(df, ["temp"]).first()["temp_mean"] is None


def test_rain_belongs_to_the_hour_before(spark):
    df = hours(spark, "2023-06-01 04:00:00", "2023-06-02 04:00:00").withColumns({
        "rain": F.when(F.col("instant") == F.lit("2023-06-02 04:00:00").cast("timestamp"), 7.0)
        .when(F.hour("instant") == 9, -0.1).otherwise(0.0), "wind": F.lit(3.0)})
    got = {str(r["date"]): r for r in weather.rain_wind_daily(df).collect()}
    assert got["2023-06-01"]["rain_sum"] == 7.0
    assert got["2023-06-01"]["rain_raw_sum"] == pytest.approx(6.9)
    assert got["2023-06-01"]["rain_negative_hours"] == 1
    with pytest.raises(Exception, match="negative"):
        weather.rain_wind_daily(df.withColumn("rain", F.lit(-0.2))).collect()


def test_hourly_json(spark):
    text = '{"hourly": {"time": [3600, 7200], "t": [1.5, null]}}'
    df = spark.createDataFrame([(text,)], "json string")
    got = hourly_json.hourly_from_json(df, ["t"]).orderBy("instant").collect()
    assert [(r["instant"].hour, r["t"]) for r in got] == [(1, 1.5), (2, None)]
    for bad in ("[7200, 3600]", "[3600, 3600]", "[3600]"):
        broken = spark.createDataFrame([(text.replace("[3600, 7200]", bad),)], "json string")
        with pytest.raises(Exception, match="repeated"):
            hourly_json.hourly_from_json(broken, ["t"]).collect()


def test_as_of_takes_the_newest_allowed_issue(spark):
    issues = spark.createDataFrame([("a", 1, 10.0), ("a", 5, 50.0), ("b", 2, 20.0)], "k string, at int, v double")
    asked = spark.createDataFrame([("a", 0), ("a", 1), ("a", 4), ("a", 9), ("b", 9), ("c", 9), ("a", 9)], "k string, t int")
    got = sorted((r["k"], r["t"], r["v"]) for r in joins.as_of(asked, issues, F.col("t"), "at", ["v"], ["k"]).na.fill(-1.0).collect())
    assert got == [("a", 0, -1.0), ("a", 1, 10.0), ("a", 4, 10.0), ("a", 9, 50.0), ("a", 9, 50.0), ("b", 9, 20.0), ("c", 9, -1.0)]


def test_aligned_sides_are_required(spark):
    a, b = days(spark, "2023-01-01", [1, 2]), days(spark, "2023-01-02", [1, 2])
    with pytest.raises(ValueError, match="different dates"):
        joins.require_aligned(a.select("date"), b.select("date"))
    with pytest.raises(ValueError, match="null values"):
        joins.require_complete(joins.with_forecast(a, b.select("date", F.col("trips").alias("t"))), ["t"])


# Requests and records -------------------------------------------------------------------

REQUEST = ("model string, prediction_date string, prior_counts array<double>, forecasts array<struct<date string, temp_mean double, "
           "temp_min double, temp_max double, rain_sum double, wind_mean double, wind_max double>>")


def errors_of(spark, **changes):
    row = {"model": "weather_day", "prediction_date": "2023-06-01", "prior_counts": [100.0] * 28,
           "forecasts": [("2023-06-01", 20.0, 15.0, 25.0, 0.0, 3.0, 9.0)]}
    row.update(changes)
    df = spark.createDataFrame([tuple(row.values())], REQUEST)
    return validate.validate_forecast_request(df).first()["errors"]


def test_good_requests_pass(spark):
    assert errors_of(spark) == []
    assert errors_of(spark, model="counts", forecasts=[]) == []


@pytest.mark.parametrize("changes, expected", [
    ({"forecasts": []}, "forecast_count"),
    ({"prior_counts": [100.0] * 27}, "history_length"),
    ({"prior_counts": [-1.0] + [100.0] * 27}, "history_values"),
    ({"prior_counts": [0.0] * 28}, "history_values"),
    ({"prediction_date": "not-a-date"}, "prediction_date"),
    ({"prediction_date": "2023-02-30"}, "prediction_date"),
    ({"model": "other"}, "model"),
    ({"forecasts": [("2023-06-02", 20.0, 15.0, 25.0, 0.0, 3.0, 9.0)]}, "forecast_dates"),
    ({"forecasts": [("2023-06-01", 20.0, 21.0, 25.0, 0.0, 3.0, 9.0)]}, "temperature_order"),
    ({"forecasts": [("2023-06-01", 20.0, 15.0, 25.0, -1.0, 3.0, 9.0)]}, "negative_weather"),
    ({"forecasts": [("2023-06-01", 20.0, 15.0, 25.0, 0.0, 10.0, 9.0)]}, "wind_order"),
    ({"forecasts": [("2023-06-01", float("nan"), 15.0, 25.0, 0.0, 3.0, 9.0)]}, "forecast_numbers")])
def test_bad_requests_are_named(spark, changes, expected):
    assert expected in errors_of(spark, **changes)


def test_records_need_exactly_their_fields(spark):
    df = spark.createDataFrame([(1.0, ""), (float("inf"), "x" * 33), (None, None)], "size double, kind string")
    got = [(r["kind"], r["errors"]) for r in validate.validate_records(df, ["size"], ["kind"]).collect()]
    assert got == [(None, []), ("x" * 33, ["size", "kind"]), (None, [])]
    with pytest.raises(ValueError, match="exactly"):
        validate.validate_records(df.withColumn("class", F.lit("p")), ["size"], ["kind"])


def test_labels_outside_the_classes_fail(spark):
    df = spark.createDataFrame([("p",), ("e",), ("x",)], "class string")
    with pytest.raises(Exception, match="two classes"):
        validate.encode_label(df).collect()
    with pytest.raises(ValueError):
        validate.require_both_labels(df)


def test_zero_denominators_are_null(spark):
    df = spark.createDataFrame([(1, 4.0, 0.0), (2, None, 2.0)], "row_id int, a double, b double")
    out = validate.feature_design(df, ["a", "b"], [], ratios=[("a", "b")], engineered=True, missing_counts=True, keep=["row_id"])
    got = {r["row_id"]: r for r in out.collect()}
    assert got[1]["a_over_b"] is None and got[2]["a_log1p"] is None and got[2]["missing_numeric_count"] == 1


def test_forecasts_round_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-3.0,)], "p double")
    assert [r[0] for r in df.select(numeric.whole_forecast(F.col("p"))).collect()] == [0, 2, 2, 0]
    with pytest.raises(Exception, match="finite"):
        df.select(numeric.clip_forecast(F.col("p") * float("inf"))).collect()


# Collisions, partitions, folds ----------------------------------------------------------

def collide(spark):
    return spark.createDataFrame([(1, 1.0, None, "p"), (2, 1.0, None, "e"), (3, 1.0, "x", "p"), (4, 1.0, "x", "p"), (5, None, None, "e")],
                                 "row_id long, a double, b string, class string")


def test_collisions_treat_null_as_equal(spark):
    df = collide(spark).withColumn("part", F.when(F.col("row_id") == 2, "test").otherwise("train"))
    got = {r["group_id"]: (r["rows"], r["labels_agree"], r["crosses_partitions"], r["missing_features"])
           for r in audit.collision_groups(df, ["a", "b"], "row_id", "part", "class").collect()}
    assert got == {1: (2, False, True, "b"), 3: (2, True, False, "")}
    kept = joins.without_collisions(df.where("part = 'train'"), df.where("part = 'test'"), ["a", "b"])
    assert {r["row_id"] for r in kept.collect()} == {3, 4, 5}
    with pytest.raises(ValueError, match="repeat the predictors"):
        split.require_distinct_features(df, ["a", "b"])


def test_grouped_folds_keep_groups_together(spark):
    df = collide(spark).withColumn("label", (F.col("class") == "p").cast("int"))
    folds = split.group_stratified_folds(df, ["a", "b"], "row_id", "label", k=2)
    assert folds.count() == 5
    assert folds.groupBy("group_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0


def test_folds_are_balanced_and_cover(spark):
    df = spark.range(103).select(F.col("id").alias("row_id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    folds = split.stratified_folds(df, "row_id", "label", 5, 2)
    assert folds.groupBy("row_id").count().where("count <> 2").count() == 0
    sizes = [r["count"] for r in folds.where("label = 1").groupBy("repeat", "fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    parts = dict(split.stratified_split(df, "row_id", "label").groupBy("split").count().collect())
    assert parts == {"train": 63, "validation": 20, "test": 20}


def test_expanding_folds_never_look_ahead(spark):
    folds = split.expanding_folds(days(spark, "2023-01-29", [1] * 153))
    got = {(r["fold"], r["role"]): (str(r["first_date"]), str(r["last_date"]), r["rows"]) for r in split.fold_bounds(folds).collect()}
    assert got[(0, "check")] == ("2023-04-29", "2023-05-19", 21)
    assert got[(2, "check")] == ("2023-06-10", "2023-06-30", 21)
    assert got[(0, "train")][1] == "2023-04-28"


def test_fingerprint_sees_membership_not_order(spark):
    df = spark.range(200000).select(F.col("id").alias("row_id"), F.lit(0).alias("fold"))
    one = split.membership_fingerprint(df, "row_id", ["fold"]).collect()
    two = split.membership_fingerprint(df.repartition(7), "row_id", ["fold"]).collect()
    other = split.membership_fingerprint(df.where("row_id <> 77"), "row_id", ["fold"]).collect()
    assert len(one) == 1 and one == two and one != other


def test_partitions(spark):
    manifest = spark.createDataFrame([({"search": [1, 2], "confirmation": [3]},)], "partitions map<string, array<bigint>>")
    members = sets.manifest_rows(manifest)
    rows = spark.range(5).select(F.col("id").alias("row_id"))
    assert {r[0] for r in sets.load_partition(rows, members, "search").collect()} == {1, 2}
    with pytest.raises(PermissionError):
        sets.load_partition(rows, members, "confirmation")
    with pytest.raises(ValueError, match="lists"):
        sets.require_partition_size(rows, members, "search")


# Scores ---------------------------------------------------------------------------------

def scored(spark):
    return spark.createDataFrame([(1, 1.0), (1, 0.8), (0, 0.8), (1, 0.4), (0, 0.2)], "label int, score double")


def test_tied_scores_move_together(spark):
    table = [tuple(r) for r in scoring.threshold_table(scored(spark)).orderBy(F.col("threshold").desc()).select("threshold", "tp", "fp").collect()]
    assert table == [(scoring.NOTHING_FLAGGED, 0, 0), (1.0, 1, 0), (0.8, 2, 1), (0.4, 3, 1), (0.2, 3, 2)]


def test_cutoffs(spark):
    table = scoring.threshold_table(scored(spark))
    assert scoring.select_cutoff(table, [0.5]).first()["threshold"] == 0.8  # equal specificity at 0.4: the larger wins
    assert scoring.select_cutoff(table, [0.9]).first()["threshold"] == 0.4
    assert scoring.select_cutoff(table, [0.3]).first()["threshold"] == 1.0
    assert scoring.select_cutoff_precision(table, [0.9]).first()["threshold"] == 0.4
    assert scoring.select_cutoff_fpr(table, [1.0]).first()["threshold"] == 0.4
    with pytest.raises(ValueError):
        scoring.select_cutoff(table, [0.0])


def test_ranking_metrics(spark):
    got = scoring.ranking_metrics(scored(spark)).first()
    assert got["average_precision"] == pytest.approx(1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 4)
    assert got["roc_auc"] == pytest.approx((2 + 1.5 + 1) / 6)


def test_no_alarm_has_precision_zero(spark):
    got = scoring.classification_metrics(scored(spark), 2.0).first()
    assert (got["precision"], got["recall"], got["f1"], got["specificity"]) == (0.0, 0.0, 0.0, 1.0)


def test_scores_must_be_probabilities(spark):
    with pytest.raises(Exception, match=r"not in \[0, 1\]"):
        scoring.threshold_table(spark.createDataFrame([(1, 1.5), (0, 0.1)], "label int, score double")).collect()


def test_empty_slices_stay(spark):
    df = spark.createDataFrame([(1, 0, 1), (0, 1, 1)], "label int, predicted int, missing_feature_count int")
    got = {r["missing_features"]: (r["n"], r["false_negative_rate"]) for r in scoring.error_slices(df).collect()}
    assert got == {"0-2": (2, 1.0), "3-4": (0, None), "5-10": (0, None)}


# Statistics -----------------------------------------------------------------------------

def test_tail_probabilities(spark):
    df = spark.createDataFrame([(3.841458820694124, 1.0), (18.307038053275146, 10.0)], "x double, k double")
    assert [r[0] for r in df.select(special.chi_square_tail("x", "k")).collect()] == pytest.approx([0.05, 0.05], abs=1e-9)
    z = spark.createDataFrame([(1.959963984540054,)], "z double")
    assert z.select(special.two_sided_normal("z")).first()[0] == pytest.approx(0.05, abs=1e-12)


def test_clopper_pearson_published_values(spark):
    df = spark.createDataFrame([(271, 303), (0, 497), (303, 303)], "k int, n int")
    got = [tuple(r[0]) for r in df.select(special.clopper_pearson("k", "n", F.lit(0.95))).collect()]
    assert got[0] == pytest.approx((0.8541875911643559, 0.9266331802332912), abs=1e-9)
    assert got[1] == pytest.approx((0.0, 0.007394815473294639), abs=1e-9)
    assert got[2] == pytest.approx((0.9878992899779208, 1.0), abs=1e-9)


def test_bootstrap_of_a_constant_is_a_point(spark):
    df = spark.createDataFrame([(i, 2.0) for i in range(20)], "i int, v double")
    for r in resample.stationary_bootstrap(df, "i", "v", replicates=50).collect():
        assert (r["estimate"], r["ci_lower"], r["ci_upper"], r["standard_error"]) == (2.0, 2.0, 2.0, 0.0)
        assert r["p_value"] == pytest.approx(1 / 51)


def test_association_without_variation(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0)], "c string, label int")
    r = profile.association(df, ["c"]).first()
    assert r["chi2"] == 0.0 and r["cramers_v"] is None and r["p_value"] is None


# Sources --------------------------------------------------------------------------------

HEADER = "ride_id,rideable_type,started_at,ended_at,member_casual\n"


def archive(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return str(path)


def nested(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return buffer.getvalue()


def test_nested_archives(spark, tmp_path):
    row = "{},classic,2023-01-0{} 00:00:00,2023-01-01 00:10:00,\n"
    inner = nested({"202301-trips_2.csv": HEADER + row.format("b" * 16, 2) * 2, "._202301.csv": "junk", "deep.zip": nested({
        "x/202301-trips_3.csv": HEADER.replace(",member_casual", "") + row.format("c" * 16, 3).replace(",\n", "\n")})})
    path = archive(tmp_path / "outer.zip", {"202301-trips_1.csv": HEADER + row.format("a" * 16, 1), "__MACOSX/a.csv": "junk", "inner.zip": inner})
    df = zip_csv.read_trips(spark, path)
    got = sorted((r["_member"], r["n"]) for r in df.groupBy("_member").agg(F.count("*").alias("n")).collect())
    assert got == [("outer.zip!/202301-trips_1.csv", 1), ("outer.zip!/inner.zip!/202301-trips_2.csv", 2),
                   ("outer.zip!/inner.zip!/deep.zip!/x/202301-trips_3.csv", 1)]
    assert df.where("member_casual is null").count() == 4
    assert audit.header_inventory(df).select("_header").distinct().count() == 2
    assert dict(audit.daily_counts(df).select(F.dayofmonth("date"), "trips").collect()) == {1: 1, 2: 2, 3: 1}
    only = zip_csv.read_trips(spark, path, members="trips_2")
    assert only.count() == 2


def test_archives_below_folders_and_further_columns(spark, tmp_path):
    (tmp_path / "2023" / "01").mkdir(parents=True)
    content = HEADER.strip() + ",fee\n" + "a" * 16 + ",classic,2023-01-01 00:00:00,2023-01-01 00:10:00,,NA\n"
    archive(tmp_path / "2023" / "01" / "t.ZIP", {"202301-trips.csv": content})
    with pytest.raises(Exception, match="also has fee"):
        zip_csv.read_zip_csv(spark, str(tmp_path)).collect()
    assert zip_csv.read_zip_csv(spark, str(tmp_path), unknown="drop").count() == 1
    row = zip_csv.read_zip_csv(spark, str(tmp_path), columns=["ride_id", "fee"]).first()
    assert row["fee"] is None and row["ride_id"] == "a" * 16
    assert (row["_bytes"], row["_crc"]) == (len(content), zlib.crc32(content.encode()))


@pytest.mark.parametrize("content, message", [(HEADER, "has no rows"), ("", "lacks ride_id"), ("ride_id,started_at\n1,2\n", "lacks ended_at")])
def test_broken_members_fail(spark, tmp_path, content, message):
    path = archive(tmp_path / "bad.zip", {"202301-trips.csv": content})
    with pytest.raises(Exception, match=message):
        zip_csv.read_trips(spark, path).collect()


def test_daily_csv_and_reports(spark, tmp_path):
    df = days(spark, "2023-12-30", [1, 2, 3]).select("date", "trips", (F.col("trips") / 7).alias("x"))
    tables.write_daily(df, str(tmp_path / "daily"))
    back = tables.read_daily(spark, str(tmp_path / "daily"), "date date, trips bigint, x double").orderBy("date").collect()
    assert [(str(r["date"]), r["x"]) for r in back] == [("2023-12-30", 0.142857), ("2023-12-31", 0.285714), ("2024-01-01", 0.428571)]
    with pytest.raises(ValueError, match="finite"):
        tables.write_report(df.withColumn("x", F.lit(math.nan)), str(tmp_path / "report"))
    assert not (tmp_path / "report").exists()


def test_text_fingerprint_ignores_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\r\ntwo\r\n\r")
    (tmp_path / "b.txt").write_bytes(b"one\ntwo\n\r")
    raw = {r["name"]: r["digest"] for r in tables.fingerprint(spark, str(tmp_path)).collect()}
    text = {r["name"]: r["digest"] for r in tables.fingerprint(spark, str(tmp_path), text=True).collect()}
    assert raw["a.txt"] != raw["b.txt"]
    assert text["a.txt"] == text["b.txt"] == raw["b.txt"]
    assert pd.Series(raw).str.len().eq(64).all()
