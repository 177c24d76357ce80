"""Days closed by event-time timers, and two streams joined within a time bound, over several batches and restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymark.operators import history
from daymark.session import scratch_path
from daymark.streaming import jobs, runner

START = dt.datetime(2024, 3, 1)
SCHEMA = "series string, started_at timestamp_ntz"


def starts(series, days, per_day=lambda d: 3 + d % 4):
    return [(series, START + dt.timedelta(days=d, hours=1 + i)) for d in days for i in range(per_day(d))]


def drop(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def features(spark, path, base):
    stream = runner.stream_parquet(spark, path, SCHEMA, files_per_batch=1)
    return runner.run_append(jobs.timed_history_features(stream), base=base)


def test_timers_equal_the_batch_features_over_batches_and_restarts(spark):
    path, base = scratch_path(spark, "starts"), scratch_path(spark, "timers")
    rows = starts("a", range(30)) + starts("b", [*range(12), *range(15, 30)])
    for first in range(0, 30, 6):  # the order of rows inside a file and the split into files do not matter
        some = [r for r in rows if first <= (r[1] - START).days < first + 6]
        drop(spark, path, some[::-1])
        if first == 12:
            features(spark, path, base)  # stops here, then goes on from its state
    got = {(r["series"], r["date"]): (r["trips"], r["lag_1"], r["lag_7"], round(r["past_7_day_mean"], 9), r["gap_days"])
           for r in features(spark, path, base).collect()}
    daily = spark.createDataFrame(rows, SCHEMA).groupBy("series", F.to_date("started_at").alias("date")).agg(F.count(F.lit(1)).alias("trips"))
    closed = dt.date(2024, 3, 28)  # ends two days before the newest start, the delay is one
    want = {}
    for r in history.one_step_features(daily).collect():
        after_gap = r["series"] == "b" and dt.date(2024, 3, 13) <= r["date"] < dt.date(2024, 3, 23)
        if r["date"] <= closed and not after_gap:
            want[r["series"], r["date"]] = (r["trips"], r["lag_1"], r["lag_7"], round(r["past_7_day_mean"], 9), 0)
    assert got == want and len(want) > 20


def test_a_day_stays_open_until_the_watermark_passes(spark):
    path, base = scratch_path(spark, "starts"), scratch_path(spark, "timers")
    drop(spark, path, starts("a", range(9)))
    before = {r["date"] for r in features(spark, path, base).collect()}
    drop(spark, path, [("a", START + dt.timedelta(days=8, hours=20))] + starts("a", range(9, 12)))
    after = {r["date"]: r["trips"] for r in features(spark, path, base).collect()}
    assert before == set() and after[dt.date(2024, 3, 9)] == 3 + 8 % 4 + 1


REQUESTS = "id long, key string, requested timestamp_ntz, own double"
FORECASTS = "key string, issued timestamp_ntz, value double"


@pytest.fixture()
def joined(spark):
    left, right, base = (scratch_path(spark, n) for n in ("left", "right", "answers"))

    def run(requests, forecasts):
        drop(spark, left, requests, REQUESTS)
        drop(spark, right, forecasts, FORECASTS)
        streams = [runner.stream_parquet(spark, p, s) for p, s in ((left, REQUESTS), (right, FORECASTS))]
        out = runner.run_append(jobs.join_forecasts(*streams, ["key"], "requested", "issued", "value", "own", "2 hours", "1 hour"), base=base)
        return {r["id"]: (r["prediction"], r["used_model"]) for r in out.collect()}
    return run


def at(hours):
    return START + dt.timedelta(hours=hours)


def test_forecasts_answer_early_or_late_and_the_fallback_follows_the_bound(joined):
    first = joined([(1, "a", at(10), 1.0), (2, "b", at(10), 2.0), (3, "c", at(10), 3.0), (4, "d", at(10), 4.0)],
                   [("a", at(9), 90.0), ("b", at(6), 60.0)])
    assert first == {1: (90.0, "weather")}  # b's is too early, c and d may still get one
    second = joined([(5, "e", at(12), 5.0)], [("c", at(11.5), 115.0)])
    assert second[3] == (115.0, "weather") and 4 not in second and 2 not in second
    third = joined([(6, "f", at(40), 6.0)], [("g", at(40), 1.0)])
    assert third[2] == (2.0, "counts") and third[4] == (4.0, "counts") and third[5] == (5.0, "counts") and 6 not in third
    assert len(third) == 5
