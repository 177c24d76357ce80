"""Streams over files that arrive one by one equal the batch operators."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daymark.operators import audit, history
from daymark.streaming import jobs, runner

SCHEMA = "ride_id string, started_at timestamp_ntz, series string"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def trips(first, count, hours, tag):
    return [(f"{tag}{i}", first + timedelta(hours=i * hours), "all") for i in range(count)]


@pytest.fixture
def arrivals(spark, tmp_path):
    path = str(tmp_path / "in")
    start = datetime(2023, 1, 1)
    write(spark, path, trips(start, 120, 1, "a"))
    write(spark, path, trips(start + timedelta(days=4), 160, 2, "b"))
    write(spark, path, trips(start + timedelta(days=10), 120, 3, "c"))
    return path


def stream(spark, path):
    return runner.stream_parquet(spark, path, spark.read.parquet(path).schema, files_per_batch=1)


def test_complete_counts_equal_batch(spark, arrivals):
    got = runner.run_complete(jobs.daily_windows(stream(spark, arrivals)))
    want = audit.daily_counts(spark.read.parquet(arrivals))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_complete_mode_keeps_two_results_at_most(spark, arrivals, tmp_path):
    base = str(tmp_path / "counts")
    runner.run_complete(jobs.daily_windows(stream(spark, arrivals)), base=base)
    assert len(list((tmp_path / "counts" / "table").glob("batch=*"))) == 2


def test_append_emits_closed_days_only(spark, arrivals):
    got = {r["date"] for r in runner.run_append(jobs.daily_windows(stream(spark, arrivals))).collect()}
    want = sorted(r["date"] for r in audit.daily_counts(spark.read.parquet(arrivals)).collect())
    assert got < set(want) and want[-1] not in got


def test_an_id_counts_once_across_files(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = trips(datetime(2023, 1, 1), 20, 1, "a")
    write(spark, path, rows)
    write(spark, path, rows[:5] + trips(datetime(2023, 1, 2), 3, 1, "z"))
    got = [r[0] for r in runner.run_append(jobs.first_seen(stream(spark, path))).select("ride_id").collect()]
    assert len(got) == len(set(got)) == 23


def test_late_rows_are_kept_aside(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, trips(datetime(2023, 1, 31, 12), 1, 1, "new"))
    write(spark, path, [("near", datetime(2023, 1, 31, 1), "all"), ("far", datetime(2023, 1, 2), "all"), ("next", datetime(2023, 2, 1), "all")])
    accepted, late = jobs.split_late_rows(stream(spark, path), delay="1 day")
    assert {r[0] for r in accepted.select("ride_id").collect()} == {"new0", "near", "next"}
    assert [r[0] for r in late.select("ride_id").collect()] == ["far"]


def closed_days(spark, path, totals, skip=()):
    first = datetime(2023, 1, 1).date()
    for at in range(0, len(totals), 5):
        rows = [("all", first + timedelta(days=i), totals[i]) for i in range(at, min(at + 5, len(totals))) if i not in skip]
        if rows:
            spark.createDataFrame(rows, "series string, date date, trips long").coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def test_state_features_equal_batch(spark, tmp_path):
    table = closed_days(spark, str(tmp_path / "days"), [100 + 7 * i % 31 for i in range(23)])
    got = runner.run_append(jobs.history_features(stream(spark, str(tmp_path / "days"))))
    want = history.one_step_features(table)
    names = ["date", "trips", "weekday", "month", "lag_1", "lag_7", "past_7_day_mean"]
    assert got.select(names).orderBy("date").collect() == want.select(names).orderBy("date").collect()


def test_a_gap_restarts_the_history(spark, tmp_path):
    closed_days(spark, str(tmp_path / "days"), list(range(30)), skip=(12,))
    got = runner.run_append(jobs.history_features(stream(spark, str(tmp_path / "days")))).orderBy("date").collect()
    gap = [r for r in got if r["gap_days"]]
    assert [(str(r["date"]), r["gap_days"], r["lag_1"]) for r in gap] == [("2023-01-14", 1, None)]
    assert [r["date"].day for r in got if r["lag_1"] is not None] == [8, 9, 10, 11, 12] + list(range(21, 31))


def test_scored_batches_use_the_fallback(spark, tmp_path):
    closed_days(spark, str(tmp_path / "days"), [10, 11, 12, 13, 14, 15])
    weather = spark.createDataFrame([(datetime(2023, 1, 2).date(), 99.0)], "date date, p double")
    out = jobs.score_with_fallback(stream(spark, str(tmp_path / "days")), weather, ["date"], "p", "trips")
    got = {r["date"].day: (r["prediction"], r["used_model"]) for r in out.collect()}
    assert got[2] == (99.0, "weather") and got[3] == (12.0, "counts") and len(got) == 6


def test_sums_are_kept_in_complete_mode(spark, arrivals):
    got = runner.run_complete(jobs.daily_windows(stream(spark, arrivals), series=["series"]))
    assert got.agg(F.sum("trips")).first()[0] == 400


def test_a_partitioned_table_streams_every_row(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(100).selectExpr("id", "id % 4 as part").write.partitionBy("part").parquet(path)
    out = runner.run_append(runner.stream_table(spark, path, spark.read.parquet(path).schema, files_per_batch=1))
    assert sorted(r["id"] for r in out.collect()) == list(range(100))


def test_a_second_run_adds_only_new_files(spark, tmp_path):
    path, start = str(tmp_path / "in"), datetime(2023, 1, 1)
    write(spark, path, trips(start, 30, 1, "a"))

    def appended():
        return runner.run_append(stream(spark, path).select("ride_id"), base=str(tmp_path / "append")).count()

    def counted():
        return runner.run_complete(jobs.daily_windows(stream(spark, path)), base=str(tmp_path / "counts")).agg(F.sum("trips")).first()[0]

    assert (appended(), counted()) == (30, 30)
    assert (appended(), counted()) == (30, 30)  # nothing new
    write(spark, path, trips(start + timedelta(days=2), 12, 1, "b"))
    assert (appended(), counted()) == (42, 42)


def test_a_late_day_is_set_aside_and_keeps_the_history(spark, tmp_path):
    path = str(tmp_path / "days")
    closed_days(spark, path, list(range(15)), skip=(3,))
    spark.createDataFrame([("all", datetime(2023, 1, 4).date(), 3)], "series string, date date, trips long").coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([("all", datetime(2023, 1, 16).date(), 15)], "series string, date date, trips long").coalesce(1).write.mode("append").parquet(path)
    got = {r["date"].day: r for r in runner.run_append(jobs.history_features(stream(spark, path))).collect()}
    assert got[4]["late"] and got[4]["lag_1"] is None
    assert not got[16]["late"] and got[16]["gap_days"] == 0 and got[16]["lag_1"] == 14
