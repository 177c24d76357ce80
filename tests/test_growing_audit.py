"""Archives audited as they arrive equal one audit of all rows; half-finished additions do not count."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from daymark.operators import audit
from daymark.operators.growing import GrowingAudit

ROWS = [  # origin, member, start, id
    ("one", "a", "2022-01-01 00:00:00", "0" * 16), ("one", "a", "2022-01-01 05:00:00", "1" * 16), ("one", "a", "2022-01-02 05:00:00", "1" * 16),
    ("one", "b", "2021-12-31 23:00:00", "2" * 16), ("one", "b", None, "3" * 16), ("one", "b", "2022-06-01 10:00:00", None),
    ("two", "a", "2022-01-01 00:00:00", "0" * 16), ("two", "a", "2022-01-01 00:00:00", "0" * 16), ("two", "a", "2023-01-01 00:00:00", "1" * 16),
    ("two", "c", "2022-03-01 00:00:00", "not hex"), ("two", "c", "2022-03-01 00:00:00", "4" * 16)]


@pytest.fixture
def rows(spark):
    parsed = [(o, m, s and datetime.fromisoformat(s), i) for o, m, s, i in ROWS]
    return spark.createDataFrame(parsed, "origin string, _member string, started_at timestamp_ntz, ride_id string")


def check(state, rows):
    got = state.report().first().asDict()
    scope = rows.where(audit.starts_in_year("started_at", 2022))
    repeated = audit.duplicate_audit(scope.where("ride_id is not null"), ["ride_id"]).first()
    assert got == {"members": 4, "rows": 11, "counted": 8, "outside_year": 2, "unparsed": 1, "invalid_ids": 2,
                   "extra_rows": repeated["extra_rows"], "repeated_ids": repeated["repeated_ids"], "days": 4, "missing_days": 361, "reconciled": False}
    assert (got["extra_rows"], got["repeated_ids"]) == (3, 2)
    daily = {(r["date"], r["trips"]) for r in audit.daily_counts(scope).collect()}
    assert {(r["date"], r["trips"]) for r in state.daily().collect()} == daily
    one = audit.carryover_by_origin(rows, 2022, "origin")
    assert sorted(state.carryover().collect()) == sorted(one.collect())


def test_any_order_of_arrival(spark, rows, tmp_path):
    for n, parts in enumerate([["one", "two"], ["two", "one"]]):
        state = GrowingAudit(spark, str(tmp_path / str(n)), 2022)
        for part in parts:
            state.add(rows.where(F.col("origin") == part), "origin")
        check(state, rows)


def test_grown_archive_is_read_whole_again(spark, rows, tmp_path):
    state = GrowingAudit(spark, str(tmp_path / "s"), 2022)
    state.add(rows.where("_member = 'a'"), "origin")
    again = GrowingAudit(spark, str(tmp_path / "s"), 2022, buckets=3)  # the stored layout holds
    assert again.buckets == state.buckets
    again.add(rows, "origin")
    again.add(rows, "origin")
    check(again, rows)
    with pytest.raises(ValueError, match="audits 2022"):
        GrowingAudit(spark, str(tmp_path / "s"), 2023)


def test_an_addition_that_was_lost_half_way_does_not_count(spark, rows, tmp_path, monkeypatch):
    state = GrowingAudit(spark, str(tmp_path / "s"), 2022)
    state.add(rows.where("origin = 'one'"), "origin")

    def lost(condition):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:  # the sums are counted after ids and repeats are written
        m.setattr("daymark.operators.growing.clock.is_hex_id", lost)
        with pytest.raises(RuntimeError):
            state.add(rows.where("origin = 'two'"), "origin")
    assert state.report().first()["members"] == 2 and state.repeats().count() == 1
    GrowingAudit(spark, str(tmp_path / "s"), 2022).add(rows, "origin")
    check(GrowingAudit(spark, str(tmp_path / "s"), 2022), rows)


def test_stored_ids_are_not_shuffled(spark, rows, tmp_path):
    state = GrowingAudit(spark, str(tmp_path / "s"), 2022)
    state.add(rows, "origin")
    stored = spark.table(state.ids)
    plan = rows.groupBy("ride_id").count().join(stored.hint("merge"), "ride_id")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("Exchange hashpartitioning") <= 1


def test_complete_year_and_empty_input(spark, tmp_path):
    state = GrowingAudit(spark, str(tmp_path / "s"), 2021)
    whole = spark.range(365).select(F.lit("o").alias("origin"), F.lit("m").alias("_member"), F.lpad(F.hex("id"), 16, "0").alias("ride_id"),
                                    (F.lit("2021-01-01").cast("timestamp_ntz") + F.make_interval(days=F.col("id").cast("int"))).alias("started_at"))
    state.add(whole.limit(0), "origin")
    assert state.report().first().asDict() == {**dict.fromkeys(["members", "rows", "counted", "outside_year", "unparsed", "invalid_ids", "extra_rows", "repeated_ids", "days"], 0), "missing_days": 365, "reconciled": True}
    with pytest.raises(ValueError, match="missing_days"):
        state.require_complete()
    state.add(whole, "origin")
    assert state.require_complete()["counted"] == 365
