"""The whole way from an archive to accepted daily counts, and each gate on it."""

import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daymark.operators import sets, weekly
from daymark.plans import trips
from daymark.sources import zip_csv

HEADER = "ride_id,rideable_type,started_at,ended_at,member_casual\n"


def archive(path, skip_day=None, twice=False, bad=False):
    first = datetime(2022, 12, 31, 12)
    lines = []
    for i in range(366):
        start = first + timedelta(days=i)
        if i == skip_day:
            continue
        lines.append(f"{i:016x},classic,{start},{start + timedelta(minutes=5)},{'member' if i % 2 else ''}")
    if twice:
        lines.append(lines[10].upper().replace("CLASSIC", "classic"))
    if bad:
        lines.append(f"{'f' * 16},classic,not a time,2023-01-01 00:00:00,member")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("202301-trips_1.csv", HEADER + "\n".join(lines) + "\n")
    return str(path)


def test_a_clean_year_is_accepted(spark, tmp_path):
    found = trips.audit_trips(zip_csv.read_trips(spark, archive(tmp_path / "a.zip")), 2023)
    daily = trips.accept_daily(found)
    assert daily.count() == 365 and daily.agg(F.sum("trips")).first()[0] == 365
    assert found.scope.first()["outside_year"] == 1
    assert found.outside.first()["ride_id"] == "0" * 16
    member = found.members.first()
    assert (member["rows"], member["counted_rides"], member["distinct_start_dates"]) == (366, 365, 365)
    assert {(r["column"], r["level"]): r["rows"] for r in found.categories.collect()}[("member_casual", "<missing>")] == 183
    assert found.issues.first()["start_outside_filename_month"] == 335
    with pytest.raises(ValueError, match="before the reserved"):
        weekly.planned_contrast(daily, "2023-01-01", "2023-10-01", "2023-10-01")
    with pytest.raises(ValueError, match="cover"):
        weekly.planned_contrast(daily, "2022-12-01", "2023-09-30", "2023-10-01")
    assert weekly.planned_contrast(daily, "2023-01-01", "2023-09-30", "2023-10-01").count() == 38


@pytest.mark.parametrize("options, message", [
    ({"skip_day": 40}, "1 dates"), ({"twice": True}, "repeat a ride id"), ({"bad": True}, "could not be read")])
def test_each_gate_refuses(spark, tmp_path, options, message):
    found = trips.audit_trips(zip_csv.read_trips(spark, archive(tmp_path / "a.zip", **options)), 2023)
    with pytest.raises(ValueError, match=message):
        trips.accept_daily(found)


def test_an_extended_history_keeps_the_overlap(spark):
    ordinary = spark.sql("select explode(sequence(date'2023-01-01', date'2023-01-09')) as date").withColumn("trips", F.lit(1))
    longer = spark.sql("select explode(sequence(date'2022-12-01', date'2023-01-09')) as date").withColumn("trips", F.lit(1))
    assert sets.overlap_differences(longer, ordinary).count() == 0
    changed = longer.withColumn("trips", F.when(F.col("date") == F.lit("2023-01-04").cast("date"), 2).otherwise(1))
    assert sets.overlap_differences(changed, ordinary).count() == 2
