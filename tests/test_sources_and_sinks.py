"""Filters that reach the archive reader, and reports that are refused while they are written."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from daymark.sources import tables, zip_csv

HEADER = "ride_id,started_at,ended_at\n"
ROW = "{},2023-01-0{} 00:00:00,2023-01-0{} 00:10:00\n"
BAD = "something,else\n1,2\n"


def packed(entries):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in entries.items():
            z.writestr(name, content)
    return buffer.getvalue()


@pytest.fixture
def folder(tmp_path):
    """Members that would raise when opened lie beside good ones, at every depth."""
    good = HEADER + ROW.format("a" * 16, 1, 1)
    inner = packed({"202302-trips_1.csv": good, "202302-broken.csv": BAD})
    other = packed({"202303-broken.csv": BAD})
    (tmp_path / "outer.zip").write_bytes(packed({"202301-trips_1.csv": good, "202301-broken.csv": BAD, "inner.zip": inner, "other.zip": other}))
    (tmp_path / "second.zip").write_bytes(packed({"202304-broken.csv": BAD, "202304-trips_9.csv": good}))
    return str(tmp_path)


def read(spark, folder):
    return zip_csv.read_zip_csv(spark, folder, required=["ride_id"])


@pytest.mark.parametrize("condition, members", [
    ("_member = 'outer.zip!/inner.zip!/202302-trips_1.csv'", {"outer.zip!/inner.zip!/202302-trips_1.csv"}),
    ("_member in ('outer.zip!/202301-trips_1.csv', 'second.zip!/202304-trips_9.csv')", {"outer.zip!/202301-trips_1.csv", "second.zip!/202304-trips_9.csv"}),
    ("contains(_member, 'trips')", {"outer.zip!/202301-trips_1.csv", "outer.zip!/inner.zip!/202302-trips_1.csv", "second.zip!/202304-trips_9.csv"}),
    ("startswith(_member, 'outer.zip!/inner') and not contains(_member, 'broken')", {"outer.zip!/inner.zip!/202302-trips_1.csv"}),
    ("endswith(_member, '_9.csv')", {"second.zip!/202304-trips_9.csv"}),
    ("_member = 'nowhere'", set()),
])
def test_only_matching_members_are_opened(spark, folder, condition, members):
    with pytest.raises(Exception, match="lacks"):
        read(spark, folder).collect()
    # A broken member that was opened would raise.
    assert {r["_member"] for r in read(spark, folder).where(condition).collect()} == members


def test_a_nested_archive_that_cannot_match_is_not_unpacked(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(packed({"t.csv": HEADER + ROW.format("a" * 16, 1, 1), "broken.zip": b"no archive at all"}))
    df = read(spark, str(tmp_path))
    assert df.where("_member = 'a.zip!/t.csv'").count() == 1
    with pytest.raises(Exception, match="zip"):
        df.where("_member = 'a.zip!/broken.zip!/t.csv'").collect()


def test_other_conditions_stay_with_spark(spark, folder):
    df = read(spark, folder).where(F.col("_member").contains("trips"))
    assert df.where(F.col("ride_id") == "b" * 16).count() == 0
    assert df.where((F.col("ride_id") == "a" * 16) | (F.col("_member") == "x")).count() == 3
    assert df.where(F.length("_member") > 1000).count() == 0


def test_columns_that_are_not_asked_for_are_not_converted(spark, tmp_path):
    (tmp_path / "w.zip").write_bytes(packed({"t.csv": "ride_id,extra,x\nr1,e1,1\nr2,,2\n"}))
    got = zip_csv.read_zip_csv(spark, str(tmp_path), columns=["x", "absent"]).select("x", "absent", "_header").collect()
    assert [tuple(r) for r in got] == [("1", None, "ride_id,extra,x"), ("2", None, "ride_id,extra,x")]
    assert zip_csv.read_zip_csv(spark, str(tmp_path), columns=["absent"]).count() == 2


@pytest.mark.parametrize("value", [
    "double('NaN')", "double('-Infinity')", "array(1d, double('Infinity'))", "named_struct('v', double('NaN'), 'n', 1)",
    "map('k', double('NaN'))", "array(named_struct('v', array(float('NaN'))))"])
def test_refused_values_at_any_depth(spark, tmp_path, value):
    path = str(tmp_path / "report")
    with pytest.raises(ValueError, match="not finite: column x"):
        tables.write_report(spark.range(4).withColumn("x", F.expr(value)), path)
    assert not (tmp_path / "report").exists()
    tables.write_report(spark.range(4), path)


def test_nulls_and_plain_values_are_written_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(5, numPartitions=2).mapInPandas(count, "id long").withColumns({
        "x": F.when(F.col("id") > 2, F.col("id") / 2), "y": F.array(F.lit(None).cast("double"), F.lit(1.5)), "s": F.struct(F.lit(None).cast("double").alias("v"))})
    tables.write_report(df, str(tmp_path / "ok"))
    rows = [json.loads(line) for f in (tmp_path / "ok").glob("part*.json") for line in f.read_text().splitlines()]
    assert sorted(r["id"] for r in rows) == [0, 1, 2, 3, 4] and seen.value == 5
    assert {r["x"] for r in rows} == {None, 1.5, 2.0} and all(r["y"] == [None, 1.5] and r["s"] == {"v": None} for r in rows)
