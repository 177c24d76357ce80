"""Audits of archives that keep arriving (S3, A5, A29): new members against what is stored, never against old rows.

State below one folder, which a later session may open again:

* ``sums``: one row per member and day, with the counts that the audits add up;
* ``ids``: each id once, a table bucketed and sorted by id, so only new rows are shuffled when it is searched;
* ``repeats``: ids that came more than once, with the extra rows each addition brought.

An addition is one batch. Its sums are written last and name the batch; ids and repeats of a batch without
sums (a driver that was lost half way) count as not there, and adding the members again completes them.
One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions import clock
from daymark.operators.audit import starts_in_year
from daymark.session import materialize
from daymark.sources.files import resolve

SUMS = ("batch string, origin string, member string, date date, rows long, counted long, outside_year long, unparsed long, "
        "invalid_ids long, first_started_at timestamp_ntz, last_started_at timestamp_ntz")
REPEATS = "batch string, ride_id string, extra_rows long"


class GrowingAudit:
    """Counts starts in ``year``; ids take part where the start is in that year, null ids never."""

    def __init__(self, spark: SparkSession, path: str, year: int, buckets: int | None = None):
        self.spark, self.path, self.year = spark, path.rstrip("/"), year
        filesystem, inner = resolve(self.path)
        if filesystem.get_file_info(f"{inner}/layout").is_file:
            with filesystem.open_input_file(f"{inner}/layout") as stream:
                stored_year, self.buckets = map(int, stream.read().split())
            if stored_year != year:
                raise ValueError(f"{path} audits {stored_year}, not {year}")
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            filesystem.create_dir(inner, recursive=True)
            for table, schema in (("sums", SUMS), ("repeats", REPEATS)):
                spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{table}")
            with filesystem.open_output_stream(f"{inner}/layout") as stream:
                stream.write(f"{year} {self.buckets}".encode())
        self.ids = f"audit_ids_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.ids} (ride_id STRING, batch STRING) USING parquet "
                  f"CLUSTERED BY (ride_id) SORTED BY (ride_id) INTO {self.buckets} BUCKETS LOCATION '{self.path}/ids'")

    def sums(self) -> DataFrame:
        return self.spark.read.schema(SUMS).parquet(f"{self.path}/sums")

    def batches(self) -> list[str]:
        """Action: the finished additions, one name each."""
        return [row["batch"] for row in self.sums().select("batch").distinct().collect()]

    def repeats(self) -> DataFrame:
        """Ids that came more than once with all their extra rows."""
        rows = self.spark.read.schema(REPEATS).parquet(f"{self.path}/repeats").where(F.col("batch").isin(self.batches()))
        return rows.groupBy("ride_id").agg(F.sum("extra_rows").alias("extra_rows"))

    def add(self, trips: DataFrame, origin: str, member: str = "_member", start: str = "started_at", ride_id: str = "ride_id") -> None:
        """Action: audit the members that the state does not hold yet; others are left out, so a grown archive may be read whole."""
        named = trips.select(F.coalesce(F.col(origin).cast("string"), F.lit("")).alias("origin"),
                             F.coalesce(F.col(member).cast("string"), F.lit("")).alias("member"),
                             F.col(start).alias("_start"), F.col(ride_id).cast("string").alias("ride_id"))
        done = self.batches()
        known = self.sums().where(F.col("batch").isin(done)).select("origin", "member").distinct()
        new = named.join(known, ["origin", "member"], "left_anti")
        batch = uuid.uuid4().hex
        kept = starts_in_year("_start", self.year)

        # Copies of an id combine before the shuffle; what is stored stays in its buckets.
        arrived = new.where(kept & F.col("ride_id").isNotNull()).groupBy("ride_id").agg(F.count(F.lit(1)).alias("copies"))
        before = self.spark.table(self.ids).where(F.col("batch").isin(done)).select("ride_id", F.lit(True).alias("before"))
        met = materialize(arrived.join(before.hint("merge"), "ride_id", "left"), "arrived")
        (met.where("before is null").select("ride_id", F.lit(batch).alias("batch"))
         .repartition(self.buckets, "ride_id").write.insertInto(self.ids))
        self.spark.catalog.refreshTable(self.ids)
        extra = F.col("copies") - F.when(F.col("before").isNull(), 1).otherwise(0)
        met.select(F.lit(batch).alias("batch"), "ride_id", extra.cast("long").alias("extra_rows")).where("extra_rows > 0").write.mode(
            "append").parquet(f"{self.path}/repeats")

        outside = F.col("_start").isNotNull() & ~kept
        sums = new.groupBy("origin", "member", F.when(kept, F.to_date("_start")).alias("date")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("counted"), F.count_if(outside).alias("outside_year"),
            F.count_if(F.col("_start").isNull()).alias("unparsed"),
            F.count_if(kept & ~F.coalesce(clock.is_hex_id(F.col("ride_id")), F.lit(False))).alias("invalid_ids"),
            F.min("_start").alias("first_started_at"), F.max("_start").alias("last_started_at"))
        sums.select(F.lit(batch).alias("batch"), "*").write.mode("append").parquet(f"{self.path}/sums")

    def manifest(self) -> DataFrame:
        """Per member: rows, first and last start, days of the year, rows outside it, counted rows."""
        return self.sums().groupBy("origin", "member").agg(
            F.sum("rows").alias("rows"), F.min("first_started_at").alias("first_started_at"), F.max("last_started_at").alias("last_started_at"),
            F.count("date").alias("distinct_start_dates"), F.sum("outside_year").alias("outside_selected_year"), F.sum("counted").alias("counted_rides"))

    def carryover(self) -> DataFrame:
        """Rows read per origin, and those of them that start in the year."""
        return self.sums().groupBy("origin").agg(
            F.sum("rows").alias("read_rows"), F.sum("counted").alias("scoped_rows"), F.sum("outside_year").alias("excluded_other_year_rows"),
            F.sum("unparsed").alias("unparsed_start"))

    def daily(self) -> DataFrame:
        return self.sums().where("date is not null").groupBy("date").agg(F.sum("counted").alias("trips"))

    def report(self) -> DataFrame:
        """One row over everything added: members, rows, counted, outside_year, unparsed, invalid_ids, extra_rows,
        repeated_ids, days, missing_days, reconciled."""
        names = ["members", "rows", "counted", "outside_year", "unparsed", "invalid_ids", "extra_rows", "repeated_ids", "days"]
        counts = names[1:6]
        # Members, days and repeated ids each come down to one row; their sum is the report.
        by_member = self.sums().groupBy("origin", "member").agg(*[F.sum(c).alias(c) for c in counts]).withColumn("members", F.lit(1))
        parts = [by_member.agg(*[F.sum(c).alias(c) for c in ["members", *counts]]),
                 self.repeats().agg(F.sum("extra_rows").alias("extra_rows"), F.count(F.lit(1)).alias("repeated_ids")),
                 self.daily().agg(F.count(F.lit(1)).alias("days"))]
        whole = parts[0].unionByName(parts[1], True).unionByName(parts[2], True)
        one = whole.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in names])
        calendar = F.datediff(F.lit(f"{self.year + 1:04d}-01-01").cast("date"), F.lit(f"{self.year:04d}-01-01").cast("date"))
        return one.withColumns({"missing_days": (calendar - F.col("days")).cast("long"),
                                "reconciled": F.col("counted") + F.col("outside_year") == F.col("rows")})

    def require_complete(self) -> dict:
        """Action: the report; raises where rows do not reconcile, ids repeat or are not valid, or a day of the year is missing."""
        report = self.report().first().asDict()
        faults = [c for c in ("unparsed", "invalid_ids", "extra_rows", "missing_days") if report[c]]
        if faults or not report["reconciled"]:
            raise ValueError(f"counts can not be accepted ({', '.join(faults) or 'rows do not reconcile'}): {report}")
        return report
