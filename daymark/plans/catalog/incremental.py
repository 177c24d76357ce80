"""Sources, sinks and streams."""

from __future__ import annotations

import zipfile

import pandas as pd
from pyspark.sql import functions as F

from daymark.operators import audit, history
from daymark.plans import bindings as b
from daymark.plans.catalog.features import LAGGED, r, rounded
from daymark.plans.registry import query
from daymark.session import scratch_path
from daymark.sources import tables, zip_csv
from daymark.sources.files import resolve
from daymark.streaming import jobs, runner


def archives(spark, d):
    """The events written as ZIP archives by Spark tasks, one archive per partition."""
    base = scratch_path(spark, "archives")
    filesystem, inner = resolve(base)
    filesystem.create_dir(inner)
    rows = b.trips(spark, d).select(
        "ride_id", "rideable_type", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("started_at"),
        F.date_format(F.col("started_at") + F.expr("INTERVAL 7 MINUTES"), "yyyy-MM-dd HH:mm:ss").alias("ended_at"),
        F.col("user_id").cast("string").alias("start_station_id"))

    def pack(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        folder, where = resolve(base)
        inside = f"part-{part:05d}"
        done = 0
        with folder.open_output_stream(f"{where}/{inside}.zip") as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
            for n, batch in enumerate(batches):
                archive.writestr(f"202401-trips_{n}.csv", batch.to_csv(index=False))
                archive.writestr(f"__MACOSX/._202401-trips_{n}.csv", "not a table")
                done += len(batch)
        yield pd.DataFrame({"rows": [done]})

    packed = rows.repartition(spark.sparkContext.defaultParallelism).mapInPandas(pack, "rows bigint")
    packed.agg(F.sum("rows")).collect()
    return base


@query("s1_zip_csv", "select cast(ts as date) as date, count(*) as trips from events group by 1")
def _(spark, d):
    return audit.daily_counts(zip_csv.read_trips(spark, archives(spark, d)))


@query("s2_header_inventory", """
select 'ride_id,rideable_type,started_at,ended_at,start_station_id' as header, count(*) > 0 as has_members from events
""")
def _(spark, d):
    found = audit.header_inventory(zip_csv.read_zip_csv(spark, archives(spark, d), required=["ride_id"]))
    return found.groupBy(F.col("_header").alias("header")).agg((F.count("_member") > 0).alias("has_members"))


@query("s5_daily_round_trip", f"with {b.DAILY}, x as (select date, trips, trips / cast(3 as double) as third from daily) select date, trips, {r('third')} from x")
def _(spark, d):
    path = scratch_path(spark, "daily")
    tables.write_daily(b.daily_shipments(spark, d).select("date", "trips", (F.col("trips") / 3).alias("third")), path)
    return tables.read_daily(spark, path, "date date, trips bigint, third double")


@query("s6_write_report", "select o_orderpriority as priority, count(*) as orders from orders group by 1")
def _(spark, d):
    path = scratch_path(spark, "report")
    tables.write_report(b.table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("orders")), path)
    return spark.read.schema("priority string, orders bigint").json(path)


@query("s7_fingerprint")
def _(spark, d):
    return tables.fingerprint(spark, f"{d}/*.parquet")


def event_stream(spark, d):
    rows = runner.stream_table(spark, f"{d}/events.parquet", b.table(spark, d, "events").schema)
    return rows.select(F.substring(F.md5(F.col("event_id").cast("string")), 1, 16).alias("ride_id"),
                       F.col("ts").alias("started_at"), F.col("event_type").alias("rideable_type"))


@query("r1_stream_daily_counts", "select cast(ts as date) as date, count(*) as trips from events group by 1")
def _(spark, d):
    return runner.run_complete(jobs.daily_windows(event_stream(spark, d)), "counts")


@query("r2_stream_dedupe", "select substr(md5(cast(event_id as varchar)), 1, 16) as ride_id, event_type as rideable_type from events")
def _(spark, d):
    twice = event_stream(spark, d).unionByName(event_stream(spark, d))
    return runner.run_append(jobs.first_seen(twice), "first").select("ride_id", "rideable_type")


@query("r3_stream_late_rows", """
with m as (select min(cast(ts as date)) + 20 as cut from events), x as (select ts, event_type = 'error' and ts < cut as behind, max(ts) over () as newest, max(case when not (event_type = 'error' and ts < cut) then ts end) over () as bound from events, m)
select behind and ts < bound - interval 3 days as late, cast(ts as date) as date, count(*) as trips from x group by 1, 2
""")
def _(spark, d):
    # Early error events arrive after everything else; the second run goes on where the first ended.
    events = b.table(spark, d, "events").select("event_id", "ts", "event_type")
    cut = events.select(F.date_add(F.min(F.to_date("ts")), 20)).scalar()
    marked = events.withColumn("_behind", (F.col("event_type") == "error") & (F.to_date("ts") < cut))
    path, base = scratch_path(spark, "arrivals"), scratch_path(spark, "late")
    for arriving in (~F.col("_behind"), F.col("_behind")):
        marked.where(arriving).drop("_behind").write.mode("append").parquet(path)
        accepted, late = jobs.split_late_rows(runner.stream_table(spark, path, events.schema), "ts", "3 days", base)
    both = accepted.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return both.groupBy("late", F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("trips"))


@query("r4_stream_history_features", f"""
with {b.DAILY_EVENTS}, x as (select date, trips, cast(isodow(date) - 1 as bigint) as weekday, cast(month(date) as bigint) as month, lag(trips, 1) over w as lag_1, lag(trips, 7) over w as lag_7,
 avg(trips) over (order by date rows between 7 preceding and 1 preceding) as m from edaily window w as (order by date))
select date, trips, weekday, month, lag_1, lag_7, {r('m', 'past_7_day_mean')} from x where lag_7 is not null and date + interval 1 day <= (select max(ts) from events) - interval 1 day
""")
def _(spark, d):
    rows = event_stream(spark, d).withColumn("series", F.lit("all"))
    closed = runner.run_append(jobs.daily_windows(rows, series=["series"]), "closed")
    path = scratch_path(spark, "days")
    closed.write.parquet(path)
    features = runner.run_append(jobs.history_features(runner.stream_table(spark, path, closed.schema)), "features")
    return rounded(features.where("not late").drop("gap_days", "late"), skip=("series", "date"))


@query("r4_stream_day_timers", f"""
with {b.DAILY_EVENTS}, x as (select date, trips, cast(isodow(date) - 1 as bigint) as weekday, cast(month(date) as bigint) as month, lag(trips, 1) over w as lag_1, lag(trips, 7) over w as lag_7,
 avg(trips) over (order by date rows between 7 preceding and 1 preceding) as m from edaily window w as (order by date))
select date, trips, weekday, month, lag_1, lag_7, {r('m', 'past_7_day_mean')} from x where lag_7 is not null and date + interval 1 day <= (select max(ts) from events) - interval 1 day
""")
def _(spark, d):
    """Raw events to features of closed days in one streaming query, days closed by event-time timers."""
    rows = event_stream(spark, d).withColumn("series", F.lit("all"))
    features = runner.run_append(jobs.timed_history_features(rows), "timers")
    return rounded(features.drop("gap_days"), skip=("series", "date"))


@query("r5_stream_score", f"""
with {LAGGED}, {b.DAILY_ORDERS} select l.date, cast(coalesce(o.trips * 4, l.lag_7) as double) as prediction,
 case when o.date is null then 'counts' else 'weather' end as used_model from lagged l left join odaily o on l.date = o.date where l.lag_7 is not null
""")
def _(spark, d):
    path = scratch_path(spark, "requests")
    requests = history.lags(b.daily_shipments(spark, d), [7]).where("lag_7 is not null").select("date", "lag_7")
    requests.write.parquet(path)
    preferred = b.daily_orders(spark, d).select("date", (F.col("trips") * 4).cast("double").alias("p"))
    return jobs.score_with_fallback(runner.stream_table(spark, path, requests.schema), preferred, ["date"], "p", "lag_7").drop("lag_7")


@query("r5_stream_join_forecasts", f"""
with {LAGGED}, {b.DAILY_ORDERS}, r as (select date, lag_7 from lagged where lag_7 is not null),
 f as (select date, trips * 4 as p, cast(date as timestamp) - case when day(date) % 5 = 0 then interval 40 hour else interval 10 hour end as issued from odaily),
 last as (select least((select max(cast(date as timestamp)) from r), (select max(issued) from f)) - interval 1 day as mark)
select r.date, cast(coalesce(f.p, lag_7) as double) as prediction, case when f.p is null then 'counts' else 'weather' end as used_model
from r left join f on r.date = f.date and f.issued >= cast(r.date as timestamp) - interval 1 day, last
where f.p is not null or cast(r.date as timestamp) + interval 1 day < mark
""")
def _(spark, d):
    """Requests and forecasts as two streams; forecasts issued too early for the bound leave the counts fallback."""
    requests, forecasts = scratch_path(spark, "requests"), scratch_path(spark, "forecasts")
    history.lags(b.daily_shipments(spark, d), [7]).where("lag_7 is not null").select(
        "date", "lag_7", F.col("date").cast("timestamp").alias("requested")).write.parquet(requests)
    early = F.when(F.dayofmonth("date") % 5 == 0, F.expr("INTERVAL 40 HOURS")).otherwise(F.expr("INTERVAL 10 HOURS"))
    b.daily_orders(spark, d).select("date", (F.col("trips") * 4).cast("double").alias("p"),
                                    (F.col("date").cast("timestamp") - early).alias("issued")).write.parquet(forecasts)
    streams = [runner.stream_table(spark, path, spark.read.parquet(path).schema) for path in (requests, forecasts)]
    out = runner.run_append(jobs.join_forecasts(*streams, ["date"], "requested", "issued", "p", "lag_7"), "answers")
    return out.select("date", "prediction", "used_model")
