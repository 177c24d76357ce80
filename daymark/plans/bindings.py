"""The given tables bound to the package's canonical inputs, in Spark and in plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.operators import audit, history

NUMERIC = ["size", "price", "width"]
CATEGORICAL = ["brand", "kind"]
NOISE = ["noise_0"]
RATIOS = [("size", "width"), ("price", "size")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, d: str) -> DataFrame:
    """Events as trips."""
    return table(spark, d, "events").select(
        "event_id", F.substring(F.md5(F.col("event_id").cast("string")), 1, 16).alias("ride_id"),
        F.col("ts").alias("started_at"), F.col("event_type").alias("rideable_type"), "user_id", "value")


TRIPS = """trips as (select event_id, substr(md5(cast(event_id as varchar)),1,16) as ride_id, ts as started_at,
 event_type as rideable_type, user_id, value from events)"""


def timed_trips(spark: SparkSession, d: str) -> DataFrame:
    """Order date to ship date as a trip with a duration."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("started_at"),
        F.col("l_shipdate").alias("ended_at"), F.col("o_orderstatus").alias("status"))


TIMED = """timed as (select o_orderkey as order_id, o_orderdate as started_at, l_shipdate as ended_at, o_orderstatus as status
 from lineitem join orders on l_orderkey = o_orderkey)"""


def daily_shipments(spark: SparkSession, d: str) -> DataFrame:
    """The complete daily series."""
    return audit.daily_counts(table(spark, d, "lineitem"), "l_shipdate").withColumn("series", F.lit("all"))


DAILY = "daily as (select cast(l_shipdate as date) as date, count(*) as trips from lineitem group by 1)"


def daily_orders(spark: SparkSession, d: str) -> DataFrame:
    """The daily series with gaps."""
    return audit.daily_counts(table(spark, d, "orders"), "o_orderdate").withColumn("series", F.lit("all"))


DAILY_ORDERS = "odaily as (select cast(o_orderdate as date) as date, count(*) as trips from orders group by 1)"


def daily_events(spark: SparkSession, d: str) -> DataFrame:
    return audit.daily_counts(trips(spark, d), "started_at").withColumn("series", F.lit("all"))


DAILY_EVENTS = "edaily as (select cast(ts as date) as date, count(*) as trips from events group by 1)"


def feature_frame(spark: SparkSession, d: str) -> DataFrame:
    return history.feature_frame(daily_shipments(spark, d))


def hourly(spark: SparkSession, d: str) -> DataFrame:
    """Events averaged per hour, the hour read as a UTC instant."""
    return table(spark, d, "events").groupBy(F.date_trunc("hour", F.col("ts")).alias("instant")).agg(
        F.avg("value").alias("temp"), F.max("value").alias("rain"), F.min("value").alias("wind"))


HOURLY = """hourly as (select date_trunc('hour', ts) as instant, avg(value) as temp, max(value) as rain, min(value) as wind
 from events group by 1)"""
LOCAL = "cast(({0} at time zone 'UTC') at time zone 'America/New_York' as date)"


def daily_weather(spark: SparkSession, d: str) -> DataFrame:
    """Six daily weather columns per ship date, from the line items of that day."""
    li = table(spark, d, "lineitem")
    return li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        (F.avg("l_quantity") - 10).alias("temp_mean"), (F.min("l_quantity") - 10).alias("temp_min"),
        (F.max("l_quantity") - 10).alias("temp_max"), (F.avg("l_discount") * 100).alias("rain_sum"),
        F.avg("l_tax").alias("wind_mean"), F.max("l_tax").alias("wind_max")).withColumn("series", F.lit("all"))


WEATHER = """weather as (select cast(l_shipdate as date) as date, avg(l_quantity) - 10 as temp_mean, min(l_quantity) - 10 as temp_min,
 max(l_quantity) - 10 as temp_max, avg(l_discount) * 100 as rain_sum, avg(l_tax) as wind_mean, max(l_tax) as wind_max
 from lineitem group by 1)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents with a score that grows with their length."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, d, "labels")
    n = F.col("n_chars").cast("double")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"), F.col("toxic").alias("label"), (n / (n + 1500.0)).alias("score"),
        F.pmod(F.col("n_chars"), F.lit(11)).cast("int").alias("missing_feature_count"),
        "lang", "source", "n_chars", "quality")


SCORED = """scored as (select d.doc_id as row_id, l.toxic as label,
 cast(d.n_chars as double) / (cast(d.n_chars as double) + cast(1500 as double)) as score,
 cast(d.n_chars % 11 as integer) as missing_feature_count, d.lang, d.source, d.n_chars, l.quality
 from documents d join labels l on d.doc_id = l.doc_id)"""


def incomplete(spark: SparkSession, d: str) -> DataFrame:
    """Parts as incomplete tabular rows; every row is kept, some values become null."""
    key = F.col("p_partkey")

    def unless(step: int, value):
        return F.when(key % step != 0, value)

    return table(spark, d, "part").select(
        key.alias("row_id"),
        unless(7, F.col("p_size")).cast("double").alias("size"),
        unless(5, F.col("p_retailprice")).alias("price"),
        unless(4, (key * 37) % 101).cast("double").alias("width"),
        unless(6, F.col("p_brand")).alias("brand"),
        unless(9, F.col("p_type")).alias("kind"),
        unless(11, F.concat(F.lit("Brand#"), ((key * 7) % 25 + 1).cast("string"))).alias("noise_0"),
        F.when(F.col("p_size") + F.length("p_name") > 35, "p").otherwise("e").alias("class"))


PARTS = """parts as (select p_partkey as row_id, case when p_partkey % 7 <> 0 then cast(p_size as double) end as size,
 case when p_partkey % 5 <> 0 then p_retailprice end as price,
 case when p_partkey % 4 <> 0 then cast((p_partkey * 37) % 101 as double) end as width,
 case when p_partkey % 6 <> 0 then p_brand end as brand, case when p_partkey % 9 <> 0 then p_type end as kind,
 case when p_partkey % 11 <> 0 then 'Brand#' || cast((p_partkey * 7) % 25 + 1 as varchar) end as noise_0,
 case when p_size + length(p_name) > 35 then 'p' else 'e' end as class from part)"""


def forecast_requests(spark: SparkSession, d: str) -> DataFrame:
    """A sound request per ship date and model: the 28 counts before it and the records its model needs."""
    from pyspark.sql import Window as W

    days = history.history_arrays(daily_shipments(spark, d)).select(
        "date", F.transform("prior_counts", lambda v: v.cast("double")).alias("prior_counts"))
    names = history.BASE_WEATHER
    week = W.partitionBy("series").orderBy(F.unix_date("date")).rangeBetween(-7, 0)
    record = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), *names)
    weather = daily_weather(spark, d).select("date", F.sort_array(F.collect_list(record).over(week)).alias("records"))
    given = F.when(F.col("model") == "weather_week", F.col("records")).when(
        F.col("model") == "weather_day", F.slice("records", -1, 1)).otherwise(F.slice("records", 1, 0))
    return days.join(weather, "date").where(F.size("records") == 8).withColumn(
        "model", F.explode(F.array(*map(F.lit, ("counts", "weather_day", "weather_week"))))).select(
        "model", F.date_format("date", "yyyy-MM-dd").alias("prediction_date"), "prior_counts", given.alias("forecasts"))


#: The days of ``forecast_requests``: all 28 days before and the weather week are whole.
REQUEST_DAYS = """request_days as (select date from (select date, count(*) over (order by date range between interval 28 days preceding and interval 1 day preceding) as held
 from daily) where held = 28)"""
