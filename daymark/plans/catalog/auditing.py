"""Scans, validation, audits, joins of calendars, sets (S, P, A1-A11, A29, J3, T3-T4, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.functions import clock
from daymark.functions.numeric import clip_forecast, r6, whole_forecast
from daymark.operators import audit, growing, history, sets, validate, weather
from daymark.plans import bindings as b
from daymark.plans.registry import query
from daymark.session import scratch_path
from daymark.sources import hourly_json


@query("s3_member_manifest", f"""
select l_returnflag as member, count(*) as rows, min(l_shipdate) as first_started_at, max(l_shipdate) as last_started_at,
 count(distinct case when l_shipdate >= timestamp '1998-01-01' and l_shipdate < timestamp '1999-01-01' then cast(l_shipdate as date) end) as distinct_start_dates,
 count(*) filter (where not (l_shipdate >= timestamp '1998-01-01' and l_shipdate < timestamp '1999-01-01')) as outside_selected_year,
 count(*) filter (where l_shipdate >= timestamp '1998-01-01' and l_shipdate < timestamp '1999-01-01') as counted_rides
from lineitem group by 1
""")
def _(spark, d):
    return audit.member_manifest(b.table(spark, d, "lineitem"), 1998, "l_returnflag", "l_shipdate").withColumnRenamed(
        "l_returnflag", "member")


@query("s4_hourly_from_json", f"""
with {b.HOURLY} select cast(epoch(instant) as bigint) as epoch_seconds, round(temp, 9) + 0.0 as temp, round(rain, 6) + 0.0 as rain from hourly
""")
def _(spark, d):
    # Each day's hours are written as one response of parallel arrays and read back.
    hours = b.hourly(spark, d)
    packed = hours.groupBy(F.to_date("instant").alias("day")).agg(F.array_sort(F.collect_list(F.struct(
        F.unix_timestamp("instant").alias("t"), "temp", "rain"))).alias("h"))
    response = packed.select(F.to_json(F.struct(F.struct(
        F.col("h.t").alias("time"), F.col("h.temp").alias("temp"), F.col("h.rain").alias("rain")).alias("hourly"))).alias("json"))
    out = hourly_json.hourly_from_json(response, ["temp", "rain"])
    return out.select(F.unix_timestamp("instant").alias("epoch_seconds"), r6("temp", 9).alias("temp"), r6("rain").alias("rain"))


@query("s8_verify_manifest", """
with e as (select p_partkey as name, md5(p_name) as digest from part),
 o as (select p_partkey as name, md5(p_brand) as digest from part where p_partkey % 10 = 3),
 a as (select p_partkey + 5 as name, case when p_partkey % 10 = 8 then md5(p_type) else md5(p_name) end as digest from part)
select status, count(*) as names from (
 select case when a.digest is null then 'missing' when e.name is null then 'unexpected'
  when coalesce(o.digest, e.digest) = a.digest then 'ok' else 'changed' end as status
 from (select e.name, e.digest from e) e left join o on o.name = e.name full join a on a.name = e.name) group by 1
""")
def _(spark, d):
    part = b.table(spark, d, "part")
    expected = part.select(F.col("p_partkey").alias("name"), F.md5("p_name").alias("digest"))
    overrides = part.where("p_partkey % 10 = 3").select(F.col("p_partkey").alias("name"), F.md5("p_brand").alias("digest"))
    actual = part.select((F.col("p_partkey") + 5).alias("name"), F.when(
        F.col("p_partkey") % 10 == 8, F.md5("p_type")).otherwise(F.md5("p_name")).alias("digest"))
    return sets.verify_manifest(expected, actual, overrides).groupBy("status").agg(F.count(F.lit(1)).alias("names"))


@query("s9_load_partition", """
select c_custkey as row_id, c_nationkey as nation, c_acctbal as balance from customer where c_nationkey < 15
""")
def _(spark, d):
    customers = b.table(spark, d, "customer").select(
        F.col("c_custkey").alias("row_id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    name = F.when(F.col("nation") < 15, "search").when(F.col("nation") < 20, "calibration").otherwise("confirmation")
    return sets.load_partition(customers, customers.select(name.alias("partition"), "row_id"), "search")


@query("p1_parse_clock", """
select event_id, ts as parsed from events where event_id % 7 <> 0
union all select event_id, null from events where event_id % 7 = 0
""")
def _(spark, d):
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("bad "), F.col("ts").cast("string"))).otherwise(
        F.col("ts").cast("string"))
    return b.table(spark, d, "events").select("event_id", clock.parse_clock(text).alias("parsed"))


@query("p2_in_year", """
select count(*) as rows, count(*) filter (where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01') as counted,
 count(*) filter (where not (o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01')) as outside_year,
 count(*) filter (where o_orderdate is null) as unparsed from orders
""")
def _(spark, d):
    return audit.scope_counts(b.table(spark, d, "orders"), 1997, "o_orderdate")


@query("p3_issue_counts", f"""
with {b.TIMED}, t as (select *, epoch(ended_at) - epoch(started_at) as s,
  started_at >= timestamp '2000-01-01' and started_at < timestamp '2001-01-01' as kept from timed)
select count(*) filter (where started_at is null) as unparsed_start, count(*) filter (where ended_at is null) as unparsed_end,
 count(*) filter (where not kept) as outside_selected_year, count(*) filter (where s < 0) as negative_clock_duration,
 count(*) filter (where s = 0) as zero_clock_duration, count(*) filter (where s >= 0 and s < 60) as under_60_second_clock_duration,
 count(*) filter (where s > 86400) as over_24_hour_clock_duration,
 count(*) filter (where not (year(started_at) = 2000 and month(started_at) = 3)) as start_outside_filename_month,
 count(*) filter (where not (year(ended_at) = 2000 and month(ended_at) = 3)) as end_outside_filename_month,
 count(*) filter (where cast(started_at as date) = date '2000-04-02' and hour(started_at) = 2) as spring_nonexistent_clock_hour,
 count(*) filter (where cast(started_at as date) = date '2000-10-29' and hour(started_at) = 1) as autumn_ambiguous_clock_hour,
 count(*) filter (where not regexp_full_match(md5(cast(order_id as varchar)), '[0-9A-Fa-f]{{16}}')) as missing_or_non_hex_ride_id
from t
""")
def _(spark, d):
    t = b.timed_trips(spark, d).withColumns({"member": F.lit("outer.zip!/200003-trips.csv"),
                                             "ride_id": F.md5(F.col("order_id").cast("string"))})
    return audit.issue_counts(t, 2000, member="member", spring_date="2000-04-02", autumn_date="2000-10-29", ride_id="ride_id")


@query("p4_hex_id", f"""
with {b.TRIPS}, x as (select case when event_id % 5 = 0 then null when event_id % 5 = 1 then upper(ride_id)
  when event_id % 5 = 2 then ride_id || '0' when event_id % 5 = 3 then 'g' || substr(ride_id, 2) else ride_id end as id from trips)
select coalesce(regexp_full_match(id, '[0-9A-Fa-f]{{16}}'), false) as valid, count(*) as rows from x group by 1
""")
def _(spark, d):
    kind = F.col("event_id") % 5
    id_ = F.when(kind == 1, F.upper("ride_id")).when(kind == 2, F.concat("ride_id", F.lit("0"))).when(
        kind == 3, F.concat(F.lit("g"), F.expr("substr(ride_id, 2)"))).when(kind == 4, F.col("ride_id"))
    return b.trips(spark, d).groupBy(clock.is_hex_id(id_).alias("valid")).agg(F.count(F.lit(1)).alias("rows"))


_VALIDITY = """select count(*) > 0 as nonempty, true as unique_dates, max(date) - min(date) + 1 = count(*) as consecutive,
 true as midnight_only, true as whole_counts, max(date) - min(date) + 1 = count(*) as valid from """


@query("p5_validate_daily", f"with {b.DAILY} {_VALIDITY} daily")
def _(spark, d):
    return validate.validate_daily(b.daily_shipments(spark, d))


@query("p5_validate_daily_gaps", f"with {b.DAILY_ORDERS} {_VALIDITY} odaily")
def _(spark, d):
    return validate.validate_daily(b.daily_orders(spark, d))


@query("p6_drop_noise", f"with {b.PARTS} select row_id, size, price, width, brand, kind, class from parts")
def _(spark, d):
    return validate.drop_noise(b.incomplete(spark, d), ["noise_0", "noise_1"])


@query("p7_encode_label", """
select l.doc_id, case when toxic = 1 then 'p' else 'e' end as class, toxic as label from documents d join labels l on d.doc_id = l.doc_id
""")
def _(spark, d):
    rows = b.scored(spark, d).select(F.col("row_id").alias("doc_id"), F.when(F.col("label") == 1, "p").otherwise("e").alias("class"))
    return validate.encode_label(rows)


@query("p8_validate_records", """
select c_custkey, balance, nullif(name, '') as name, concat_ws(',', case when balance < 0 then 'balance' end,
  case when length(name) > 32 then 'name' end) as errors
from (select c_custkey, case when c_custkey % 9 = 0 then null when c_custkey % 10 = 0 then -c_acctbal - 0.01 else abs(c_acctbal) end as balance,
 case when c_custkey % 4 = 0 then '' when c_custkey % 7 = 0 then c_name || c_name else c_name end as name from customer)
""")
def _(spark, d):
    key = F.col("c_custkey")
    rows = b.table(spark, d, "customer").select(
        "c_custkey",
        F.when(key % 9 == 0, None).when(key % 10 == 0, -F.col("c_acctbal") - 0.01).otherwise(F.abs("c_acctbal")).alias("balance"),
        F.when(key % 4 == 0, "").when(key % 7 == 0, F.concat("c_name", "c_name")).otherwise(F.col("c_name")).alias("name"))
    out = validate.validate_records(rows, ["balance"], ["name"], ["c_custkey"])
    return out.withColumn("errors", F.concat_ws(",", "errors"))


_REQUESTS = f"""{b.DAILY}, h as (select date, trips, list(trips) over w as prior, count(*) over w as held from daily
  window w as (order by date range between interval 28 days preceding and interval 1 day preceding)),
 q as (select date, prior, cast(dayofyear(date) as integer) as y from h where held = 28),
 m as (select *, case when y % 3 = 0 then 'counts' when y % 3 = 1 then 'weather_week' when y % 17 = 2 then 'weather_year' else 'weather_day' end as model from q),
 n as (select *, case model when 'counts' then 0 when 'weather_week' then 8 when 'weather_day' then 1 end as needed,
  case when y % 19 = 0 then coalesce(case model when 'counts' then 0 when 'weather_week' then 8 when 'weather_day' then 1 end, 1) + 1
   else coalesce(case model when 'counts' then 0 when 'weather_week' then 8 when 'weather_day' then 1 end, 1) end as given from m)"""


@query("p9_validate_forecast_request", f"""
with {_REQUESTS}
select date, model, concat_ws(',', case when needed is null then 'model' end, case when y % 23 = 0 then 'prediction_date' end,
 case when y % 29 = 0 then 'history_length' end, case when y % 31 = 0 then 'history_values' end,
 case when needed is null or given <> needed then 'forecast_count' end,
 case when (given > 0 and (needed is null or y % 23 = 0 or given <> needed or y % 37 = 0)) then 'forecast_dates' end,
 case when given > 0 and y % 41 = 0 then 'temperature_order' end, case when given > 0 and y % 43 = 0 then 'wind_order' end,
 case when given > 0 and y % 47 = 0 then 'negative_weather' end) as errors from n
""")
def _(spark, d):
    y = F.col("y")
    days = history.history_arrays(b.daily_shipments(spark, d)).select(
        "date", F.transform("prior_counts", lambda v: v.cast("double")).alias("prior"), F.dayofyear("date").alias("y"))
    model = F.when(y % 3 == 0, "counts").when(y % 3 == 1, "weather_week").when(y % 17 == 2, "weather_year").otherwise("weather_day")
    needed = F.coalesce(F.when(F.col("model") == "counts", 0).when(F.col("model") == "weather_week", 8), F.lit(1))
    out = days.withColumn("model", model).withColumn("given", needed + (y % 19 == 0).cast("int"))
    prior = F.when(y % 29 == 0, F.slice("prior", 1, 27)).when(
        y % 31 == 0, F.transform("prior", lambda v, i: F.when(i == 3, v + 0.5).otherwise(v))).otherwise(F.col("prior"))
    number = lambda i: (y + i).cast("double") % 30
    record = lambda i: F.struct(
        F.date_format(F.date_sub("date", F.col("given") - 1 - i + (y % 37 == 0).cast("int")), "yyyy-MM-dd").alias("date"),
        number(i).alias("temp_mean"), (number(i) - F.when(y % 41 == 0, -1.0).otherwise(2.0)).alias("temp_min"),
        (number(i) + 3.0).alias("temp_max"), F.when(y % 47 == 0, -1.0).otherwise(0.5).alias("rain_sum"), F.lit(4.0).alias("wind_mean"),
        F.when(y % 43 == 0, 3.0).otherwise(9.0).alias("wind_max"))
    forecasts = F.transform(F.slice(F.sequence(F.lit(0), F.lit(9)), 1, F.col("given")), record)
    requests = out.select("date", "model", prior.alias("prior_counts"), forecasts.alias("forecasts"), F.when(
        y % 23 == 0, F.date_format("date", "yyyy/MM/dd")).otherwise(F.date_format("date", "yyyy-MM-dd")).alias("prediction_date"))
    return validate.validate_forecast_request(requests).select("date", "model", F.concat_ws(",", "errors").alias("errors"))


@query("p10_feature_design", f"""
with {b.PARTS}
select row_id, size, price, width, kind, noise_0, round(ln(1 + size), 6) as size_log1p, round(ln(1 + price), 6) as price_log1p,
 round(ln(1 + width), 6) as width_log1p, round(size / nullif(width, 0), 6) as size_over_width, round(price / nullif(size, 0), 6) as price_over_size,
 cast((size is null) as integer) + cast((price is null) as integer) + cast((width is null) as integer) as missing_numeric_count,
 cast((brand is null) as integer) + cast((kind is null) as integer) as missing_categorical_count from parts
""")
def _(spark, d):
    out = validate.feature_design(b.incomplete(spark, d), b.NUMERIC, b.CATEGORICAL, b.NOISE, b.RATIOS, include_noise=True,
                                  engineered=True, missing_counts=True, drop=["brand"], keep=["row_id"])
    return out.withColumns({c: r6(c) for c in out.columns if c.endswith("_log1p") or "_over_" in c})


@query("p11_fill_and_flag", f"""
with {b.PARTS} select row_id, size, price, width, coalesce(brand, '__MISSING__') as brand, coalesce(kind, '__MISSING__') as kind,
 cast(size is null as integer) as size_was_missing, cast(price is null as integer) as price_was_missing from parts
""")
def _(spark, d):
    return validate.fill_and_flag(b.incomplete(spark, d), b.CATEGORICAL, ["size", "price"]).select(
        "row_id", "size", "price", "width", "brand", "kind", "size_was_missing", "price_was_missing")


@query("p12_clip_forecast", f"""
with {b.DAILY} select date, greatest(0.0, trips / cast(2 as double) - 8) as unrounded,
 cast(round_even(greatest(0.0, trips / cast(2 as double) - 8), 0) as bigint) as rounded from daily
""")
def _(spark, d):
    guess = F.col("trips") / F.lit(2.0) - 8
    return b.daily_shipments(spark, d).select("date", clip_forecast(guess).alias("unrounded"), whole_forecast(guess).alias("rounded"))


@query("p13_cut_reserved", f"with {b.DAILY} select date, trips from daily where date <= date '2000-06-30'")
def _(spark, d):
    return validate.cut_reserved(b.daily_shipments(spark, d), "2000-06-30").drop("series")


@query("j3_missing_dates", f"""
with {b.DAILY_ORDERS} select cast(g.d as date) as date from (select unnest(generate_series((select min(date) from odaily), (select max(date) from odaily), interval 1 day)) as d) g
 where cast(g.d as date) not in (select date from odaily)
""")
def _(spark, d):
    return audit.missing_dates(b.daily_orders(spark, d))


@query("a1_daily_counts", "select cast(ts as date) as date, count(*) as trips from events group by 1")
def _(spark, d):
    return audit.daily_counts(b.trips(spark, d))


@query("a1_daily_counts_shipments", "select cast(l_shipdate as date) as date, count(*) as trips from lineitem group by 1")
def _(spark, d):
    return audit.daily_counts(b.table(spark, d, "lineitem"), "l_shipdate")


@query("a2_hour_histogram", "select cast(hour(ts) as bigint) as hour, count(*) as rides from events group by 1")
def _(spark, d):
    return audit.hour_histogram(b.trips(spark, d))


def _union(parts):
    return " union all ".join(parts)


@query("a3_missing_profile", f"with {b.PARTS} " + _union(
    f"select '{c}' as \"column\", count(*) - count({c}) as missing, round(100.0 * (count(*) - count({c})) / count(*), 6) as percent from parts"
    for c in b.NUMERIC + b.CATEGORICAL + b.NOISE))
def _(spark, d):
    return audit.missing_profile(b.incomplete(spark, d), b.NUMERIC + b.CATEGORICAL + b.NOISE).withColumn("percent", r6("percent"))


@query("a4_category_counts", _union(
    f"select '{c}' as \"column\", coalesce({e}, '<missing>') as level, count(*) as rows from customer group by 2"
    for c, e in (("segment", "nullif(c_mktsegment, 'MACHINERY')"), ("nation", "cast(c_nationkey as varchar)"))))
def _(spark, d):
    rows = b.table(spark, d, "customer").select(F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"), F.col("c_nationkey").alias("nation"))
    return audit.category_counts(rows, ["segment", "nation"])


_COPIES = "(select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1)"


@query("a5_duplicate_audit", f"select cast(sum(copies - 1) as bigint) as extra_rows, count(*) as repeated_ids from {_COPIES}")
def _(spark, d):
    return audit.duplicate_audit(b.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a5_duplicate_sample", f"select * from {_COPIES} order by l_orderkey, l_linenumber limit 20")
def _(spark, d):
    return audit.duplicate_sample(b.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a6_duplicate_rows", f"""
with {b.PARTS} select cast(sum(n) as bigint) as rows, cast(sum(n - 1) as bigint) as extra_rows from (select count(*) as n from parts group by size, brand, kind)
""")
def _(spark, d):
    return audit.duplicate_rows(b.incomplete(spark, d), ["size", "brand", "kind"])


_GROUPS = """groups as (select size, brand, kind, min(row_id) as group_id, count(*) as rows, count(*) filter (where class = 'p') as positive_rows,
 count(*) filter (where class <> 'p') as negative_rows, min(part) <> max(part) as crosses_partitions
 from (select *, case when row_id % 5 = 0 then 'test' else 'train' end as part from parts) group by 1, 2, 3 having count(*) > 1)"""


@query("a7_collision_groups", f"""
with {b.PARTS}, {_GROUPS} select group_id, size, brand, kind, rows, positive_rows, negative_rows, crosses_partitions,
 positive_rows = 0 or negative_rows = 0 as labels_agree, concat_ws(',', case when size is null then 'size' end,
 case when brand is null then 'brand' end, case when kind is null then 'kind' end) as missing_features from groups
""")
def _(spark, d):
    rows = b.incomplete(spark, d).withColumn("part", F.when(F.col("row_id") % 5 == 0, "test").otherwise("train"))
    return audit.collision_groups(rows, ["size", "brand", "kind"], "row_id", "part", "class")


@query("a7_collision_members", f"""
with {b.PARTS}, {_GROUPS} select g.group_id, p.row_id, p.class from parts p join groups g on p.size is not distinct from g.size
 and p.brand is not distinct from g.brand and p.kind is not distinct from g.kind
""")
def _(spark, d):
    return audit.collision_members(b.incomplete(spark, d), ["size", "brand", "kind"], "row_id", ["class"])


@query("a8_reconcile", """
select count(*) as rows, count(*) filter (where year(o_orderdate) = 1999) as counted, count(*) filter (where year(o_orderdate) <> 1999) as outside_year,
 cast(0 as bigint) as unparsed, true as reconciled from orders
""")
def _(spark, d):
    return audit.reconcile(b.table(spark, d, "orders"), 1999, "o_orderdate")


_HOURS = f"""{b.HOURLY}, holes as (select instant, case when extract(hour from instant) = 7 and extract(day from instant) % 9 = 0 then null else temp end as temp,
 case when extract(hour from instant) = 3 then -0.1 when extract(hour from instant) = 4 then -0.05 else rain end as rain, wind from hourly)"""


def _holes(spark, d):
    h = F.hour("instant")
    return b.hourly(spark, d).withColumns({
        "temp": F.when(~((h == 7) & (F.dayofmonth("instant") % 9 == 0)), F.col("temp")),
        "rain": F.when(h == 3, -0.1).when(h == 4, -0.05).otherwise(F.col("rain"))})


@query("a9_hourly_to_daily", f"""
with {_HOURS} select {b.LOCAL.format('instant')} as date, count(*) as hours,
 case when count(*) = count(temp) then round(avg(temp), 9) end as temp_mean, case when count(*) = count(temp) then round(min(temp), 9) end as temp_min,
 case when count(*) = count(temp) then round(max(temp), 9) end as temp_max from holes group by 1
""")
def _(spark, d):
    out = weather.hourly_to_daily(_holes(spark, d), ["temp"])
    return out.withColumns({"temp_mean": r6("temp_mean", 9), "temp_min": r6("temp_min", 9), "temp_max": r6("temp_max", 9)})


@query("a10_rain_wind_daily", f"""
with {_HOURS}, r as (select {b.LOCAL.format("(instant - interval 1 hour)")} as date, round(sum(greatest(rain, 0)), 6) as rain_sum, round(sum(rain), 6) as rain_raw_sum,
  count(*) filter (where rain < 0) as rain_negative_hours, count(*) as rain_hours from holes group by 1),
 w as (select {b.LOCAL.format('instant')} as date, round(avg(wind), 6) as wind_mean, max(wind) as wind_max from holes group by 1)
select coalesce(r.date, w.date) as date, rain_sum, rain_raw_sum, coalesce(rain_negative_hours, 0) as rain_negative_hours, coalesce(rain_hours, 0) as rain_hours,
 wind_mean, wind_max from r full join w on r.date = w.date
""")
def _(spark, d):
    out = weather.rain_wind_daily(_holes(spark, d))
    return out.withColumns({c: r6(c) for c in ("rain_sum", "rain_raw_sum", "wind_mean")})


@query("a11_day_length_profile", f"""
with {b.HOURLY} select hours, count(*) as days, min(date) as first_date from (select {b.LOCAL.format('instant')} as date, count(*) as hours from hourly group by 1) group by 1
""")
def _(spark, d):
    return audit.day_length_profile(b.hourly(spark, d), clock.local_date(F.col("instant"), weather.NEW_YORK))


@query("a29_carryover_by_origin", """
select o_orderpriority as origin, count(*) as read_rows, count(*) filter (where year(o_orderdate) = 1998) as scoped_rows,
 count(*) filter (where year(o_orderdate) <> 1998) as excluded_other_year_rows, cast(0 as bigint) as unparsed_start from orders group by 1
""")
def _(spark, d):
    return audit.carryover_by_origin(b.table(spark, d, "orders"), 1998, "o_orderpriority", "o_orderdate").withColumnRenamed(
        "o_orderpriority", "origin")


@query("t3_outside_sample", """
select o_orderkey, o_orderdate from orders where not (o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1997-01-01') order by o_orderkey limit 10
""")
def _(spark, d):
    return audit.outside_sample(b.table(spark, d, "orders").select("o_orderkey", "o_orderdate"), 1996, ["o_orderkey"], "o_orderdate")


@query("t4_random_example", """
select p_partkey, p_name from part where p_partkey <> 17 order by md5('7-' || cast(p_partkey as varchar)), p_partkey limit 1
""")
def _(spark, d):
    return sets.random_example(b.table(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", "7", [17])


@query("u1_union_history", f"with {b.DAILY} select date, trips from daily")
def _(spark, d):
    daily = b.daily_shipments(spark, d).drop("series")
    return sets.union_history(daily.where("date < date'1999-01-01'"), daily.where("date >= date'1999-01-01'"))


@query("u2_frames_equal", f"""
with {b.DAILY}, {b.DAILY_ORDERS}, s as (select date, trips, sum(s) as surplus from (select date, trips, 1 as s from daily union all select date, trips, -1 from odaily)
 group by 1, 2 having sum(s) <> 0) select count(*) as differing_rows, count(*) = 0 as equal from s
""")
def _(spark, d):
    return sets.frames_equal(b.daily_shipments(spark, d).drop("series"), b.daily_orders(spark, d).drop("series"))


@query("u3_partition_disjoint", """
select count(*) filter (where c_nationkey < 18) as rows, cast(0 as bigint) as repeated_ids, count(*) filter (where c_nationkey < 18 and c_nationkey >= 16) as shared_ids,
 count(*) filter (where c_nationkey < 18 and c_nationkey >= 16) = 0 as disjoint from customer
""")
def _(spark, d):
    c = b.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return sets.partition_disjoint(c.where("c_nationkey < 18"), "c_custkey", c.where("c_nationkey >= 16"))


@query("u4_expected_instants", f"""
with {b.HOURLY} select instant from hourly union select instant + interval 1 hour from hourly
""")
def _(spark, d):
    return weather.expected_instants(b.hourly(spark, d))


@query("f4_member_names", """
select coalesce(y, 0) as y, coalesce(m, 0) as m, tail, count(*) as rows from (
 select case when event_id % 3 <> 0 then 2024 end as y, case when event_id % 3 <> 0 then cast(event_id % 12 + 1 as integer) end as m,
  case when event_id % 3 = 0 then 'rows.csv' else '2024' || lpad(cast(event_id % 12 + 1 as varchar), 2, '0') || '-trips.csv' end as tail from events)
group by 1, 2, 3
""")
def _(spark, d):
    k = F.col("event_id")
    name = F.when(k % 3 == 0, "rows.csv").otherwise(F.concat(F.lit("2024"), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("-trips.csv")))
    m = b.table(spark, d, "events").select(F.concat(F.lit("outer.zip!/inner.zip!/"), name).alias("member"))
    return m.groupBy(F.coalesce(clock.member_year(F.col("member")), F.lit(0)).alias("y"),
                     F.coalesce(clock.member_month(F.col("member")), F.lit(0)).alias("m"),
                     clock.member_tail(F.col("member")).alias("tail")).agg(F.count(F.lit(1)).alias("rows"))


@query("f5_local_date", f"select {b.LOCAL.format('ts')} as date, count(*) as rows from events group by 1")
def _(spark, d):
    return b.table(spark, d, "events").groupBy(clock.local_date(F.col("ts"), weather.NEW_YORK).alias("date")).agg(F.count(F.lit(1)).alias("rows"))


_IN_1997 = "l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '1998-01-01'"


def _grown(spark, d):
    """Shipments arriving as three archives; the last arrives together with the first, whose members are known by then."""
    rows = b.table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("origin"), F.col("l_linenumber").alias("member"), F.col("l_shipdate").alias("started_at"),
        F.substring(F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber")), 1, 16).alias("ride_id"))
    state = growing.GrowingAudit(spark, scratch_path(spark, "audit"), 1997)
    for arriving in (["R"], ["N"], ["A", "R"]):
        state.add(rows.where(F.col("origin").isin(arriving)), "origin", "member")
    return state


@query("a29_growing_report", f"""
with k as (select md5(l_orderkey || '-' || l_linenumber) as id, count(*) as n from lineitem where {_IN_1997} group by 1)
select count(distinct l_returnflag || l_linenumber) as members, count(*) as rows, count(*) filter (where {_IN_1997}) as counted, count(*) filter (where not ({_IN_1997})) as outside_year,
 cast(0 as bigint) as unparsed, cast(0 as bigint) as invalid_ids, (select cast(coalesce(sum(n - 1), 0) as bigint) from k) as extra_rows, (select count(*) from k where n > 1) as repeated_ids,
 count(distinct case when {_IN_1997} then cast(l_shipdate as date) end) as days, 365 - count(distinct case when {_IN_1997} then cast(l_shipdate as date) end) as missing_days, true as reconciled from lineitem
""")
def _(spark, d):
    """Three additions, each audited against stored sums and ids alone, equal one audit of all rows."""
    return _grown(spark, d).report()


@query("s3_growing_manifest", f"""
select l_returnflag as origin, cast(l_linenumber as varchar) as member, count(*) as rows, min(l_shipdate) as first_started_at, max(l_shipdate) as last_started_at,
 count(distinct case when {_IN_1997} then cast(l_shipdate as date) end) as distinct_start_dates,
 count(*) filter (where not ({_IN_1997})) as outside_selected_year, count(*) filter (where {_IN_1997}) as counted_rides from lineitem group by 1, 2
""")
def _(spark, d):
    return _grown(spark, d).manifest()
