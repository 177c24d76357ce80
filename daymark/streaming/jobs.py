"""Incremental counting, de-duplication, late rows, history features and scoring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from daymark.operators.joins import route_with_fallback
from daymark.streaming.runner import run_batches

HISTORY_DAYS = 28
DAY_MS = 86_400_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FEATURES = ("{series} string, date date, trips bigint, weekday int, month int, lag_1 bigint, lag_7 bigint, "
            "past_7_day_mean double, gap_days int, late boolean")


def with_event_time(rows: DataFrame, start: str, delay: str) -> DataFrame:
    """A watermark needs an instant, so the clock label is read as UTC; the session must agree,
    or day windows would not start at the label's midnight."""
    zone = rows.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC for day windows, not {zone}")
    return rows.withColumn(start, F.col(start).cast("timestamp")).withWatermark(start, delay)


def daily_windows(rows: DataFrame, start: str = "started_at", delay: str = "1 day", series: Sequence[str] = (),
                  value: str = "trips") -> DataFrame:
    """Starts per one-day window. Complete mode equals the batch count; append emits closed days only."""
    timed = with_event_time(rows, start, delay)
    counted = timed.groupBy(F.window(start, "1 day"), *series).agg(F.count(F.lit(1)).alias(value))
    return counted.select(*series, F.to_date(F.col("window.start")).alias("date"), value)


def first_seen(rows: DataFrame, ride_id: str = "ride_id", start: str = "started_at", delay: str = "40 days") -> DataFrame:
    """An id counts once across files that arrive within ``delay`` of each other."""
    return with_event_time(rows, start, delay).dropDuplicatesWithinWatermark([ride_id])


def split_late_rows(rows: DataFrame, start: str = "started_at", delay: str = "1 day",
                    base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run the stream; return (accepted rows, too-late rows).

    The bound of a batch is the newest start of all earlier batches less ``delay``. A row behind
    it is kept aside and reported; an earlier start within the delay still counts on its own date.
    Each batch writes its own folders, so a repeated batch changes nothing.
    """
    spark = rows.sparkSession
    schema = rows.schema

    newest_so_far = "newest timestamp_ntz"

    def handle(batch: DataFrame, batch_id: int, base: str) -> None:
        session = batch.sparkSession
        here = F.max(F.col(start).cast("timestamp_ntz")).alias("newest")
        late = F.lit(False)
        if batch_id:
            before = session.read.schema(newest_so_far).parquet(f"{base}/newest/{batch_id - 1}")
            bound = before.select(F.max("newest") - F.expr(f"INTERVAL {delay}")).scalar()
            batch = batch.withColumn("_bound", bound)
            late = F.coalesce(F.col(start) < F.col("_bound"), F.lit(False))
        batch.withColumn("_late", late).select(*schema.names, "_late").write.mode("overwrite").parquet(
            f"{base}/rows/batch={batch_id}")
        newest = session.read.schema(schema).parquet(f"{base}/rows/batch={batch_id}").agg(here)
        if batch_id:
            newest = newest.unionByName(before).agg(F.max("newest").alias("newest"))
        newest.write.mode("overwrite").parquet(f"{base}/newest/{batch_id}")

    base = run_batches(rows, handle, "late", base)
    table = spark.read.schema(StructType([*schema.fields, StructField("_late", BooleanType())])).parquet(f"{base}/rows")
    return table.where(~F.col("_late")).select(*rows.columns), table.where("_late").select(*rows.columns)


class HistoryFeatures(StatefulProcessor):
    """Keeps the last 28 closed daily totals of a series and emits one-step features per closed day.

    Missing days break the history: the totals before a gap are dropped and the gap is reported. A day
    that is not after the newest one seen comes out as ``late``, without features, and changes nothing.
    """

    def __init__(self, series: str):
        self.series = series

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getValueState("history", "last date, totals array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        days = pd.concat(list(rows)).sort_values("date")  # closed days of one series in one batch
        last, totals = self.history.get() if self.history.exists() else (None, [])
        totals = list(totals)
        out = []
        for day, count in zip(days["date"], days["trips"]):
            gap = (day - last).days - 1 if last is not None else 0
            if gap < 0:
                out.append((key[0], day, int(count), day.weekday(), day.month, None, None, None, gap, True))
                continue
            if gap:
                totals = []
            if len(totals) >= 7:
                out.append((key[0], day, int(count), day.weekday(), day.month, totals[-1], totals[-7], sum(totals[-7:]) / 7.0, gap, False))
            elif gap:
                out.append((key[0], day, int(count), day.weekday(), day.month, None, None, None, gap, False))
            totals = (totals + [int(count)])[-HISTORY_DAYS:]
            last = day
        self.history.update((last, totals))
        frame = pd.DataFrame(out, columns=[self.series, "date", "trips", "weekday", "month", "lag_1", "lag_7", "past_7_day_mean", "gap_days", "late"])
        yield frame.astype({"late": "bool", "lag_1": "Int64", "lag_7": "Int64", "trips": "Int64"})

    def close(self) -> None:
        pass


def history_features(closed_days: DataFrame, series: str = "series") -> DataFrame:
    """Features from a stream of closed daily totals (series, date, trips), one row per day in.

    Spark keeps such state in RocksDB only, so the session is pointed at that store.
    """
    closed_days.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return closed_days.groupBy(series).transformWithStateInPandas(
        statefulProcessor=HistoryFeatures(series), outputStructType=FEATURES.format(series=series),
        outputMode="Append", timeMode="None")


class DayTimers(StatefulProcessor):
    """Closes the days of a series by event-time timers and emits each closed day's features.

    A day's total is kept until the watermark passes the day's end. The timer of a day handles every day
    up to it that is still open, in order, so the order in which timers fire does not matter.
    """

    def __init__(self, series: str):
        self.series = series

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open_days = handle.getMapState("open", "date date", "trips bigint")
        self.history = handle.getValueState("history", "last date, totals array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for day, trips in zip(batch["date"], batch["trips"]):
                held = self.open_days.getValue((day,))[0] if self.open_days.containsKey((day,)) else 0
                self.open_days.updateValue((day,), (held + int(trips),))
                self.handle.registerTimer(int(pd.Timestamp(day).timestamp() * 1000) + DAY_MS)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs() - DAY_MS, unit="ms").date()
        due = sorted((day, trips) for (day,), (trips,) in self.open_days.iterator() if day <= closed)
        last, totals = self.history.get() if self.history.exists() else (None, [])
        totals, out = list(totals), []
        for day, trips in due:
            gap = (day - last).days - 1 if last is not None else 0
            if gap:
                totals = []
            if len(totals) >= 7:
                out.append((key[0], day, trips, day.weekday(), day.month, totals[-1], totals[-7], sum(totals[-7:]) / 7.0, gap))
            totals, last = (totals + [trips])[-HISTORY_DAYS:], day
            self.open_days.removeKey((day,))
        if due:
            self.history.update((last, totals))
        yield pd.DataFrame(out, columns=[self.series, "date", "trips", "weekday", "month", "lag_1", "lag_7", "past_7_day_mean", "gap_days"])

    def close(self) -> None:
        """Nothing is held outside the state."""


def timed_history_features(rows: DataFrame, start: str = "started_at", delay: str = "1 day", series: str = "series") -> DataFrame:
    """One streaming query from raw starts to features of closed days.

    Starts are counted per day window; a window that the watermark closes goes straight to its series'
    processor, whose event-time timer for that day emits the features. Needs seven whole days before it.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    counted = with_event_time(rows, start, delay).groupBy(F.window(start, "1 day"), series).agg(F.count(F.lit(1)).alias("trips"))
    closed = counted.select(series, F.to_date(F.col("window.start")).alias("date"), "trips", F.window_time("window").alias("closed_at"))
    return closed.groupBy(series).transformWithStateInPandas(
        statefulProcessor=DayTimers(series), outputStructType=FEATURES.format(series=series).removesuffix(", late boolean"),
        outputMode="Append", timeMode="EventTime")


def join_forecasts(requests: DataFrame, forecasts: DataFrame, on: Sequence[str], requested: str, issued: str, value: str, fallback: str,
                   within: str = "1 day", delay: str = "1 day", preferred_name: str = "weather", counts_name: str = "counts") -> DataFrame:
    """Requests answered from a second stream: the forecast issued within ``within`` of the request, on either side.

    A left outer join of two streams. A forecast answers as soon as both sides are there; a request whose time
    bound both watermarks have passed without one is answered by its own ``fallback``. State is held for the
    bound and the delay only.
    """
    left = with_event_time(requests, requested, delay).alias("request")
    right = with_event_time(forecasts.select(*on, issued, F.col(value).cast("double").alias(value)), issued, delay).alias("forecast")
    bound = F.col(f"forecast.{issued}").between(F.col(f"request.{requested}") - F.expr(f"INTERVAL {within}"),
                                                F.col(f"request.{requested}") + F.expr(f"INTERVAL {within}"))
    for c in on:
        bound = bound & (F.col(f"request.{c}") == F.col(f"forecast.{c}"))
    met = left.join(right, bound, "leftOuter")
    found = F.col(f"forecast.{value}").isNotNull()
    return met.select(*[F.col(f"request.{c}") for c in requests.columns],
                      F.when(found, F.col(f"forecast.{value}")).otherwise(F.col(f"request.{fallback}").cast("double")).alias("prediction"),
                      F.when(found, F.lit(preferred_name)).otherwise(F.lit(counts_name)).alias("used_model"))


def score_with_fallback(rows: DataFrame, preferred: DataFrame, on: Sequence[str], value: str, fallback: str,
                        preferred_name: str = "weather", counts_name: str = "counts", model=None,
                        base: str | None = None) -> DataFrame:
    """Run the stream; score each micro-batch with the same functions as the batch job.

    ``model`` (a fitted pipeline) may add the fallback column first. Each batch writes its own folder.
    """
    def handle(batch: DataFrame, batch_id: int, base: str) -> None:
        scored = model.transform(batch) if model is not None else batch
        routed = route_with_fallback(scored, preferred, on, value, fallback, preferred_name, counts_name)
        routed.write.mode("overwrite").parquet(f"{base}/scored/batch={batch_id}")

    base = run_batches(rows, handle, "scored", base)
    return rows.sparkSession.read.parquet(f"{base}/scored").drop("batch")


