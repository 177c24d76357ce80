"""Row-level audits of raw events and their reduction to verified daily counts.

Everything here is a projection plus map-side-combined aggregates; rows are never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions import clock


def year_bounds(year: int) -> tuple[Column, Column]:
    return (F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz"),
            F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz"))


def starts_in_year(start: str | Column, year: int) -> Column:
    """Half-open range on the bare column, so it reaches the scan as a pushed filter."""
    start = F.col(start) if isinstance(start, str) else start
    low, high = year_bounds(year)
    return (start >= low) & (start < high)


def in_year(df: DataFrame, year: int, start: str = "started_at") -> DataFrame:
    return df.where(starts_in_year(start, year))


def scope_counts(df: DataFrame, year: int, start: str = "started_at") -> DataFrame:
    """One row: raw rows, counted rows, rows outside the year, rows without a start."""
    kept = starts_in_year(start, year)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(kept).alias("counted"),
        F.count_if(F.col(start).isNotNull() & ~kept).alias("outside_year"),
        F.count_if(F.col(start).isNull()).alias("unparsed"),
    )


def reconcile(df: DataFrame, year: int, start: str = "started_at") -> DataFrame:
    """:func:`scope_counts` with ``reconciled``: counted plus excluded equals the raw rows."""
    counts = scope_counts(df, year, start)
    return counts.withColumn("reconciled", F.col("counted") + F.col("outside_year") == F.col("rows"))


def require_reconciled(df: DataFrame, year: int, start: str = "started_at") -> dict:
    """Action: raise unless the row counts reconcile; returns the one-row report."""
    report = reconcile(df, year, start).first().asDict()
    if not report["reconciled"]:
        raise ValueError(f"counted and excluded rows do not reconcile: {report}")
    return report


def issue_counts(df: DataFrame, year: int, start: str = "started_at", end: str = "ended_at",
                 member: str | None = None, spring_date: str | None = None,
                 autumn_date: str | None = None, ride_id: str | None = None) -> DataFrame:
    """One row of anomaly counts. Rows are flagged, never dropped.

    ``spring_date`` / ``autumn_date`` are the clock-change dates whose 02:xx does not exist
    and whose 01:xx occurs twice.
    """
    s, e = F.col(start), F.col(end)
    kept = starts_in_year(start, year)
    seconds = clock.seconds_between(s, e)
    out = {
        "unparsed_start": s.isNull(),
        "unparsed_end": e.isNull(),
        "outside_selected_year": s.isNotNull() & ~kept,
        "negative_clock_duration": seconds < 0,
        "zero_clock_duration": seconds == 0,
        "under_60_second_clock_duration": (seconds >= 0) & (seconds < 60),
        "over_24_hour_clock_duration": seconds > 86400,
    }
    if member:
        named = clock.member_year(F.col(member)).isNotNull()
        y, m = clock.member_year(F.col(member)), clock.member_month(F.col(member))
        for side, c in (("start", s), ("end", e)):
            out[f"{side}_outside_filename_month"] = named & c.isNotNull() & ~((F.year(c) == y) & (F.month(c) == m))
    if spring_date:
        out["spring_nonexistent_clock_hour"] = (F.to_date(s) == F.to_date(F.lit(spring_date))) & (F.hour(s) == 2)
    if autumn_date:
        out["autumn_ambiguous_clock_hour"] = (F.to_date(s) == F.to_date(F.lit(autumn_date))) & (F.hour(s) == 1)
    if ride_id:
        out["missing_or_non_hex_ride_id"] = ~clock.is_hex_id(F.col(ride_id))
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in out.items()])


def member_manifest(df: DataFrame, year: int, member: str = "_member", start: str = "started_at") -> DataFrame:
    """Per file: rows, first and last start, distinct in-scope dates, outside and counted rows."""
    kept = starts_in_year(start, year)
    outside = F.col(start).isNotNull() & ~kept
    # Days first, then files: the distinct dates become a plain count of day groups.
    by_day = df.groupBy(member, F.when(kept, F.to_date(start)).alias("_day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(start).alias("first_started_at"),
        F.max(start).alias("last_started_at"),
        F.count_if(outside).alias("outside_selected_year"),
    )
    return by_day.groupBy(member).agg(
        F.sum("rows").alias("rows"),
        F.min("first_started_at").alias("first_started_at"),
        F.max("last_started_at").alias("last_started_at"),
        F.count("_day").alias("distinct_start_dates"),
        F.sum("outside_selected_year").alias("outside_selected_year"),
    ).withColumn("counted_rides", F.col("rows") - F.col("outside_selected_year"))


def header_inventory(df: DataFrame, header: str = "_header", member: str = "_member") -> DataFrame:
    """Each distinct header with the members that carry it, one row per pair."""
    return df.select(header, member).distinct()


def daily_counts(df: DataFrame, start: str = "started_at", series: Sequence[str] = (),
                 value: str = "trips") -> DataFrame:
    """Starts per printed date. A row without a start is not counted; nothing else is dropped."""
    return (df.where(F.col(start).isNotNull())
            .groupBy(*series, F.to_date(start).alias("date"))
            .agg(F.count(F.lit(1)).alias(value)))


def hour_histogram(df: DataFrame, start: str = "started_at") -> DataFrame:
    return (df.where(F.col(start).isNotNull()).groupBy(F.hour(start).cast("long").alias("hour"))
            .agg(F.count(F.lit(1)).alias("rides")))


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and percent per column, from one aggregate row."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}") for i, c in enumerate(columns)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing"),
                 (F.col(f"_m{i}") * F.lit(100.0) / F.col("_rows")).alias("percent"))
        for i, c in enumerate(columns)])))


def category_counts(df: DataFrame, columns: Sequence[str], missing: str = "<missing>") -> DataFrame:
    """Frequencies per column with a level for nulls, all columns in one shuffle."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(missing)).alias("level"))
        for c in columns])))
    return long.groupBy("column", "level").agg(F.count(F.lit(1)).alias("rows"))


def duplicate_ids(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ids that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def duplicate_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: extra rows and distinct repeated ids."""
    return duplicate_ids(df, keys).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra_rows"),
        F.count(F.lit(1)).alias("repeated_ids"),
    )


def duplicate_sample(df: DataFrame, keys: Sequence[str], k: int = 20) -> DataFrame:
    """The first ``k`` repeated ids in id order."""
    return duplicate_ids(df, keys).orderBy(*keys).limit(k)


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of each equal group; null equals null."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("extra_rows")))


def collision_groups(df: DataFrame, columns: Sequence[str], row_id: str, partition: str, label: str,
                     positive="p") -> DataFrame:
    """Groups of rows with equal predictors (null pattern included).

    Only aggregates leave a group, so a group of any size is combined map-side; the group is
    named by its smallest row id and :func:`collision_members` lists its rows.
    """
    is_positive = F.col(label) == F.lit(positive)
    null_columns = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return (
        df.groupBy(*columns)
        .agg(F.min(row_id).alias("group_id"), F.count(F.lit(1)).alias("rows"),
             F.min(partition).alias("_p0"), F.max(partition).alias("_p1"),
             F.count_if(is_positive).alias("positive_rows"), F.count_if(~is_positive).alias("negative_rows"))
        .where(F.col("rows") > 1)
        .withColumn("crosses_partitions", F.col("_p0") != F.col("_p1"))
        .withColumn("labels_agree", (F.col("positive_rows") == 0) | (F.col("negative_rows") == 0))
        .withColumn("missing_features", F.concat_ws(",", null_columns))
        .drop("_p0", "_p1")
    )


def collision_members(df: DataFrame, columns: Sequence[str], row_id: str, carry: Sequence[str] = ()) -> DataFrame:
    """Rows that belong to a collision group, with the group's id."""
    groups = (df.groupBy(*columns).agg(F.min(row_id).alias("group_id"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).drop("_n").alias("g"))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}"))
    return df.alias("r").join(groups, same).select(
        F.col("g.group_id"), F.col(f"r.{row_id}"), *[F.col(f"r.{c}") for c in carry])


def missing_dates(daily: DataFrame, first: Column | None = None, last: Column | None = None,
                  day: str = "date") -> DataFrame:
    """Expected calendar minus observed dates. Gaps are reported, never filled."""
    span = daily.agg(F.min(day).alias("_a"), F.max(day).alias("_b")).select(
        (first if first is not None else F.col("_a")).alias("_a"),
        (last if last is not None else F.col("_b")).alias("_b"))
    expected = span.select(F.explode(F.sequence("_a", "_b")).alias(day))
    return expected.join(daily.select(day).distinct(), day, "left_anti")


def missing_hours(hourly: DataFrame, hour: str = "hour") -> DataFrame:
    span = hourly.agg(F.min(hour).alias("_a"), F.max(hour).alias("_b"))
    expected = span.select(F.explode(F.expr("sequence(_a, _b, interval 1 hour)")).alias(hour))
    return expected.join(hourly.select(hour).distinct(), hour, "left_anti")


def carryover_by_origin(df: DataFrame, year: int, origin: str, start: str = "started_at") -> DataFrame:
    """Rows read per source archive, and those of them that start in the selected year."""
    kept = starts_in_year(start, year)
    return df.groupBy(origin).agg(
        F.count(F.lit(1)).alias("read_rows"),
        F.count_if(kept).alias("scoped_rows"),
        F.count_if(F.col(start).isNotNull() & ~kept).alias("excluded_other_year_rows"),
        F.count_if(F.col(start).isNull()).alias("unparsed_start"),
    )


def outside_sample(df: DataFrame, year: int, order: Sequence[str], start: str = "started_at", k: int = 10) -> DataFrame:
    """The first ``k`` rows outside the year, in id order (a bounded top-k, no full sort)."""
    return df.where(F.col(start).isNotNull() & ~starts_in_year(start, year)).orderBy(*order).limit(k)


def day_lengths(hourly: DataFrame, day: Column) -> DataFrame:
    """Hours per local date."""
    return hourly.groupBy(day.alias("date")).agg(F.count(F.lit(1)).alias("hours"))


def day_length_profile(hourly: DataFrame, day: Column) -> DataFrame:
    """How many local dates have each number of hours."""
    return (day_lengths(hourly, day).groupBy("hours")
            .agg(F.count(F.lit(1)).alias("days"), F.min("date").alias("first_date")))
