"""From raw trip rows to an accepted daily series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.clock import ride_key
from daymark.operators import audit
from daymark.session import materialize

CATEGORIES = ("rideable_type", "member_casual")


@dataclass
class TripAudit:
    """Lazy tables of one audit; the daily counts are accepted by :func:`accept_daily`."""

    daily: DataFrame
    issues: DataFrame
    scope: DataFrame
    members: DataFrame
    missing_values: DataFrame
    categories: DataFrame
    hours: DataFrame
    duplicates: DataFrame
    duplicate_ids: DataFrame
    outside: DataFrame
    missing_dates: DataFrame


def audit_trips(trips: DataFrame, year: int, spring_date: str | None = None, autumn_date: str | None = None,
                store: bool = True) -> TripAudit:
    """Audit parsed trip rows (see ``sources.zip_csv``). With ``store`` the parsed rows are written
    once, so that archives are read and parsed once for all tables."""
    if store:
        trips = materialize(trips, "trips")
    inside = audit.in_year(trips, year)
    keyed = trips.select(ride_key(F.col("ride_id")).alias("ride_id"))
    low, high = (F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date"))
    daily = audit.daily_counts(inside)
    described = [c for c in trips.columns if not c.startswith("_")]
    return TripAudit(
        daily=daily,
        issues=audit.issue_counts(trips, year, member="_member" if "_member" in trips.columns else None,
                                  spring_date=spring_date, autumn_date=autumn_date),
        scope=audit.reconcile(trips, year),
        members=audit.member_manifest(trips, year),
        missing_values=audit.missing_profile(trips, described),
        categories=audit.category_counts(trips, [c for c in CATEGORIES if c in trips.columns]),
        hours=audit.hour_histogram(inside),
        duplicates=audit.duplicate_audit(keyed, ["ride_id"]),
        duplicate_ids=audit.duplicate_sample(keyed, ["ride_id"]),
        outside=audit.outside_sample(trips.select("ride_id", "started_at", "ended_at"), year, ["started_at", "ride_id"]),
        missing_dates=audit.missing_dates(daily, low, high),
    )


def accept_daily(found: TripAudit) -> DataFrame:
    """Action: the daily counts, or an error that names every gate they fail."""
    problems = []
    gaps = found.missing_dates.count()
    if gaps:
        problems.append(f"{gaps} dates have no trips")
    scope = found.scope.first()
    if scope["unparsed"]:
        problems.append(f"{scope['unparsed']} starts could not be read")
    if not scope["reconciled"]:
        problems.append("counted and excluded rows do not add up to the raw rows")
    extra = found.duplicates.first()["extra_rows"]
    if extra:
        problems.append(f"{extra} rows repeat a ride id")
    if problems:
        raise ValueError("; ".join(problems))
    return found.daily
