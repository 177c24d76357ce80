"""Clock labels, ids and member names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Fixed value: a trailing UTC offset or Z after a time of day.
OFFSET_PATTERN = r"(?i)\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|UTC|GMT|[+-]\d{2}(:?\d{2})?)\s*$"
# Fixed value: a date written month/day/year.
MONTH_FIRST_PATTERN = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
# Fixed value: sixteen hexadecimal digits.
HEX_ID_PATTERN = r"^[0-9A-Fa-f]{16}\z"
# Fixed value: a monthly file name carries year and month before a hyphen and a word.
MEMBER_MONTH_PATTERN = r"(20\d{2})(\d{2})-[A-Za-z]"


def has_offset(text: Column) -> Column:
    return F.coalesce(text.rlike(OFFSET_PATTERN), F.lit(False))


def parse_clock(text: Column) -> Column:
    """Text to a zone-free timestamp. Bad text is null; an offset is an error, never shifted.

    ISO order and month/day/year order are read. The cast goes straight to a zone-free type, so
    the session's zone (and its clock changes) cannot move a label.
    """
    iso = F.regexp_replace(F.trim(text), MONTH_FIRST_PATTERN, "$3-$1-$2")
    parsed = F.when(iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), iso.try_cast("timestamp_ntz"))
    refused = F.raise_error(F.concat(F.lit("clock label carries an offset: "), text)).cast("timestamp_ntz")
    return F.when(has_offset(text), refused).otherwise(parsed)


def is_hex_id(text: Column) -> Column:
    return F.coalesce(text.rlike(HEX_ID_PATTERN), F.lit(False))


def ride_key(text: Column) -> Column:
    """One spelling per id: upper and lower case name the same ride. Not an id is an error."""
    refused = F.raise_error(F.concat(F.lit("not a ride id: "), F.coalesce(text, F.lit("null")))).cast("string")
    return F.when(is_hex_id(text), F.upper(text)).otherwise(refused)


def member_tail(member: Column) -> Column:
    """Last part of ``outer.zip!/inner.zip!/file.csv``."""
    return F.element_at(F.split(member, "!/"), -1)


def _member_part(member: Column, group: int) -> Column:
    name = F.element_at(F.split(member_tail(member), "/"), -1)
    return F.try_to_number(F.regexp_extract(name, MEMBER_MONTH_PATTERN, group), F.lit("9999")).cast("int")


def member_year(member: Column) -> Column:
    """Year in the file name, null when the name carries none."""
    return _member_part(member, 1)


def member_month(member: Column) -> Column:
    return _member_part(member, 2)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds on the printed clocks, whatever the session's zone."""
    gap = end - start
    part = lambda unit: F.extract(F.lit(unit), gap).cast("double")
    return part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")


def utc_clock(df: DataFrame, instant: str) -> Column:
    """The UTC wall clock of an instant column; a zone-free column is taken to be one already."""
    if isinstance(df.schema[instant].dataType, TimestampNTZType):
        return F.col(instant)
    seconds = (F.unix_micros(F.col(instant)) / F.lit(1000000)).cast("decimal(20,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def local_clock(utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC wall clock, by the zone's rules."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))


def local_date(utc: Column, zone: str) -> Column:
    return F.to_date(local_clock(utc, zone))
