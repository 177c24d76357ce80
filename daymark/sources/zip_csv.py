"""``spark.read.format("zipcsv")``: every CSV in ZIP archives, nested to any depth.

One partition per top-level entry of each archive, so a large archive spreads over tasks; the
driver reads the archives' directories only. Members stream through Arrow in blocks.

Conditions on ``_member`` are pushed into the source, so a filtered read opens the members that meet them
and no others, and skips nested archives that cannot hold one. Checks of a member (required and unknown
columns, no rows) apply to the members that are opened.
"""

from __future__ import annotations

import csv
import re
import shutil
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager
from typing import IO

import pyarrow as pa
import pyarrow.csv as pa_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, Not, StringContains, StringEndsWith,
    StringStartsWith)
from pyspark.sql.types import StructType

from daymark.functions.clock import parse_clock
from daymark.operators.validate import REQUIRED_TRIP_COLUMNS, require_columns
from daymark.sources.files import list_files, open_path

# The columns of a trip row, in file order.
TRIP_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id",
    "end_station_name", "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng", "member_casual"]
# Texts that stand for a missing value in a CSV field.
NULL_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
              "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
BLOCK_BYTES = 8 * 1024 * 1024
SPOOL_BYTES = 64 * 1024 * 1024


TABLE_OR_ARCHIVE = re.compile(r"\.(csv|zip)$", re.IGNORECASE)
# Where one desktop system leaves its resource copies.
RESOURCE_COPY = re.compile(r"(^|/)(__MACOSX/|\._[^/]*$)")
#: What the reader adds to a member's own columns; size and checksum come from the archive's directory.
ADDED = {"_member": "string", "_header": "string", "_bytes": "long", "_crc": "long"}


def _inside(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """Tables and archives directly inside, by name."""
    found = [i for i in archive.infolist() if TABLE_OR_ARCHIVE.search(i.filename) and not RESOURCE_COPY.search(i.filename)]
    return sorted(found, key=lambda i: i.filename)


def _is_table(name: str) -> bool:
    return name.lower().endswith(".csv")


@contextmanager
def _opened_inner(archive: zipfile.ZipFile, info: zipfile.ZipInfo):
    """An archive inside an archive needs seeking, so it is copied: to memory, or to the task's disk when large."""
    with tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES) as copy:
        with archive.open(info) as packed:
            shutil.copyfileobj(packed, copy, BLOCK_BYTES)
        with zipfile.ZipFile(copy) as inner:
            yield inner


def _decides(condition: Filter) -> bool:
    """Whether a member's path alone tells if the condition holds."""
    if isinstance(condition, Not):
        return _decides(condition.child)
    known = (EqualTo, EqualNullSafe, In, IsNotNull, StringStartsWith, StringEndsWith, StringContains)
    return isinstance(condition, known) and condition.attribute == ("_member",)


def _holds(condition: Filter, where: str) -> bool:
    match condition:
        case Not(child=inner):
            return not _holds(inner, where)
        case EqualTo(value=text) | EqualNullSafe(value=text):
            return where == text
        case In(value=texts):
            return where in texts
        case StringStartsWith(value=text):
            return where.startswith(text)
        case StringEndsWith(value=text):
            return where.endswith(text)
        case StringContains(value=text):
            return text in where
    return True


def _may_hold_below(condition: Filter, prefix: str) -> bool:
    """Whether the condition can hold for some path that starts with ``prefix``."""
    match condition:
        case EqualTo(value=text) | EqualNullSafe(value=text):
            return str(text).startswith(prefix)
        case In(value=texts):
            return any(str(t).startswith(prefix) for t in texts)
        case StringStartsWith(value=text):
            return text.startswith(prefix) or prefix.startswith(text)
    return True


def _archive_prefix(file: str) -> str:
    return f"{file.rstrip('/').rsplit('/', 1)[-1]}!/"


def _tables(file: str, entry: str, opens, enters) -> Iterator[tuple[str, zipfile.ZipInfo, IO[bytes]]]:
    """(path inside, directory record, stream) of each table at or below one top-level entry.

    ``opens`` and ``enters`` tell by its path whether a table or a nested archive is looked into.

    Archives that are open wait on a list, each with what is left of its contents; the last one is
    worked on first and closed when nothing is left, so open copies are bounded by the depth.
    """
    with ExitStack() as whole:
        top = whole.enter_context(zipfile.ZipFile(whole.enter_context(open_path(file))))
        waiting = [(_archive_prefix(file), top, iter([top.getinfo(entry)]), ExitStack())]
        whole.callback(lambda: [level[3].close() for level in reversed(waiting)])
        while waiting:
            prefix, archive, left, owner = waiting[-1]
            info = next(left, None)
            if info is None:
                waiting.pop()
                owner.close()
            elif _is_table(info.filename):
                if opens(prefix + info.filename):
                    with archive.open(info) as stream:
                        yield prefix + info.filename, info, stream
            elif enters(f"{prefix}{info.filename}!/"):
                owner = ExitStack()
                inner = owner.enter_context(_opened_inner(archive, info))
                waiting.append((f"{prefix}{info.filename}!/", inner, iter(_inside(inner)), owner))


class _Entry(InputPartition):
    def __init__(self, path: str, name: str):
        self.path = path
        self.name = name


class _ZipCsvReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = [f.name for f in schema.fields]
        self.paths = [p for p in options.get("path", options.get("paths", "")).split(",") if p]
        self.required = [c for c in options.get("required", "").split(",") if c]
        self.members = options.get("members", "")
        self.unknown = options.get("unknown", "fail")
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps the conditions on ``_member``; Spark applies all others."""
        for condition in filters:
            if _decides(condition):
                self.conditions.append(condition)
            else:
                yield condition

    def _opens(self, where: str) -> bool:
        return bool(re.search(self.members, where)) and all(_holds(c, where) for c in self.conditions)

    def _enters(self, prefix: str) -> bool:
        return all(_may_hold_below(c, prefix) for c in self.conditions)

    def partitions(self) -> list[_Entry]:
        entries, found = [], False
        for path in self.paths:
            for file in list_files(path, ".zip"):
                with open_path(file) as stream, zipfile.ZipFile(stream) as archive:
                    names = [i.filename for i in _inside(archive)]
                names = [n for n in names if not _is_table(n) or re.search(self.members, n)]
                found = found or bool(names)
                top = _archive_prefix(file)
                entries += [_Entry(file, n) for n in names
                            if (self._opens(top + n) if _is_table(n) else self._enters(f"{top}{n}!/"))]
        if not found:
            raise ValueError(f"{', '.join(self.paths)}: no archive here holds a table or another archive")
        return entries

    def read(self, partition: _Entry | None):
        if partition is None:  # Spark plans one empty partition where the conditions leave none
            return
        for where, info, stream in _tables(partition.path, partition.name, self._opens, self._enters):
            yield from self._batches(where, info, stream)

    def _batches(self, where: str, info: zipfile.ZipInfo, stream) -> Iterator[pa.RecordBatch]:
        names = next(csv.reader([stream.readline().decode("utf-8-sig").strip("\r\n")]), [])
        absent = [c for c in self.required if c not in names]
        if absent:
            raise ValueError(f"{where} lacks {', '.join(absent)}; its columns are {', '.join(names)}")
        unknown = [c for c in names if c not in self.columns]
        if unknown and self.unknown == "fail":
            raise ValueError(f"{where} also has {', '.join(unknown)}; list the columns to read, or pass unknown='drop'")
        added = {"_member": where, "_header": ",".join(names), "_bytes": info.file_size, "_crc": info.CRC}
        rows = 0
        wanted = [c for c in names if c in self.columns] or names[:1]  # others are not converted
        for batch in self._blocks(where, names, wanted, stream):
            rows += batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(added[c], pa.string() if ADDED[c] == "string" else pa.int64()), batch.num_rows) if c in ADDED
                else batch.column(wanted.index(c)) if c in wanted else pa.nulls(batch.num_rows, pa.string())
                for c in self.columns], names=self.columns)
        if not rows:
            raise ValueError(f"{where} has no rows")

    @staticmethod
    def _blocks(where: str, names: list[str], wanted: list[str], stream):
        texts = pa_csv.ConvertOptions(column_types=dict.fromkeys(wanted, pa.string()), null_values=NULL_TEXTS,
                                      strings_can_be_null=True, include_columns=wanted)
        try:
            return pa_csv.open_csv(stream, pa_csv.ReadOptions(column_names=names, block_size=BLOCK_BYTES),
                                   pa_csv.ParseOptions(newlines_in_values=True), texts)
        except pa.ArrowInvalid as error:
            if "Empty CSV" in str(error):  # nothing follows the header
                raise ValueError(f"{where} has no rows") from None
            raise


class ZipCsvSource(DataSource):
    """Options: ``path`` or ``paths`` (comma-separated files or folders), ``required`` columns,
    ``members`` (a pattern that keeps matching member names only), ``unknown`` (``fail`` or ``drop`` where a
    member has columns beyond the schema; fail unless set)."""

    @classmethod
    def name(cls) -> str:
        return "zipcsv"

    def schema(self) -> str:
        return ", ".join([*(f"{c} string" for c in TRIP_COLUMNS), *(f"{c} {t}" for c, t in ADDED.items())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ZipCsvReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let Spark hand it filters (a session setting that is off by default)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipCsvSource)


def read_zip_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None,
                 required: Sequence[str] = (), members: str = "", unknown: str | None = None) -> DataFrame:
    """Text columns of every table. Without ``columns`` they are a trip's, and others raise; with them, others are not read."""
    register(spark)
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("zipcsv").option("paths", ",".join(paths)).option("required", ",".join(required)).option(
        "members", members).option("unknown", unknown or ("fail" if columns is None else "drop"))
    if columns is not None:
        reader = reader.schema(", ".join([*(f"`{c}` string" for c in columns), *(f"{c} {t}" for c, t in ADDED.items())]))
    return reader.load()


def read_trips(spark: SparkSession, paths: str | Sequence[str], members: str = "") -> DataFrame:
    """Trip rows as text with parsed clocks; required columns must be in every member."""
    return parse_trips(read_zip_csv(spark, paths, required=REQUIRED_TRIP_COLUMNS, members=members))


def read_trip_csv(spark: SparkSession, path: str) -> DataFrame:
    """The same rows from plain CSV files; each file's header is checked against the names."""
    raw = spark.read.csv(path, header=True, schema=", ".join(f"{c} string" for c in TRIP_COLUMNS), enforceSchema=False)
    known = raw.withColumns({c: F.when(~F.col(c).isin(NULL_TEXTS), F.col(c)) for c in TRIP_COLUMNS})
    return parse_trips(known.withColumn("_member", F.col("_metadata.file_name")))


def parse_trips(raw: DataFrame) -> DataFrame:
    require_columns(raw)
    places = {c: F.col(c).try_cast("double")
              for c in ("start_lat", "start_lng", "end_lat", "end_lng") if c in raw.columns}
    return raw.withColumns({
        **places, "started_at": parse_clock(F.col("started_at")), "ended_at": parse_clock(F.col("ended_at"))})
