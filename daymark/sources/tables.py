"""Daily CSV tables, JSON reports and file fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

from daymark.sources.files import open_path, resolve

BLOCK_BYTES = 8 * 1024 * 1024
REFUSED = "report holds values that are not finite"


def write_daily(daily: DataFrame, path: str) -> None:
    """Date-keyed CSV: ISO dates, doubles with six places."""
    out = []
    for name, kind in daily.dtypes:
        c = F.col(f"`{name}`")
        if kind == "double":
            c = F.when(c.isNotNull(), F.format_string("%.6f", c))
        out.append(c.alias(name))
    daily.select(*out).write.csv(path, header=True, dateFormat="yyyy-MM-dd", mode="errorifexists")


def read_daily(spark: SparkSession, path: str, schema: str = "date date, trips bigint") -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, dateFormat="yyyy-MM-dd", enforceSchema=False, mode="FAILFAST")


def nonfinite_counts(df: DataFrame) -> DataFrame:
    """One row: values per double column that JSON cannot carry."""
    doubles = [n for n, k in df.dtypes if k in ("double", "float")]
    if not doubles:
        return df.agg(F.lit(0).cast("long").alias("_none"))
    return df.agg(*[F.count_if(F.isnan(c) | (F.abs(F.col(c)) == float("inf"))).alias(c) for c in doubles])


def _finite(value: Column, kind: DataType) -> Column | None:
    """Whether no number inside ``value`` is NaN or infinite; None where the type holds no such numbers."""
    if isinstance(kind, (DoubleType, FloatType)):
        return ~(F.isnan(value) | (F.abs(value) == float("inf")))
    if isinstance(kind, ArrayType):
        inner = _finite(F.lit(0.0), kind.elementType)
        return None if inner is None else F.forall(value, lambda v: F.coalesce(_finite(v, kind.elementType), F.lit(True)))
    if isinstance(kind, MapType):
        return _finite(F.map_values(value), ArrayType(kind.valueType))
    if isinstance(kind, StructType):
        parts = [p for f in kind.fields if (p := _finite(value.getField(f.name), f.dataType)) is not None]
        return reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(True)) for p in parts]) if parts else None
    return None


def write_report(df: DataFrame, path: str) -> None:
    """Action: JSON lines. NaN and infinity, nested ones too, are refused by the tasks that write, so the input
    is computed once and a refused report leaves nothing behind.

    Raises ValueError naming the column; Spark's committer drops what other tasks had written.
    """
    checked = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        ok = _finite(value, field.dataType)
        checked.append(value if ok is None else F.when(F.coalesce(ok, F.lit(True)), value).otherwise(
            F.raise_error(F.lit(f"{REFUSED}: column {field.name}"))).alias(field.name))
    try:
        df.select(*checked).write.mode("errorifexists").json(path, ignoreNullFields=False)
    except PySparkException as error:
        if REFUSED not in str(error):
            raise
        filesystem, inner = resolve(path)  # made by this write; the committer leaves it empty
        if not any(f.is_file for f in filesystem.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))):
            filesystem.delete_dir(inner)
        raise ValueError(f"{REFUSED}: {str(error).split(REFUSED + ': ', 1)[1].splitlines()[0]}") from None


def fingerprint(spark: SparkSession, path: str, text: bool = False) -> DataFrame:
    """SHA-256 and length per file. ``text`` reads CRLF as LF, so a checkout's line ends do not matter.

    A file is hashed by one task in blocks, whatever its size; files spread over tasks. Only the
    listing comes from the scan, not the contents.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").repartition("path")

    def hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = []
            for name in batch["path"]:
                digest = hashlib.sha256()
                held = b""
                with open_path(name) as stream:
                    while block := stream.read(BLOCK_BYTES):
                        if text:
                            block = held + block
                            held = b"\r" if block.endswith(b"\r") else b""
                            block = block[:len(block) - len(held)].replace(b"\r\n", b"\n")
                        digest.update(block)
                digest.update(held)
                digests.append(digest.hexdigest())
            yield pd.DataFrame({"name": [n.rsplit("/", 1)[-1] for n in batch["path"]], "length": batch["length"], "digest": digests})

    return files.mapInPandas(hash_files, "name string, length bigint, digest string")
