"""Unions, equality of tables and disjointness of partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators.validate import require_daily


def union_history(prior: DataFrame, current: DataFrame, strict: bool = False, day: str = "date",
                  value: str = "trips") -> DataFrame:
    """Earlier and current history in one series; ``strict`` refuses gaps and overlaps."""
    joined = prior.unionByName(current)
    return require_daily(joined, day=day, value=value) if strict else joined


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``surplus`` > 0 when the left has more.

    One aggregate over a signed union: one shuffle with map-side combining, where two
    ``exceptAll`` would take four.
    """
    if set(left.columns) != set(right.columns):
        raise ValueError("the tables have different columns")
    signed = left.withColumn("_s", F.lit(1)).unionByName(right.withColumn("_s", F.lit(-1)))
    return (signed.groupBy(*left.columns).agg(F.sum("_s").alias("surplus"))
            .where(F.col("surplus") != 0))


def overlap_differences(extended: DataFrame, ordinary: DataFrame, on: Sequence[str] = ("date",)) -> DataFrame:
    """Rows of the overlap that an extended history changed; none are expected."""
    return differences(extended.join(ordinary.select(*on), list(on), "left_semi"), ordinary)


def frames_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``equal`` and the number of differing rows."""
    return differences(left, right).agg(F.count(F.lit(1)).alias("differing_rows")).withColumn(
        "equal", F.col("differing_rows") == 0)


def partition_disjoint(df: DataFrame, row_id: str, other: DataFrame) -> DataFrame:
    """One row: rows, repeated ids, ids shared with ``other``, and whether all is disjoint."""
    seen = df.select(row_id, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        other.select(row_id, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    per_id = seen.groupBy(row_id).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    return per_id.agg(
        F.sum("_a").alias("rows"),
        F.count_if(F.col("_a") > 1).alias("repeated_ids"),
        F.count_if((F.col("_a") > 0) & (F.col("_b") > 0)).alias("shared_ids"),
    ).withColumn("disjoint", (F.col("repeated_ids") == 0) & (F.col("shared_ids") == 0))


def manifest_rows(manifest: DataFrame, column: str = "partitions") -> DataFrame:
    """``map<string, array<long>>`` to one (partition, row_id) row per member."""
    return manifest.select(F.explode(column).alias("partition", "_ids")).select(
        "partition", F.explode("_ids").alias("row_id"))


def load_partition(df: DataFrame, members: DataFrame, name: str, row_id: str = "row_id",
                   allow_confirmation: bool = False) -> DataFrame:
    """Rows whose id is in the named partition. The confirmation rows need explicit permission."""
    if name == "confirmation" and not allow_confirmation:
        raise PermissionError("the confirmation partition is reserved; pass allow_confirmation=True")
    wanted = members.where(F.col("partition") == name).select(F.col("row_id").alias("_id"))
    return df.join(wanted, F.col(row_id) == F.col("_id"), "left_semi")


def require_partition_size(df: DataFrame, members: DataFrame, name: str) -> DataFrame:
    """Action: raise unless the partition holds as many rows as its manifest lists."""
    expected = members.where(F.col("partition") == name).count()
    found = df.count()
    if expected == 0 or found != expected:
        raise ValueError(f"partition {name!r} has {found} rows, its manifest lists {expected}")
    return df


def verify_manifest(expected: DataFrame, actual: DataFrame, overrides: DataFrame | None = None,
                    name: str = "name", digest: str = "digest") -> DataFrame:
    """Per name: ok, changed, missing or unexpected. A declared override replaces the expected digest."""
    e = expected.select(name, F.col(digest).alias("_e"))
    if overrides is not None:
        o = overrides.select(name, F.col(digest).alias("_o"))
        e = e.join(o, name, "left").select(name, F.coalesce("_o", "_e").alias("_e"))
    a = actual.select(name, F.col(digest).alias("_a"))
    return e.join(a, name, "full").select(
        name, F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unexpected")
        .when(F.col("_e") == F.col("_a"), "ok").otherwise("changed").alias("status"))


def distinct_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def random_example(df: DataFrame, row_id: str, seed: str, exclude: Sequence = ()) -> DataFrame:
    """One repeatable pseudo-random row other than the excluded ids (a top-1, not a sort)."""
    pool = df if not exclude else df.where(~F.col(row_id).isin(list(exclude)))
    order = F.md5(F.concat_ws("-", F.lit(seed), F.col(row_id).cast("string")))
    return pool.orderBy(order, row_id).limit(1)
