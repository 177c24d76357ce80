"""Repeatable splits and folds.

Membership follows the md5 order of (seed, row id) inside each class. The order is cut by
the first hash digits, so numbering a class of any size spreads over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from daymark.functions.draws import digest
from daymark.operators.audit import duplicate_rows
from daymark.operators.ordered import numbered

PREFIX_DIGITS = 3


def _hash_bucket(column: str) -> Column:
    return F.conv(F.substring(column, 1, PREFIX_DIGITS), 16, 10).cast("int")


def hash_numbered(df: DataFrame, row_id: str, keys: Sequence[str], seed: str, mix: Sequence[str] = ()) -> DataFrame:
    """Add ``position`` (from 1) and ``position_of`` per key, in hash order."""
    hashed = df.withColumn("_h", digest(seed, *[F.col(m) for m in mix], F.col(row_id)))
    return numbered(hashed, ["_h", row_id], _hash_bucket("_h"), keys).drop("_h")


def require_distinct_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Action: a plain split is refused when predictors repeat; use grouped folds then."""
    extra = duplicate_rows(df, columns).first()["extra_rows"]
    if extra:
        raise ValueError(f"{extra} rows repeat the predictors of another; use group_stratified_folds")
    return df


def stratified_split(df: DataFrame, row_id: str, label: str, seed: str = "42") -> DataFrame:
    """60 % train, 20 % validation, 20 % test within each class, in ``split``."""
    at = (F.col("position") - 1) * 10
    return hash_numbered(df, row_id, [label], seed).withColumn(
        "split", F.when(at < 6 * F.col("position_of"), "train").when(at < 8 * F.col("position_of"), "validation")
        .otherwise("test")).drop("position", "position_of")


def stratified_folds(df: DataFrame, row_id: str, label: str, k: int = 5, repeats: int = 1, seed: str = "42") -> DataFrame:
    """Every row once per repeat, with its held-out ``fold`` (0..k-1)."""
    repeated = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    return hash_numbered(repeated, row_id, ["repeat", label], seed, ["repeat"]).withColumn(
        "fold", ((F.col("position") - 1) % k).cast("int")).drop("position", "position_of")


def group_stratified_folds(df: DataFrame, columns: Sequence[str], row_id: str, label: str, k: int = 3,
                           seed: str = "42") -> DataFrame:
    """Rows with equal predictors (null pattern included) share a fold; add ``group_id`` and ``fold``.

    Groups are dealt to folds in hash order within their majority label.
    """
    groups = df.groupBy(*columns).agg(
        F.min(row_id).alias("group_id"),
        (F.count_if(F.col(label) == 1) * 2 >= F.count(F.lit(1))).cast("int").alias("_major"))
    dealt = hash_numbered(groups, "group_id", ["_major"], seed).withColumn(
        "fold", ((F.col("position") - 1) % k).cast("int"))
    named = dealt.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(columns)], "group_id", "fold")
    same = F.lit(True)
    for i, c in enumerate(columns):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return df.join(named, same).select(*df.columns, "group_id", "fold")


def expanding_folds(daily: DataFrame, splits: int = 3, test_size: int = 21, gap: int = 0,
                    series: Sequence[str] = ("series",), day: str = "date") -> DataFrame:
    """Each row once per fold with ``role`` train or check; training ends before the check span."""
    newest_first = W.partitionBy(*series).orderBy(F.col(day).desc())
    from_end = daily.withColumn("_back", F.row_number().over(newest_first) - 1)
    folds = from_end.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    end = (F.lit(splits - 1) - F.col("fold")) * test_size
    role = F.when((F.col("_back") >= end) & (F.col("_back") < end + test_size), "check").when(
        F.col("_back") >= end + test_size + gap, "train")
    return folds.withColumn("role", role).where(F.col("role").isNotNull()).drop("_back")


def fold_bounds(folds: DataFrame, day: str = "date", series: Sequence[str] = ()) -> DataFrame:
    """First and last date and row count of each fold's two roles."""
    return folds.groupBy(*series, "fold", "role").agg(
        F.min(day).alias("first_date"), F.max(day).alias("last_date"), F.count(F.lit(1)).alias("rows"))


def membership_fingerprint(df: DataFrame, row_id: str, keys: Sequence[str], step_bits: int = 16) -> DataFrame:
    """SHA-256 over the ordered members of each key, as a tree of digests.

    Ids are unique, so a leaf of 2**16 consecutive ids holds at most that many; leaf digests
    are folded the same way until one is left, which keeps every list bounded.
    """
    number = F.col(row_id).cast("long")
    nodes = df.select(*keys, F.shiftright(number, step_bits).alias("_node"), number.alias("_at"),
                      number.cast("string").alias("_text"))
    for level in range(4):
        folded = nodes.groupBy(*keys, "_node").agg(F.sha2(F.concat_ws(",", F.transform(
            F.array_sort(F.collect_list(F.struct("_at", "_text"))), lambda x: x["_text"])), 256).alias("_text"))
        if level < 3:
            nodes = folded.select(*keys, F.shiftright("_node", step_bits).alias("_up"),
                                  F.col("_node").alias("_at"), "_text").withColumnRenamed("_up", "_node")
    return folded.select(*keys, F.col("_text").alias("fingerprint"))
