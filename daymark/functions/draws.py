"""Repeatable pseudo-random numbers from md5, the same in Spark and in plain SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 4294967296  # 2 ** 32


def digest(seed: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws("-", F.lit(seed), *[p.cast("string") for p in parts]))


def word(seed: str, *parts: Column) -> Column:
    """Integer in [0, 2**32)."""
    return F.conv(F.substring(digest(seed, *parts), 1, 8), 16, 10).cast("long")


def uniform(seed: str, *parts: Column) -> Column:
    return word(seed, *parts) / F.lit(float(WIDTH))
