"""Fold-fitted preparation of incomplete rows.

``fit_*`` reads training rows only and returns a small table (or model); ``apply_*`` uses it on
any rows, so nothing of a held-out row reaches its own inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark import stages
from daymark.operators.ordered import numbered, quantiles, value_ranks, with_written_range
from daymark.operators.profile import long_values
from daymark.stages import StoredStage, param

POOLED = "__POOLED__"


def _named_row(table: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> Column:
    """One scalar struct {column: {field: value}} from a (column, fields...) table."""
    return table.agg(F.struct(*[
        F.struct(*[F.max(F.when(F.col("column") == c, F.col(f))).alias(f) for f in fields]).alias(c)
        for c in columns])).scalar()


def fit_medians(training: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per column of the training rows."""
    return quantiles(long_values(training, columns), "value", {"median": 0.5}, ["column"])


def apply_medians(df: DataFrame, medians: DataFrame, columns: Sequence[str]) -> DataFrame:
    fitted = df.withColumn("_fit", _named_row(medians, columns, ["median"]))
    return fitted.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.col(f"_fit.{c}.median")) for c in columns}).drop("_fit")


def moments(long: DataFrame) -> DataFrame:
    """Mean and population deviation per column of :func:`long_values`; all that the standard scale needs."""
    return long.groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def fit_scale(training: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, population deviation, median and quartiles per column."""
    long = long_values(training, columns)
    return moments(long).join(quantiles(long, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["column"]), "column")


def apply_scale(df: DataFrame, scale: DataFrame, columns: Sequence[str], how: str = "standard") -> DataFrame:
    """``standard``: (x - mean) / population deviation. ``robust``: (x - median) / IQR. A zero spread counts as 1."""
    fields = {"standard": ["mean", "std"], "robust": ["q1", "median", "q3"]}[how]
    fitted = df.withColumn("_fit", _named_row(scale, columns, fields))
    out = {}
    for c in columns:
        if how == "standard":
            centre, spread = F.col(f"_fit.{c}.mean"), F.col(f"_fit.{c}.std")
        else:
            centre, spread = F.col(f"_fit.{c}.median"), F.col(f"_fit.{c}.q3") - F.col(f"_fit.{c}.q1")
        out[c] = (F.col(c).cast("double") - centre) / F.when(spread == 0, 1.0).otherwise(spread)
    return fitted.withColumns(out).drop("_fit")


def fit_landmarks(training: DataFrame, column: str, landmarks: int = 200) -> list[float]:
    """Action: the ``landmarks`` evenly spaced exact quantiles of one column (a bounded list)."""
    ranks = value_ranks(training.select(F.col(column).cast("double").alias("v")), "v")
    last = F.lit(landmarks - 1)
    spread = F.greatest(F.lit(1), F.col("n_all") - 1)
    first = F.col("n_upto") - F.col("n")
    low = F.greatest(F.lit(0), F.floor(first * last / spread).cast("int") - 1)
    high = F.least(last, F.ceil(F.col("n_upto") * last / spread).cast("int") + 1)
    near = ranks.select("v", "n_all", first.alias("first"), "n_upto", F.explode(F.sequence(low, high)).alias("k"))
    position = F.col("k") * (F.col("n_all") - 1) / last
    held = lambda at: (F.col("first") <= at) & (at < F.col("n_upto"))
    table = near.groupBy("k").agg(
        F.max(F.when(held(F.floor(position)), F.col("v"))).alias("lo"),
        F.max(F.when(held(F.ceil(position)), F.col("v"))).alias("hi"),
        F.max(position - F.floor(position)).alias("part"))
    rows = table.orderBy("k").collect()
    return [r["lo"] + (r["hi"] - r["lo"]) * r["part"] for r in rows]


def apply_quantile_normal(df: DataFrame, column: str, landmarks: Sequence[float]) -> DataFrame:
    """Map a column to a normal shape by its position between the fitted landmarks."""
    from daymark.functions.special import normal_point

    points = np.asarray(landmarks, dtype=float)
    share = np.linspace(0.0, 1.0, len(points))

    @F.pandas_udf(T.DoubleType())
    def position(values: pd.Series) -> pd.Series:
        x = values.to_numpy(dtype=float)
        up = np.interp(x, points, share)
        down = 1.0 - np.interp(-x, -points[::-1], share)
        return pd.Series(np.where(np.isnan(x), np.nan, (up + down) / 2)).astype("float64")

    held = F.when(F.col(column).isNotNull(), position(F.col(column).cast("double")))
    return df.withColumn(column, F.when(F.col(column).isNotNull(), normal_point(held)))


def fit_levels(training: DataFrame, columns: Sequence[str], min_frequency: int = 1) -> DataFrame:
    """Action: kept levels per column with their rows and 0-based index in level order.

    A column may have any number of levels, so they are numbered range by range."""
    long = training.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns
    ]))).where(F.col("level").isNotNull())
    counts = long.groupBy("column", "level").agg(F.count(F.lit(1)).alias("rows"))
    seen = counts.withColumn("kept", F.col("rows") >= min_frequency)
    seen = with_written_range(seen, ["column", "level"], "_part")
    kept = numbered(seen.where("kept"), ["level"], F.col("_part"), ["column"])
    pooled = seen.where(~F.col("kept"))
    return kept.select("column", "level", "rows", (F.col("position") - 1).alias("index")).unionByName(
        pooled.select("column", "level", "rows", F.lit(-2).cast("long").alias("index")))


def apply_levels(df: DataFrame, levels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<c>_level``: the level, the pooled token for a rare one, null for an unseen one;
    and ``<c>_index``: its ordinal, -2 for pooled, -1 for unseen."""
    for c in columns:
        table = levels.where(F.col("column") == c).select(
            F.col("level").alias("_l"), F.col("index").alias(f"{c}_index"))
        df = df.join(table, F.col(c) == F.col("_l"), "left").withColumns({
            f"{c}_level": F.when(F.col(f"{c}_index") >= 0, F.col("_l")).when(F.col(f"{c}_index") == -2, POOLED),
            f"{c}_index": F.coalesce(F.col(f"{c}_index"), F.lit(-1).cast("long")),
        }).drop("_l")
    return df


def one_hot(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """0/1 columns for the given levels of ``<column>_level``; unseen gives all zeros."""
    return df.withColumns({
        f"{column}={v}": F.coalesce((F.col(f"{column}_level") == v).cast("int"), F.lit(0)) for v in levels})


class ChainedImputer(Estimator, StoredStage):
    """Chained ridge regressions: each incomplete column is predicted from the others, round after round.

    A filled value is always an affine function of what its row holds, and the same one for every
    row with the same null pattern. So sums and products per null pattern, one aggregate over the
    training rows, are all that ``fit`` reads: every round is then small matrix work.
    """

    MOST_COLUMNS = 16  # at most 2**16 null patterns reach the driver

    columns = param("columns", "columns to fill, each from the others", stages.names)
    rounds = param("rounds", "sweeps over the columns", stages.whole)
    ridge = param("ridge", "penalty of each regression", stages.number)

    def __init__(self, columns: Sequence[str] = (), rounds: int = 10, ridge: float = 1e-3):
        super().__init__()
        if len(columns) > self.MOST_COLUMNS:
            raise ValueError(f"at most {self.MOST_COLUMNS} columns can be chained")
        self._set(columns=list(columns), rounds=rounds, ridge=float(ridge))

    def _fit(self, training: DataFrame) -> "ChainedImputerModel":
        names = self.value("columns")
        width = len(names)
        means = training.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names]).first()
        starts = np.array([float(means[c] or 0.0) for c in names])

        pattern = F.lit(0)
        for i, c in enumerate(names):
            pattern = pattern + F.when(F.col(c).isNull(), 1 << i).otherwise(0)
        held = [F.coalesce(F.col(c).cast("double") - F.lit(float(start)), F.lit(0.0)) for c, start in zip(names, starts)]
        pairs = [(i, j) for i in range(width) for j in range(i, width)]
        rows = training.groupBy(pattern.alias("pattern")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(held[i]).alias(f"s{i}") for i in range(width)],
            *[F.sum(held[i] * held[j]).alias(f"p{i}_{j}") for i, j in pairs]).orderBy("pattern").collect()

        moments, maps, gaps = [], [], []
        for row in rows:
            m = np.zeros((width + 1, width + 1))
            m[0, 0] = row["n"]
            for i in range(width):
                m[0, i + 1] = m[i + 1, 0] = row[f"s{i}"]
            for i, j in pairs:
                m[i + 1, j + 1] = m[j + 1, i + 1] = row[f"p{i}_{j}"]
            gone = [bool(row["pattern"] >> i & 1) for i in range(width)]
            # What each column holds, as a function of (1, held values); a gap starts at its mean.
            now = np.eye(width + 1)
            now[[i + 1 for i in range(width) if gone[i]]] = 0.0
            moments.append(m)
            maps.append(now)
            gaps.append(gone)
        missing = [sum(r["n"] for r, g in zip(rows, gaps) if g[i]) for i in range(width)]
        order = sorted([i for i in range(width) if missing[i]], key=lambda i: (missing[i], i))

        steps = []
        for _ in range(self.value("rounds")):
            for target in order:
                others = [i for i in range(width) if i != target]
                total = np.zeros((width + 1, width + 1))
                for m, now, gone in zip(moments, maps, gaps):
                    if not gone[target]:
                        total += now @ m @ now.T
                weights, constant = self._ridge(total, others, target)
                for now, gone in zip(maps, gaps):
                    if gone[target]:
                        now[target + 1] = weights @ now[[i + 1 for i in others]]
                        now[target + 1, 0] += constant
                shift = starts[target] + constant - float(weights @ starts[others])
                steps.append([names[target], float(shift), [float(w) for w in weights]])
        return ChainedImputerModel(names, starts.tolist(), steps)

    def _ridge(self, total: np.ndarray, inputs: Sequence[int], target: int) -> tuple[np.ndarray, float]:
        n = total[0, 0]
        if n == 0:
            return np.zeros(len(inputs)), 0.0
        mean = total[0, 1:] / n
        cross = total[1:, 1:] / n - np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(cross)[inputs], 0.0))
        spread[spread == 0] = 1.0
        scaled = cross[np.ix_(inputs, inputs)] / np.outer(spread, spread) + self.value("ridge") * np.eye(len(inputs))
        weights = np.linalg.solve(scaled, cross[inputs, target] / spread) / spread
        return weights, float(mean[target] - weights @ mean[inputs])


class ChainedImputerModel(Model, StoredStage):
    """The fitted chain: the columns' starting values and one regression a step."""

    columns = param("columns", "columns to fill", stages.names)
    starts = param("starts", "value of each column before the first step")
    steps = param("steps", "column, intercept and the weights of the other columns, step by step")

    def __init__(self, columns: Sequence[str] = (), starts: Sequence[float] = (), steps: Sequence[Sequence] = ()):
        super().__init__()
        self._set(columns=list(columns), starts=list(starts), steps=list(steps))

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self.value("columns")
        state = df.withColumns({f"{c}__gone": F.col(c).isNull() for c in columns}).withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.lit(start)) for c, start in zip(columns, self.value("starts"))})
        for target, intercept, weights in self.value("steps"):
            value = F.lit(intercept)
            for other, w in zip([c for c in columns if c != target], weights):
                value = value + F.lit(w) * F.col(other)
            state = state.withColumn(target, F.when(F.col(f"{target}__gone"), value).otherwise(F.col(target)))
        return state.drop(*[f"{c}__gone" for c in columns])
