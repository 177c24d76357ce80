"""All logistic fits of a preparation board from shared passes over the rows.

The objective is that of ``LogisticRegression`` behind a ``StandardScaler``: mean log loss + alpha |w|^2 / 2 over
standardised features, the intercept free. Newton steps: one pass adds up loss, gradient and curvature of all fits that
still move, every task over its own rows, and the driver solves one small system per fit. So the number of jobs follows
the steps, not the fits, and each fit ends at the optimum.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators import scoring, validate
from daymark.plans.linear import added_up
from daymark.session import materialize

#: Columns, one per number, flag and level, up to which a fit's square of products is small.
COLUMNS = 64
SETTINGS = {"rounds": 50, "alpha": 0.01}
FIT = ["version", "repeat", "held"]


class Board:
    """Columns of all versions and, per repeat and held-out fold, what the training rows fix: medians, means, deviations."""

    def __init__(self, numeric: Sequence[str], levels: list[list[str]], medians: dict, folds: int):
        self.numbers, self.levels, self.medians, self.folds = len(numeric), levels, medians, folds
        self.width = 2 * len(numeric) + sum(map(len, levels))
        self.centre, self.factor = {}, {}

    def plain(self, batch: pd.DataFrame) -> np.ndarray:
        """Numbers (NaN where missing), their flags, then 0 or 1 per level."""
        n = range(self.numbers)
        hot = [(batch[f"known{i}"] == level).to_numpy() for i, known in enumerate(self.levels) for level in known]
        return np.column_stack([*[batch[f"raw{i}"] for i in n], *[batch[f"gone{i}"] for i in n], *hot]).astype(float)

    def filled(self, plain: np.ndarray, key: tuple[int, int]) -> np.ndarray:
        x = plain.copy()
        x[:, :self.numbers] = np.where(np.isnan(x[:, :self.numbers]), self.medians[key], x[:, :self.numbers])
        return x

    def scaled(self, plain: np.ndarray, key: tuple[int, int]) -> np.ndarray:
        return (self.filled(plain, key) - self.centre[key]) * self.factor[key]

    def training(self, batch: pd.DataFrame) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray]]:
        """Per repeat and held-out fold of a batch: key, columns and labels of the training rows."""
        for repeat, part in batch.groupby("repeat"):
            plain, fold, y = self.plain(part), part["fold"].to_numpy(), part["label"].to_numpy(float)
            for held in range(self.folds):
                yield (int(repeat), held), plain[fold != held], y[fold != held]


def logistic_counts(folds: DataFrame, versions: dict[str, tuple[Sequence[str], Sequence[str], bool]], k: int,
                    settings: dict | None = None) -> tuple[DataFrame | None, set[str]]:
    """Action: per version, repeat and fold the held-out rows and positives of each score, and the versions answered.

    All are left to the caller where labels are not 0 and 1, ``settings`` names more than rounds and alpha, or the
    columns are more than ``COLUMNS``; so are versions without numbers.
    """
    versions = {name: version for name, version in versions.items() if version[0]}
    if not versions or set(settings or {}) - set(SETTINGS) or folds.where("label is null or label not in (0, 1)").limit(1).count():
        return None, set()
    chosen = SETTINGS | (settings or {})
    numeric = sorted({c for n, _, _ in versions.values() for c in n})
    categorical = sorted({c for _, n, _ in versions.values() for c in n})
    number = [F.col(f"`{c}`").cast("double") for c in numeric]
    spark = folds.sparkSession
    rows = materialize(folds.select(
        "repeat", "fold", "label", *[F.when(~F.isnan(n), n).alias(f"raw{i}") for i, n in enumerate(number)],
        *[F.col(f"`{c}`").isNull().cast("int").alias(f"gone{i}") for i, c in enumerate(numeric)],
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(validate.MISSING_LEVEL)).alias(f"known{i}") for i, c in enumerate(categorical)],
    ).repartition(spark.sparkContext.defaultParallelism), "rows")
    levels = []
    for i in range(len(categorical)):
        levels.append(sorted(r[0] for r in rows.select(f"known{i}").distinct().limit(COLUMNS + 1).collect()))
    held = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("held")
    middle = [F.percentile_approx(f"raw{i}", 0.5, 1000) for i in range(len(numeric))]
    medians = {(r[0], r[1]): r[2:] for r in rows.select("*", held).where("fold <> held").groupBy("repeat", "held").agg(*middle).collect()}
    if any(m is None for row in medians.values() for m in row):
        raise ValueError("a number column has no value in the training rows of a fold")
    board = Board(numeric, levels, {key: np.array(row, float) for key, row in medians.items()}, k)
    if board.width > COLUMNS:
        return None, set()
    picks = {name: _picked(board, numeric, categorical, *version) for name, version in versions.items()}
    weights = _fitted(rows, board, picks, **chosen)

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (repeat, fold), part in batch.groupby(["repeat", "fold"]):
                z = board.scaled(board.plain(part), (int(repeat), int(fold)))
                for name in picks:
                    w = weights[name, int(repeat), int(fold)]
                    # Column after column, so that equal rows get equal scores in any batch.
                    margin = np.full(len(part), w[0])
                    for j in picks[name]:
                        margin += z[:, j] * w[1 + j]
                    yield pd.DataFrame({"version": name, "repeat": repeat, "fold": fold, "label": part["label"], "score": _logistic(margin)})

    scored = rows.mapInPandas(scores, "version string, repeat int, fold int, label int, score double")
    return materialize(scoring.score_counts(scored, keys=["version", "repeat", "fold"]), "logits"), set(versions)


def _picked(board: Board, numeric: list[str], categorical: list[str], numbers: Sequence[str], kinds: Sequence[str], flags: bool) -> np.ndarray:
    at = [numeric.index(c) for c in numbers]
    starts = np.cumsum([2 * board.numbers, *map(len, board.levels)])
    hot = [j for c in kinds for j in range(starts[categorical.index(c)], starts[categorical.index(c) + 1])]
    return np.array(at + [board.numbers + i for i in at if flags] + hot, int)


def _logistic(margin: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-margin))


def _fitted(rows: DataFrame, board: Board, picks: dict[str, np.ndarray], rounds: int, alpha: float) -> dict[tuple, np.ndarray]:
    """Intercept and scaled slopes (zero where a version leaves the column out) per version, repeat and held-out fold."""
    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, plain, y in board.training(batch):
                x = board.filled(plain, key)
                totals[key] = totals.get(key, 0.0) + np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)])
        yield pd.DataFrame([(*key, m) for key, m in totals.items()], columns=["repeat", "held", "cells"])

    width = board.width
    sums = added_up(rows.mapInPandas(moments, "repeat int, held int, cells array<double>"), ["repeat", "held"], 2 + 2 * width)
    size, at, settled = {}, {}, {}
    for key, (n, ones, *m) in sums.items():
        mean = np.array(m[:width]) / n
        spread = np.sqrt(np.maximum(np.array(m[width:]) / n - mean ** 2, 0.0) * n / max(n - 1, 1))
        constant = spread <= 1e-9 * np.maximum(1.0, np.abs(mean))
        board.centre[key], board.factor[key], size[key] = mean, np.where(constant, 0.0, 1.0 / np.where(constant, 1.0, spread)), n
        for name in picks:
            start = np.zeros(1 + width)
            with np.errstate(divide="ignore"):
                start[0] = np.log(ones) - np.log(n - ones)
            (at if 0 < ones < n else settled)[name, *key] = start
    best: dict[tuple, tuple[float, np.ndarray]] = {}
    for _ in range(rounds):
        if not at:
            break
        for fit, cells in _pass(rows, board, picks, dict(at)).items():
            pick, w, n = np.append(0, 1 + picks[fit[0]]), at[fit], size[fit[1:]]
            ridge = np.append(0.0, np.full(len(pick) - 1, float(alpha)))
            loss = cells[0] / n + ridge @ w[pick] ** 2 / 2
            slope = cells[1:2 + width][pick] / n + ridge * w[pick]
            square = cells[2 + width:].reshape(1 + width, -1)[np.ix_(pick, pick)] / n + np.diag(ridge)
            if fit in best and loss > best[fit][0] + 1e-12:  # too long a step
                at[fit] = (w + best[fit][1]) / 2
                continue
            step = np.linalg.lstsq(square, slope, rcond=None)[0]
            best[fit], after = (loss, w), w.copy()
            after[pick] -= step
            at[fit] = after
            if slope @ step < 1e-13:
                settled[fit] = at.pop(fit)
    return settled | {fit: best[fit][1] if fit in best else w for fit, w in at.items()}


def _pass(rows: DataFrame, board: Board, picks: dict[str, np.ndarray], weights: dict[tuple, np.ndarray]) -> dict[tuple, np.ndarray]:
    """Action: loss, gradient and curvature of every fit at its weights, summed over its training rows."""
    side = 1 + board.width

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, plain, y in board.training(batch):
                z = np.column_stack([np.ones(len(y)), board.scaled(plain, key)])
                for name, chosen in picks.items():
                    if (fit := (name, *key)) in weights:
                        pick = np.append(0, 1 + chosen)
                        x, w = z[:, pick], weights[fit][pick]
                        margin = x @ w
                        p = _logistic(margin)
                        out, square = np.zeros(1 + side), np.zeros((side, side))
                        out[0], out[1 + pick] = (np.logaddexp(0.0, margin) - y * margin).sum(), x.T @ (p - y)
                        square[np.ix_(pick, pick)] = (x * (p * (1 - p))[:, None]).T @ x
                        totals[fit] = totals.get(fit, 0.0) + np.concatenate([out, square.ravel()])
        yield pd.DataFrame([(*fit, m) for fit, m in totals.items()], columns=[*FIT, "cells"])

    cells = rows.mapInPandas(products, "version string, repeat int, held int, cells array<double>")
    return added_up(cells, FIT, 1 + side + side * side)
