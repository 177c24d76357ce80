"""Whole grids of linear forecasters from shared passes over the rows.

Ridge and elastic-net settings need weighted sums of products only: every task adds up those of its own
rows per (fold, half-life), so no group of rows is formed, and the driver solves one small system per setting.
Huber settings are fitted by reweighted least squares: one pass a round adds up the sums of all settings
that still move.

Objectives over standardised features, the intercept free, w the slopes, v the weights of rows:

* ridge: sum v r^2 + alpha |w|^2
* elastic: sum v r^2 / (2 sum v) + alpha l1_ratio |w|_1 + alpha (1 - l1_ratio) |w|^2 / 2
* huber: sum v (sigma + sigma H(r / sigma)) + alpha |w|^2, with H(z) = z^2 up to epsilon and 2 epsilon |z| - epsilon^2 beyond
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from daymark.functions.numeric import LOG_RANGE, fitted_sql
from daymark.operators import history
from daymark.session import materialize

#: Families whose models are solved here and scored as one SQL expression.
SOLVED = ("elastic", "huber")
SWEEPS, ROUNDS = 50_000, 200
DEFAULTS = {"ridge": {"alpha": 1.0}, "elastic": {"alpha": 1.0, "l1_ratio": 0.5}, "huber": {"alpha": 0.0001, "epsilon": 1.35}}


def setting_text(candidate) -> str:
    return json.dumps(candidate.describe(), sort_keys=True)


def setting_of(candidate, name: str) -> float:
    return float(candidate.value("settings").get(name, DEFAULTS[candidate.value("family")][name]))


class Design:
    """The columns that the candidates read between them, and where each finds its own."""

    def __init__(self, candidates: Sequence):
        self.names = sorted({n for c in candidates for n in history.FEATURE_SETS[c.value("featureSet")]})
        self.targets = sorted({c.value("target") for c in candidates})
        self.half_lives = sorted({0.0} | {float(c.value("halfLife")) for c in candidates})  # 0: all rows weigh 1
        self.width = 1 + len(self.names) + len(self.targets)

    def picked(self, candidate) -> list[int]:
        return [1 + self.names.index(n) for n in history.FEATURE_SETS[candidate.value("featureSet")]]

    def target(self, candidate) -> int:
        return self.targets.index(candidate.value("target"))

    def rows(self, folds: DataFrame, day: str, value: str, series: Sequence[str]) -> DataFrame:
        """fold, role, count, age (rows back from the newest of its series), x and y."""
        newest_first = W.partitionBy(*series, "fold", "role").orderBy(F.col(day).desc())
        return folds.select(
            "fold", "role", F.col(value).cast("double").alias("count"), (F.row_number().over(newest_first) - 1).alias("age"),
            F.array(*[F.col(n).cast("double") for n in self.names]).alias("x"),
            F.array(*[F.expr(fitted_sql(value, t)) for t in self.targets]).alias("y"))


def row_weights(part: pd.DataFrame, half_life: float) -> np.ndarray:
    """Halved every ``half_life`` rows back, as :func:`history.recency_weights` has it."""
    age = part["age"].to_numpy(float)
    return np.exp2(-age / half_life) if half_life else np.ones(len(age))


def added_up(cells: DataFrame, keys: Sequence[str], size: int) -> dict[tuple, np.ndarray]:
    """Action: arrays of ``cells`` summed per key; keys times ``size`` numbers reach the driver."""
    flat = cells.select(*keys, F.posexplode("cells").alias("at", "cell")).groupBy(*keys, "at").agg(F.sum("cell").alias("cell"))
    out: dict[tuple, np.ndarray] = defaultdict(lambda: np.zeros(size))
    for *key, at, cell in flat.collect():
        out[tuple(key)][at] = cell
    return dict(out)


def product_sums(train: DataFrame, design: Design) -> dict[tuple, np.ndarray]:
    """Action: per (fold, half-life) the weighted products of (1, x, y) with each other."""
    half_lives, width = design.half_lives, design.width

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[int, float], np.ndarray] = {}
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                z = np.column_stack([np.ones(len(part)), np.stack(part["x"]), np.stack(part["y"])])
                for half_life in half_lives:
                    key = (int(fold), half_life)
                    totals[key] = totals.get(key, 0.0) + (z * row_weights(part, half_life)[:, None]).T @ z
        yield pd.DataFrame([(f, h, m.ravel()) for (f, h), m in totals.items()], columns=["fold", "half_life", "cells"])

    cells = train.mapInPandas(products, "fold int, half_life double, cells array<double>")
    return {key: m.reshape(width, width) for key, m in added_up(cells, ["fold", "half_life"], width * width).items()}


class Scaled:
    """One setting's system on one fold: standardised products without the means."""

    def __init__(self, sums: dict, design: Design, fold: int, candidate):
        plain, held = sums[fold, 0.0], sums[fold, float(candidate.value("halfLife"))]
        self.pick = pick = design.picked(candidate)
        y = 1 + len(design.names) + design.target(candidate)
        self.centre = plain[0, pick] / plain[0, 0]
        spread = np.sqrt(np.maximum(plain[pick, pick] / plain[0, 0] - self.centre ** 2, 0.0))
        spread[spread < 1e-12] = 1.0
        self.spread, self.total = spread, held[0, 0]
        self.mean_x, self.mean_y = held[0, pick] / held[0, 0], held[0, y] / held[0, 0]
        self.square = (held[np.ix_(pick, pick)] - held[0, 0] * np.outer(self.mean_x, self.mean_x)) / np.outer(spread, spread)
        self.cross = (held[pick, y] - held[0, 0] * self.mean_x * self.mean_y) / spread
        self.left = max(held[y, y] - held[0, 0] * self.mean_y ** 2, 0.0)  # sum of squares about the mean

    def line(self, scaled_slopes: np.ndarray, width: int) -> np.ndarray:
        """Intercept and one coefficient per name, zero where the setting leaves it out."""
        slopes = scaled_slopes / self.spread
        out = np.zeros(width)
        out[0], out[self.pick] = self.mean_y - self.mean_x @ slopes, slopes
        return out


def ridge_slopes(s: Scaled, alpha: float) -> np.ndarray:
    return np.linalg.lstsq(s.square + alpha * np.eye(len(s.cross)), s.cross, rcond=None)[0]


def elastic_slopes(s: Scaled, alpha: float, l1_ratio: float) -> np.ndarray:
    """Coordinate descent until no coordinate's optimality condition is off by more than rounding."""
    lasso, ridge = alpha * l1_ratio * s.total, alpha * (1 - l1_ratio) * s.total
    w = np.zeros(len(s.cross))
    rest = s.cross.copy()  # cross - square @ w
    diagonal = np.diag(s.square).copy()
    close = 1e-10 * max(1.0, float(np.abs(s.cross).max(initial=0.0)))
    for sweep in range(SWEEPS):
        for j in range(len(w)):
            if diagonal[j] + ridge <= 0:
                continue
            aim = rest[j] + diagonal[j] * w[j]
            new = np.sign(aim) * max(abs(aim) - lasso, 0.0) / (diagonal[j] + ridge)
            if new != w[j]:
                rest -= s.square[:, j] * (new - w[j])
                w[j] = new
        slope = rest - ridge * w
        off = np.where(w != 0, np.abs(slope - lasso * np.sign(w)), np.maximum(np.abs(slope) - lasso, 0.0))
        if off.max(initial=0.0) <= close:
            break
        if sweep % 50 == 49:  # with the signs settled, the rest is one linear system
            on = np.flatnonzero(w)
            exact = np.linalg.lstsq(s.square[np.ix_(on, on)] + ridge * np.eye(len(on)), s.cross[on] - lasso * np.sign(w[on]), rcond=None)[0]
            if (np.sign(exact) == np.sign(w[on])).all():
                w[on] = exact
                rest = s.cross - s.square @ w
    return w


def huber_slopes(train: DataFrame, design: Design, systems: dict[tuple[int, int], Scaled], candidates: Sequence) -> dict[tuple[int, int], np.ndarray]:
    """Action: (fold, place of the candidate) to (intercept, slopes) over standardised features.

    Each round's weights are 1 where a residual is within epsilon sigma and epsilon sigma over it beyond; sigma^2
    is what the scale's own condition gives for the residuals within. All settings that still move share a pass.
    """
    state = {}
    for (fold, at), s in systems.items():
        w = ridge_slopes(s, setting_of(candidates[at], "alpha"))
        error = max(s.left - 2 * w @ s.cross + w @ s.square @ w, 0.0) / s.total
        shift = s.mean_y + ((s.centre - s.mean_x) / s.spread) @ w
        state[fold, at] = np.concatenate([[shift], w]), max(np.sqrt(error), 1e-9)
    moving = set(state)
    for _ in range(ROUNDS):
        if not moving:
            break
        now = {key: state[key] for key in moving}
        told = {at: (systems[fold, at].pick, float(candidates[at].value("halfLife")), design.target(candidates[at]), setting_of(candidates[at], "epsilon"))
                for fold, at in moving}
        scales = {key: (systems[key].centre, systems[key].spread) for key in moving}

        def reweighted(batches: Iterator[pd.DataFrame], now=now, told=told, scales=scales) -> Iterator[pd.DataFrame]:
            totals: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for fold, part in batch.groupby("fold"):
                    x, y = np.stack(part["x"]), np.stack(part["y"])
                    for key in [k for k in now if k[0] == fold]:
                        (pick, half_life, target, epsilon), (centre, spread) = told[key[1]], scales[key]
                        z = np.column_stack([np.ones(len(part)), (x[:, np.array(pick) - 1] - centre) / spread])
                        line, sigma = now[key]
                        v, r = row_weights(part, half_life), y[:, target] - z @ line
                        inside = np.abs(r) <= epsilon * sigma
                        weight = v * np.where(inside, 1.0, epsilon * sigma / np.maximum(np.abs(r), 1e-300))
                        told_apart = np.array([(v * inside * r * r).sum(), (v * ~inside).sum(), v.sum()])
                        cells = np.concatenate([((z * weight[:, None]).T @ z).ravel(), (z * weight[:, None]).T @ y[:, target], told_apart])
                        totals[key] = totals.get(key, 0.0) + cells
            yield pd.DataFrame([(f, a, c) for (f, a), c in totals.items()], columns=["fold", "at", "cells"]).astype({"fold": "int32", "at": "int32"})

        cells = train.mapInPandas(reweighted, "fold int, at int, cells array<double>").withColumnRenamed("at", "candidate")
        most = max(len(state[key][0]) for key in moving)
        for (fold, at), c in added_up(cells, ["fold", "candidate"], most * most + most + 3).items():
            line, sigma = state[fold, at]
            n, epsilon, alpha = len(line), setting_of(candidates[at], "epsilon"), setting_of(candidates[at], "alpha")
            square, cross, (within, beyond, total) = c[:n * n].reshape(n, n), c[n * n:n * n + n], c[n * n + n:n * n + n + 3]
            penalty = alpha * sigma * np.eye(n)
            penalty[0, 0] = 0.0
            new = np.linalg.lstsq(square + penalty, cross, rcond=None)[0]
            room = total - beyond * epsilon ** 2
            new_sigma = max(np.sqrt(within / room), 1e-9) if room > 0 and within > 0 else sigma / 2
            state[fold, at] = new, new_sigma
            still = max(np.abs(new - line).max() / max(1.0, np.abs(new).max()), abs(new_sigma - sigma) / max(1e-9, new_sigma))
            if still < 1e-9:
                moving.discard((fold, at))
    return {key: np.concatenate([line, [sigma]]) for key, (line, sigma) in state.items()}


def solved_lines(train: DataFrame, design: Design, candidates: Sequence) -> dict[int, np.ndarray]:
    """Action: per fold a column per candidate: intercept, then one coefficient per name of the design."""
    sums = product_sums(train, design)
    folds = sorted({f for f, _ in sums})
    systems = {(f, i): Scaled(sums, design, f, c) for f in folds for i, c in enumerate(candidates)}
    robust = {k: s for k, s in systems.items() if candidates[k[1]].value("family") == "huber"}
    bent = huber_slopes(train, design, robust, candidates) if robust else {}
    width, lines = 1 + len(design.names), {}
    for f in folds:
        columns = []
        for i, c in enumerate(candidates):
            s = systems[f, i]
            if c.value("family") == "huber":
                shift, slopes = bent[f, i][0], bent[f, i][1:-1] / s.spread
                line = np.zeros(width)
                line[0], line[s.pick] = shift - s.centre @ slopes, slopes
            elif c.value("family") == "elastic":
                line = s.line(elastic_slopes(s, setting_of(c, "alpha"), setting_of(c, "l1_ratio")), width)
            else:
                line = s.line(ridge_slopes(s, setting_of(c, "alpha")), width)
            columns.append(line)
        lines[f] = np.stack(columns, axis=1)
    return lines


def fit_line(dataset: DataFrame, candidate, series: Sequence[str], day: str, value: str) -> list[float]:
    """Action: intercept and slopes, in the order of the feature set, of one setting on all rows."""
    design = Design([candidate])
    rows = materialize(design.rows(dataset.withColumns({"fold": F.lit(0), "role": F.lit("train")}), day, value, series), "linear")
    if rows.isEmpty():
        raise ValueError("no rows to fit on")
    line = solved_lines(rows, design, [candidate])[0][:, 0]
    return [float(line[0]), *(float(line[i]) for i in design.picked(candidate))]


def grid_errors(folds: DataFrame, candidates: Sequence[tuple[int, object]], day: str, value: str, series: Sequence[str]) -> DataFrame:
    """Action: candidate, setting, fold, mae, train_mae and days of every setting on every fold."""
    held = [c for _, c in candidates]
    design = Design(held)
    rows = materialize(design.rows(folds, day, value, series), "linear")
    lines = solved_lines(rows.where("role = 'train'"), design, held)
    picked = [design.target(c) for c in held]
    logged = np.array([c.value("target") == "log" for c in held])

    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (fold, role), part in batch.groupby(["fold", "role"]):
                if fold not in lines:
                    continue
                count, y = part["count"].to_numpy()[:, None], np.stack(part["y"])[:, picked]
                raw = lines[fold][0] + np.stack(part["x"]) @ lines[fold][1:]
                guess = np.where(logged, np.expm1(np.clip(raw, *LOG_RANGE)), raw + count - y)
                total = np.abs(np.maximum(0.0, guess) - count).sum(axis=0)
                yield pd.DataFrame({"at": range(len(picked)), "fold": fold, "role": role, "error": total, "n": len(part)})

    tried = rows.mapInPandas(errors, "at int, fold int, role string, error double, n long")
    role = {r: [F.when(F.col("role") == r, F.col(c)) for c in ("error", "n")] for r in ("check", "train")}
    per = tried.groupBy("at", "fold").agg(*[
        (F.sum(role[r][0]) / F.sum(role[r][1])).alias(n) for r, n in (("check", "mae"), ("train", "train_mae"))],
        F.sum(role["check"][1]).alias("days"))
    told = F.create_map(*[F.lit(v) for at, (i, c) in enumerate(candidates) for v in (at, json.dumps([i, setting_text(c)]))])
    known = F.from_json(told[F.col("at")], "array<string>")
    return per.select(known[0].cast("int").alias("candidate"), known[1].alias("setting"), "fold", "mae", "train_mae", "days")


def elastic_optimality(rows: DataFrame, candidate, line: Sequence[float]) -> DataFrame:
    """One row: rows and ``off``, how far the line is from the elastic net's optimality conditions, per row and
    relative to the deviation of what is fitted. Aggregates over the rows only; nothing of the solver is used."""
    names, target = history.FEATURE_SETS[candidate.value("featureSet")], fitted_sql(candidate.value("valueCol"), candidate.value("target"))
    alpha, l1_ratio = setting_of(candidate, "alpha"), setting_of(candidate, "l1_ratio")
    scale = rows.agg(F.struct(*[F.struct(F.avg(n).alias("mean"), F.stddev_pop(n).alias("std")).alias(n) for n in names]).alias("s")).scalar()
    rest = F.expr(target) - F.lit(line[0])
    for n, w in zip(names, line[1:]):
        rest = rest - F.lit(w) * F.col(n)
    held = rows.withColumns({"_s": scale, "_rest": rest, "_y": F.expr(target)})
    sums = held.agg(F.count(F.lit(1)).alias("days"), F.avg("_rest").alias("mean_rest"), F.stddev_pop("_y").alias("spread"), F.first("_s").alias("_s"), *[
        F.avg(F.col("_rest") * (F.col(n) - F.col(f"_s.{n}.mean")) / F.when(F.col(f"_s.{n}.std") > 0, F.col(f"_s.{n}.std")).otherwise(1.0)).alias(f"_g_{n}") for n in names])
    off = [F.abs("mean_rest")]
    for n, w in zip(names, line[1:]):
        slope = F.lit(w) * F.col(f"_s.{n}.std")  # over the standardised feature
        pull = F.col(f"_g_{n}") - alpha * (1 - l1_ratio) * slope
        off.append(F.abs(pull - F.lit(alpha * l1_ratio) * F.signum(slope)) if w else F.greatest(F.lit(0.0), F.abs(pull) - alpha * l1_ratio))
    return sums.select("days", (F.greatest(*off) / F.col("spread")).alias("off"))
