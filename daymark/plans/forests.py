"""All forests of a preparation board from one table of counts.

A forest of ``pyspark.ml`` sees a number only through its bins and draws each row Poisson(1) times for each tree. Rows
that agree in all bins and levels are therefore one cell with a count: the draws of its rows add up to Poisson(count),
so the trees have the same distribution as over rows, while a tree's work is bounded by cells instead of rows. Spark
counts the cells of all folds in one aggregation and deals packs of trees to tasks; no tree reaches the driver.

Trees follow ``RandomForestClassifier``: up to 32 bins a number, square root of the columns tried at each node, Gini
gain above zero, leaves of equal class under one parent merged, scores as mean shares of the leaves. Two things differ:
bins are cut at quantiles of all training rows, not of a sample, and a cut lies at the value itself, not half-way to the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymark.operators import validate
from daymark.session import materialize

#: As many bins as Spark's forests have by default, trees grown side by side in a task, and cells that a task may hold.
BINS, PACK, CELLS = 32, 25, 50_000
KEYS, COUNTS = ["repeat", "held"], ["t0", "t1", "h0", "h1"]
SETTINGS = {"trees": 40, "depth": 6, "leaf": 3}


def cells_of(folds: DataFrame, versions: dict[str, tuple[Sequence[str], Sequence[str], bool]], k: int) -> DataFrame:
    """Per version, repeat and held-out fold: bins, levels, and rows by label, in training (``t0``, ``t1``) and held out.

    Medians and bins come from training rows only. Actions: the table of bins is written.
    """
    numeric = sorted({c for n, _, _ in versions.values() for c in n})
    categorical = sorted({c for _, n, _ in versions.values() for c in n})
    number = [F.col(f"`{c}`").cast("double") for c in numeric]
    places = range(len(numeric))
    dealt = folds.select(
        "repeat", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("held"), "fold", "label",
        *[F.when(~F.isnan(n), n).alias(f"raw{i}") for i, n in enumerate(number)],
        *[F.col(f"`{c}`").isNull().cast("int").alias(f"gone{i}") for i, c in enumerate(numeric)],
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(validate.MISSING_LEVEL)).alias(f"known{i}") for i, c in enumerate(categorical)])
    medians = dealt.where("fold <> held").groupBy(*KEYS).agg(*[F.percentile_approx(f"raw{i}", 0.5, 1000).alias(f"median{i}") for i in places])
    full = dealt.join(F.broadcast(medians), KEYS).withColumns({f"full{i}": F.coalesce(f"raw{i}", f"median{i}") for i in places})
    bins = materialize(_bins(full.where("fold <> held"), [f"full{i}" for i in places]), "bins")
    if bins.where("marks is null").first():
        raise ValueError("a number column has no value in the training rows of a fold")
    marks = bins.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("column", "marks"))).alias("marks"))
    training, positive = F.col("fold") != F.col("held"), F.col("label") == 1
    below = lambda c: F.size(F.filter(F.col("marks")[c], lambda m: m < F.col(c)))
    binned = full.join(F.broadcast(marks), KEYS).groupBy(*KEYS, *[below(f"full{i}").alias(f"bin{i}") for i in places], *[f"gone{i}" for i in places], *[f"known{i}" for i in range(len(categorical))]).agg(
        F.count_if(training & ~positive).alias("t0"), F.count_if(training & positive).alias("t1"),
        F.count_if(~training & ~positive).alias("h0"), F.count_if(~training & positive).alias("h1"))
    finest = materialize(binned, "finest")
    parts = []
    for version, (numbers, levels, flags) in versions.items():
        at = [numeric.index(c) for c in numbers]
        codes = [f"bin{i}" for i in at] + [f"gone{i}" for i in at if flags]
        known = [f"known{categorical.index(c)}" for c in levels]
        parts.append(finest.groupBy(F.lit(version).alias("version"), *KEYS, F.array(*codes).cast("array<int>").alias("bins"),
                                    F.array(*known).cast("array<string>").alias("levels")).agg(*[F.sum(c).alias(c) for c in COUNTS]))
    return reduce(DataFrame.unionByName, parts)


def _bins(training: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The largest values of all bins but the last: every value but the last where few differ, else quantiles; null without values."""
    shares = [i / BINS for i in range(1, BINS)]
    longer = lambda name: F.explode(F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*columns))).alias("column", name)
    cuts = training.groupBy(*KEYS).agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]).select(*KEYS, longer("cuts"))
    values = training.select(*KEYS, longer("value")).where("value is not null").distinct()
    first = F.row_number().over(W.partitionBy(*KEYS, "column").orderBy("value"))
    few = values.withColumn("at", first).where(F.col("at") <= BINS + 1).groupBy(*KEYS, "column").agg(F.array_sort(F.collect_list("value")).alias("few"))
    marks = F.when(F.size("few") <= BINS, F.slice("few", 1, F.size("few") - 1)).otherwise(F.array_distinct("cuts"))
    return cuts.join(few, [*KEYS, "column"], "left").select(*KEYS, "column", F.when(F.col("few").isNotNull(), marks).alias("marks"))


def forest_counts(folds: DataFrame, versions: dict[str, tuple[Sequence[str], Sequence[str], bool]], k: int,
                  settings: dict | None = None, cells: int = CELLS) -> tuple[DataFrame | None, set[str]]:
    """Action: per version, repeat and fold the held-out rows and positives of each forest's score, and the versions answered.

    A version is left to the caller where a fold has more than ``cells`` cells, since a task holds the cells of a fold.
    So are versions without numbers, and all where labels are not 0 and 1 or ``settings`` names more than trees, depth and leaf.
    """
    if set(settings or {}) - set(SETTINGS) or folds.where("label is null or label not in (0, 1)").limit(1).count():
        return None, set()
    chosen = SETTINGS | (settings or {})
    versions = {name: version for name, version in versions.items() if version[0]}
    if not versions:
        return None, set()
    counted = materialize(cells_of(folds, versions, k), "cells")
    sizes = counted.groupBy("version", *KEYS).count().groupBy("version").agg(F.max("count").alias("most"), F.count(F.lit(1)).alias("fits")).collect()
    done = {r["version"]: r["fits"] for r in sizes if r["most"] <= cells}
    if not done:
        return None, set()
    packs = -(-chosen["trees"] // PACK)
    trees, depth, leaf = chosen["trees"], chosen["depth"], chosen["leaf"]

    def grown(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        version, repeat, held, pack = key
        part = part.assign(bins=part["bins"].map(tuple), levels=part["levels"].map(tuple)).sort_values(["bins", "levels"], ignore_index=True)
        counts = part[["t0", "t1"]].to_numpy()
        rng = np.random.default_rng([crc32(str(version).encode()), repeat, held, pack])
        codes = _codes(part["bins"], part["levels"], counts.sum(1) > 0)
        asked = (part["h0"] + part["h1"]).to_numpy() > 0
        part["total"] = grow(codes, counts, asked, rng, min(PACK, trees - pack * PACK), depth, leaf)
        return part.loc[asked, ["version", "repeat", "held", "bins", "levels", "h0", "h1", "total"]].assign(pack=pack)

    sent = counted.where(F.col("version").isin(list(done))).withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    by = ["version", *KEYS, "pack"]
    # Small in bytes and long in work, so the number of partitions is given: a few for each core.
    tasks = min(packs * sum(done.values()), 8 * folds.sparkSession.sparkContext.defaultParallelism)
    totals = sent.repartition(tasks, *by).groupBy(*by).applyInPandas(
        grown, "version string, repeat int, held int, bins array<int>, levels array<string>, h0 long, h1 long, total double, pack int")
    # Added in the order of packs, so that equal scores stay equal in every run.
    added = F.aggregate(F.array_sort(F.collect_list(F.struct("pack", "total"))), F.lit(0.0), lambda a, x: a + x["total"])
    scored = totals.groupBy("version", *KEYS, "bins", "levels").agg(
        F.least(F.lit(1.0), added / trees).alias("threshold"), F.first(F.col("h0") + F.col("h1")).alias("n"), F.first("h1").alias("pos"))
    out = scored.groupBy("version", "repeat", F.col("held").alias("fold"), "threshold").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    return materialize(out, "forests"), set(done)


def _codes(bins: pd.Series, levels: pd.Series, known: np.ndarray) -> np.ndarray:
    """A row per cell: bins of numbers, then 0 or 1 for each level that a training row has."""
    numbers = np.array(bins.tolist(), np.int64).reshape(len(bins), -1)
    texts = np.array(levels.tolist(), object).reshape(len(levels), -1)
    hot = [column == level for column in texts.T for level in sorted(set(column[known]))]
    return np.column_stack([numbers, *hot]).astype(np.uint8)


def _impurity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = np.maximum(a + b, 1.0)
    return 1.0 - (a / n) ** 2 - (b / n) ** 2


def _gains(l0: np.ndarray, l1: np.ndarray, n0: np.ndarray, n1: np.ndarray, leaf: int) -> np.ndarray:
    left, n = l0 + l1, n0 + n1
    gain = _impurity(n0, n1) - left / n * _impurity(l0, l1) - (n - left) / n * _impurity(n0 - l0, n1 - l1)
    return np.where((left >= leaf) & (n - left >= leaf), gain, -np.inf)


def grow(codes: np.ndarray, counts: np.ndarray, asked: np.ndarray, rng: np.random.Generator, trees: int, depth: int, leaf: int) -> np.ndarray:
    """Sum over ``trees`` of the share of label 1 in each asked cell's leaf. All trees grow level by level together."""
    cells, features = codes.shape
    tried, flat, top = int(np.ceil(np.sqrt(features))), codes.ravel(), codes[counts.sum(1) > 0].max(0, initial=0)
    drawn = rng.poisson(counts, (trees, cells, 2)).astype(float)
    tree, cell = np.nonzero((drawn.sum(2) > 0) | asked)
    w0, w1 = drawn[tree, cell].T.copy()
    last = tree.copy()  # the entry's node so far
    total = [np.bincount(tree, w, trees) for w in (w0, w1)]
    sums, parents, kids, start = [total], [np.full(trees, -1)], [], 0  # per level: counts, parent, first child
    entry, at = np.arange(len(cell)), tree
    for level in range(depth + 1):
        n0, n1 = sums[-1]
        child = np.full(len(n0), -1)
        kids.append(child)
        open_ = np.flatnonzero((n0 > 0) & (n1 > 0) & (n0 + n1 >= 2 * leaf)) if level < depth else np.empty(0, np.int64)
        place = np.full(len(n0), -1)
        place[open_] = np.arange(len(open_))
        at = place[at]
        entry, at = entry[at >= 0], at[at >= 0]
        if not len(open_):
            break
        n0, n1 = n0[open_], n1[open_]
        base, a0, a1 = cell[entry] * features, w0[entry], w1[entry]
        picked = np.argpartition(rng.random((len(open_), features), np.float32), tried - 1, 1)[:, :tried] if tried < features else np.tile(np.arange(features), (len(open_), 1))
        best, column, cut = np.full(len(open_), 0.0), np.zeros(len(open_), np.int64), np.zeros(len(open_), np.int64)
        for j in picked.T:
            code = flat[base + j[at]]
            low = code == 0
            gain = _gains(np.bincount(at[low], a0[low], len(open_)), np.bincount(at[low], a1[low], len(open_)), n0, n1, leaf)
            first = np.zeros(len(open_), np.int64)
            many = np.flatnonzero(top[j] > 1)
            if len(many):  # more than two bins: all cuts of these nodes
                width = int(top[j[many]].max()) + 1
                to = np.full(len(open_), -1)
                to[many] = np.arange(len(many))
                here = to[at] >= 0
                slot = to[at[here]] * width + np.minimum(code[here], width - 1)
                l0, l1 = (np.bincount(slot, w[here], len(many) * width).reshape(-1, width).cumsum(1)[:, :-1] for w in (a0, a1))
                gains = _gains(l0, l1, n0[many, None], n1[many, None], leaf)
                first[many] = gains.argmax(1)
                gain[many] = gains.max(1)
            better = gain > best
            best[better], column[better], cut[better] = gain[better], j[better], first[better]
        split = np.flatnonzero(best > 0)
        rank = np.full(len(open_), -1)
        rank[split] = np.arange(len(split))
        child[open_[split]] = 2 * rank[split]
        keep = rank[at] >= 0
        entry, at, base = entry[keep], at[keep], base[keep]
        at = 2 * rank[at] + (flat[base + column[at]] > cut[at])
        start += len(child)
        last[entry] = start + at
        sums.append([np.bincount(at, w[entry], 2 * len(split)) for w in (w0, w1)])
        parents.append(np.repeat(open_[split], 2))
    return np.bincount(cell[asked[cell]], _shares(sums, parents, kids)[last][asked[cell]], cells)


def _shares(sums: list, parents: list, kids: list) -> np.ndarray:
    """Share of label 1 that a node answers with, after leaves of equal class under one parent are merged."""
    closed, merged = [child < 0 for child in kids], [np.zeros(len(child), bool) for child in kids]
    for level in range(len(kids) - 2, -1, -1):
        inner = np.flatnonzero(kids[level] >= 0)
        left = kids[level][inner]
        one = sums[level + 1][1] > sums[level + 1][0]
        same = closed[level + 1][left] & closed[level + 1][left + 1] & (one[left] == one[left + 1])
        closed[level][inner[same]] = True
        merged[level + 1][left[same]] = merged[level + 1][left[same] + 1] = True
    shares = []
    for level, (n0, n1) in enumerate(sums):
        share = n1 / np.maximum(n0 + n1, 1.0)
        if level:
            share = np.where(merged[level], shares[-1][parents[level]], share)
        shares.append(share)
    return np.concatenate(shares)
