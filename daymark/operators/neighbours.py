"""Exact nearest neighbours as a partitioned join over k-d cells.

No pair is formed unless it may matter:

1. equal coordinates collapse on both sides (at most ``k`` points stay per coordinate, cut
   map-side, since no more of them can be among the ``k`` nearest), so copies cannot form a hot group;
2. points and queries are cut by the same k-d splits: every cell with more than ``ROWS_PER_CELL`` rows is
   split on its own widest column, ``FAN`` ways at its quantiles, until none is left. The splits, the cells and
   their boxes are tables; the driver sees only how many cells are still too large;
3. query cells walk down the tree of boxes, one join a level: the boxes alone bound the distance of a
   query cell's k-th neighbour, and children whose box lies beyond it are left out;
4. the queries of a cell meet the points of the cells that were left in one bounded group.

The bound is never below the true distance, so the result equals brute force.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import and_, or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from daymark.operators.joins import top_per_group
from daymark.operators.prep import apply_scale, long_values, moments
from daymark.session import materialize

ROWS_PER_CELL = 2000
FAN_BITS = 4
FAN = 1 << FAN_BITS
FEW_CELLS = 4096  # tables of cells up to this many rows are broadcast
PAIRS_AT_ONCE = 2_000_000
PLACES = 9  # distances are compared after rounding, so equal gaps tie in any arithmetic
ROOT = 1  # a child's number is its parent's with one more digit of base FAN


def _boxes(rows: DataFrame, dims: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Box and number of rows of every cell."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.min(d).alias(f"_lo{i}") for i, d in enumerate(dims)],
        *[F.max(d).alias(f"_hi{i}") for i, d in enumerate(dims)])


def _splits(rows: DataFrame, dims: Sequence[str], key: str) -> DataFrame:
    """(key, _cell, _dim, _cuts) of the cells that hold too many rows and can be split.

    The cuts are the quantiles of the cell's widest column. Its least value and its middle are cuts too: the
    first always parts the cell, the second halves the range where most rows share a value.
    """
    shares = [i / FAN for i in range(1, FAN - 2)]
    sized = rows.groupBy(key, "_cell").agg(
        F.count(F.lit(1)).alias("_n"), *[F.min(d).alias(f"_lo{i}") for i, d in enumerate(dims)],
        *[F.max(d).alias(f"_hi{i}") for i, d in enumerate(dims)],
        *[F.percentile_approx(d, shares, 1000).alias(f"_q{i}") for i, d in enumerate(dims)])
    spreads = F.array(*[F.col(f"_hi{i}") - F.col(f"_lo{i}") for i in range(len(dims))])
    large = sized.where(F.col("_n") > ROWS_PER_CELL).withColumn("_dim", (F.array_position(spreads, F.array_max(spreads)) - 1).cast("int"))
    chosen = {c: F.element_at(F.array(*[F.col(f"_{c}{i}") for i in range(len(dims))]), F.col("_dim") + 1) for c in ("lo", "hi", "q")}
    large = large.withColumns({f"_{c}": e for c, e in chosen.items()}).where("_lo < _hi")
    cuts = F.concat("_q", F.array("_lo", F.col("_lo") / 2 + F.col("_hi") / 2))
    return large.withColumn("_cuts", F.array_sort(F.array_distinct(F.filter(cuts, lambda c: c < F.col("_hi"))))).select(
        key, "_cell", "_dim", "_cuts")


def _cut(rows: DataFrame, splits: DataFrame, few: bool, dims: Sequence[str], key: str) -> DataFrame:
    met = rows.join(F.broadcast(splits) if few else splits, [key, "_cell"], "left")
    value = F.element_at(F.array(*dims), F.col("_dim") + 1)
    part = F.size(F.filter("_cuts", lambda c: c < value))
    cell = F.when(F.col("_cuts").isNull(), F.col("_cell")).otherwise(F.shiftleft("_cell", FAN_BITS) + part)
    depth = F.col("_depth") + F.col("_cuts").isNotNull().cast("int")
    return met.withColumns({"_cell": cell, "_depth": depth}).select(*rows.columns)


def _in_cells(asked: DataFrame, held: DataFrame, dims: Sequence[str], key: str) -> tuple[DataFrame, DataFrame, int]:
    """Action: both tables with ``_cell`` and ``_depth``, and the greatest depth."""
    start = {"_cell": F.lit(ROOT).cast("long"), "_depth": F.lit(0)}
    asked, held = asked.withColumns(start), held.withColumns(start)
    depth = 0
    while True:
        both = asked.select(key, "_cell", *dims).unionByName(held.select(key, "_cell", *dims))
        splits = materialize(_splits(both, dims, key), "splits")
        n = splits.count()
        if not n:
            return asked, held, depth
        depth += 1
        # Broadcast while the cells are few and large; later no cell holds more than a small share of the rows.
        asked, held = (materialize(_cut(t, splits, n <= FEW_CELLS, dims, key), "cells") for t in (asked, held))


def _routes(asked: DataFrame, held: DataFrame, dims: Sequence[str], key: str, depth: int, k: int) -> DataFrame:
    """Action: (key, _cell, _visit): the point cells that may hold one of the k nearest of a query cell's rows."""
    width = range(len(dims))
    leaves = materialize(_boxes(held, dims, [key, "_cell", "_depth"]), "leaves")
    pairs = _boxes(asked, dims, [key, "_cell"]).drop("_n").withColumn("_visit", F.lit(ROOT).cast("long"))

    def ancestor(level: int) -> Column:
        return F.expr(f"shiftrightunsigned(_cell, {FAN_BITS} * greatest(0, _depth - {level}))")

    for level in range(1, depth + 1):
        nodes = leaves.groupBy(key, ancestor(level - 1).alias("_visit"), ancestor(level).alias("_child")).agg(
            F.sum("_n").alias("_n"), *[F.min(f"_lo{i}").alias(f"_plo{i}") for i in width], *[F.max(f"_hi{i}").alias(f"_phi{i}") for i in width])
        few = nodes.limit(FEW_CELLS + 1).count() <= FEW_CELLS
        met = pairs.join(F.broadcast(nodes) if few else nodes, [key, "_visit"])
        far, near = F.lit(0.0), F.lit(0.0)
        for i in width:
            lo, hi, plo, phi = (F.col(f"{c}{i}") for c in ("_lo", "_hi", "_plo", "_phi"))
            far = far + F.pow(F.greatest(F.abs(hi - plo), F.abs(phi - lo)), 2)
            near = near + F.pow(F.greatest(F.lit(0.0), plo - hi, lo - phi), 2)
        met = met.withColumns({"_far": F.sqrt(far), "_near": F.sqrt(near)})
        nearest_first = W.partitionBy(key, "_cell").orderBy("_far", "_child").rowsBetween(W.unboundedPreceding, 0)
        enough = met.withColumn("_held", F.sum("_n").over(nearest_first))
        bound = F.coalesce(F.min(F.when(F.col("_held") >= k, F.col("_far"))).over(W.partitionBy(key, "_cell")), F.lit(float("inf")))
        kept = enough.withColumn("_bound", bound).where(F.col("_near") <= F.col("_bound") * (1 + 1e-9) + 1e-9)
        pairs = materialize(kept.select(key, "_cell", *[f"_lo{i}" for i in width], *[f"_hi{i}" for i in width], F.col("_child").alias("_visit")), "routes")
    return pairs.select(key, "_cell", "_visit")


def nearest(queries: DataFrame, points: DataFrame, dims: Sequence[str], k: int, point_id: str,
            carry: Sequence[str] = (), key: str | None = None) -> DataFrame:
    """The ``k`` nearest points of every distinct query coordinate, nearest first, ties by id.

    Returns (key, dims, point_id, carry, distance); join it to query rows on key and dims.
    Only rows of equal ``key`` are compared. Action: writes both reduced sides, their cells and the routes
    between cells.
    """
    made_key = key is None
    key = key or "_stratum"
    if made_key:
        queries, points = queries.withColumn(key, F.lit("all")), points.withColumn(key, F.lit("all"))
    as_double = {d: F.col(d).cast("double") + F.lit(0.0) for d in dims}
    asked = materialize(queries.select(key, *dims).withColumns(as_double).dropna().distinct(), "spots")
    held = points.select(key, point_id, *dims, *carry).withColumns(as_double).dropna(subset=[*dims, point_id])
    held = materialize(top_per_group(held, [key, *dims], [F.col(point_id)], k), "points")
    asked, held, depth = _in_cells(asked, held, dims, key)
    sent = held.select(key, "_cell", point_id, *dims, *carry)
    if depth:
        visits = sent.withColumnRenamed("_cell", "_visit").join(_routes(asked, held, dims, key, depth, k), [key, "_visit"])
        sent = visits.select(key, "_cell", point_id, *dims, *carry)

    dims, carry = list(dims), list(carry)
    out_fields = [T.StructField(key, T.StringType())] + [T.StructField(d, T.DoubleType()) for d in dims]
    out_fields += [held.schema[point_id]] + [held.schema[c] for c in carry] + [T.StructField("distance", T.DoubleType())]
    names = [f.name for f in out_fields]

    def winners(asked_part: pd.DataFrame, held_part: pd.DataFrame) -> pd.DataFrame:
        if asked_part.empty or held_part.empty:
            nothing = {key: pd.Series(dtype=object), **{n: pd.Series(dtype="float64") for n in [*dims, "distance"]}}
            nothing.update({c: held_part[c].iloc[:0] for c in [point_id, *carry]})
            return pd.DataFrame(nothing)[names]
        held_part = held_part.sort_values(point_id, kind="stable").reset_index(drop=True)
        spots, at_spots = held_part[dims].to_numpy(float), asked_part[dims].to_numpy(float)
        used = [i for i in range(len(dims)) if spots[0, i] != 0 or at_spots[0, i] != 0 or spots[:, i].any() or at_spots[:, i].any()]
        step = max(1, PAIRS_AT_ONCE // len(spots))
        rows, picked, gaps_of = [], [], []
        for at in range(0, len(asked_part), step):
            block = at_spots[at:at + step]
            squares = np.zeros((len(block), len(spots)))
            for i in used:
                squares += (block[:, i, None] - spots[None, :, i]) ** 2
            if len(spots) > k:
                # All that can be among the k nearest after rounding, in id order; a stable sort keeps ties so.
                edge = np.sqrt(np.partition(squares, k - 1, axis=1)[:, k - 1]) * (1 + 1e-12) + 10.0 ** -PLACES
                row, point = np.nonzero(squares <= (edge ** 2)[:, None])
            else:
                row, point = (v.ravel() for v in np.indices(squares.shape))
            gaps = np.round(np.sqrt(squares[row, point]), PLACES)
            order = np.lexsort((point, gaps, row))
            row, point, gaps = row[order], point[order], gaps[order]
            heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            best = np.arange(len(row)) - np.repeat(heads, np.diff(np.append(heads, len(row)))) < k
            rows.append(row[best] + at)
            picked.append(point[best])
            gaps_of.append(gaps[best])
        rows, picked = np.concatenate(rows), np.concatenate(picked)
        out = pd.concat([asked_part[[key, *dims]].iloc[rows].reset_index(drop=True),
                         held_part[[point_id, *carry]].iloc[picked].reset_index(drop=True)], axis=1)
        out["distance"] = np.concatenate(gaps_of)
        return out[names]

    found = asked.select(key, "_cell", *dims).groupBy(key, "_cell").cogroup(sent.groupBy(key, "_cell")).applyInPandas(
        winners, T.StructType(out_fields))
    return found.drop(key) if made_key else found


def knn_regress(training: DataFrame, queries: DataFrame, features: Sequence[str], target: str, row_id: str,
                k: int = 5, weights: str = "uniform") -> DataFrame:
    """Query rows with ``prediction``: the mean target of the ``k`` nearest training rows, after scaling."""
    scale = materialize(moments(long_values(training, features)), "scale")
    known = apply_scale(training.select(row_id, target, *features), scale, features)
    asked = apply_scale(queries, scale, features)
    found = nearest(asked, known.withColumn("_y", F.col(target).cast("double")), features, k, row_id, ["_y"])
    mean = F.avg("_y") if weights == "uniform" else _weighted_mean("_y")
    per_spot = found.groupBy(*features).agg(mean.alias("prediction"))
    # The row keeps its own columns; only the scaled spot is used to look the answer up.
    spots = asked.select(row_id, *[F.col(f).cast("double").alias(f) for f in features]).join(per_spot, list(features))
    return queries.join(spots.select(row_id, "prediction"), row_id, "left")


def _weighted_mean(value: str) -> Column:
    """Inverse-distance mean; points at distance zero, if any, share all the weight."""
    exact = F.avg(F.when(F.col("distance") == 0, F.col(value)))
    weight = F.when(F.col("distance") > 0, 1 / F.col("distance"))
    return F.coalesce(exact, F.sum(weight * F.col(value)) / F.sum(weight))


def knn_impute(training: DataFrame, rows: DataFrame, columns: Sequence[str], row_id: str, k: int = 7) -> DataFrame:
    """Fill nulls of ``columns`` from the ``k`` nearest training rows that hold the value.

    Distances are taken on scaled columns that both rows hold and grow by sqrt(all / shared).
    A stratum is (missing column, columns the row holds, columns it shares with the donor), so
    each stratum compares complete coordinates. A row that shares no column with any donor gets
    the training mean. Rows with equal values and nulls have the same neighbours, so each such spot is
    searched once and rows look their answer up.
    """
    columns = list(columns)
    scale = materialize(moments(long_values(training, columns)), "scale")
    donors = apply_scale(training.select(row_id, *columns), scale, columns)
    held = [F.col(c).isNotNull() for c in columns]
    incomplete = reduce(or_, held) & ~reduce(and_, held)
    plain = [F.col(c).cast("double").alias(c) for c in columns]
    spots = materialize(rows.where(incomplete).select(*plain).distinct().withColumn("_spot", F.monotonically_increasing_id()), "asked")
    needy = apply_scale(spots, scale, columns)

    strata = []
    for target in columns:
        others = [c for c in columns if c != target]
        for size in range(1, len(others) + 1):
            for holds in combinations(others, size):
                for shared_size in range(1, size + 1):
                    for shared in combinations(holds, shared_size):
                        strata.append((target, holds, shared))

    def holds_exactly(present: Sequence[str], among: Sequence[str]) -> Column:
        ok = F.lit(True)
        for c in among:
            ok = ok & (F.col(c).isNotNull() if c in present else F.col(c).isNull())
        return ok

    def entry(index: int, target: str, shared: Sequence[str], with_value: bool) -> Column:
        parts = [F.lit(str(index)).alias("_s")]
        parts += [(F.coalesce(F.col(c), F.lit(0.0)) if c in shared else F.lit(0.0)).alias(f"_d{i}") for i, c in enumerate(columns)]
        if with_value:
            parts.append(F.col(target).alias("_v"))
        return F.struct(*parts)

    asked, given = [], []
    for i, (target, holds, shared) in enumerate(strata):
        others = [c for c in columns if c != target]
        asked.append(F.when(F.col(target).isNull() & holds_exactly(holds, others), entry(i, target, shared, False)))
        given.append(F.when(F.col(target).isNotNull() & holds_exactly(shared, holds), entry(i, target, shared, True)))
    dims = [f"_d{i}" for i in range(len(columns))]
    queries = needy.select("_spot", F.inline(F.array_compact(F.array(*asked))))
    points = donors.select(row_id, F.inline(F.array_compact(F.array(*given))))
    found = nearest(queries, points, dims, k, row_id, ["_v"], key="_s")

    factor = F.coalesce(*[F.when(F.col("_s") == str(i), F.lit(float(np.sqrt(len(columns) / len(shared)))))
                          for i, (_, _, shared) in enumerate(strata)])
    aim = F.coalesce(*[F.when(F.col("_s") == str(i), F.lit(target)) for i, (target, _, _) in enumerate(strata)])
    # Several strata can serve one spot, so winners meet per (spot, missing column).
    offers = queries.join(found.withColumnRenamed(row_id, "_donor"), ["_s", *dims]).select(
        "_spot", aim.alias("column"), F.col("_donor"), F.round(F.col("distance") * factor, PLACES).alias("distance"), F.col("_v"))
    best = top_per_group(offers, ["_spot", "column"], [F.col("distance"), F.col("_donor")], k)
    filled = best.groupBy("_spot", "column").agg(_weighted_mean("_v").alias("_v"))
    wide = filled.groupBy("_spot").agg(*[F.max(F.when(F.col("column") == c, F.col("_v"))).alias(f"_f_{c}") for c in columns])
    answers = spots.select("_spot", *[F.col(c).alias(f"_at_{c}") for c in columns]).join(wide, "_spot").drop("_spot")
    spread = scale.agg(F.struct(*[F.struct(
        F.max(F.when(F.col("column") == c, F.col("mean"))).alias("mean"),
        F.max(F.when(F.col("column") == c, F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))).alias("std")).alias(c)
        for c in columns])).scalar()
    same_spot = reduce(and_, [F.col(c).cast("double").eqNullSafe(F.col(f"_at_{c}")) for c in columns])
    out = rows.join(answers, same_spot, "left").withColumn("_fit", spread)
    return out.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.col(f"_f_{c}") * F.col(f"_fit.{c}.std") + F.col(f"_fit.{c}.mean"),
                      F.col(f"_fit.{c}.mean")) for c in columns}).drop("_fit", *[f"{p}_{c}" for p in ("_f", "_at") for c in columns])
