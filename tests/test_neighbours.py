"""The partitioned nearest-neighbour join equals brute force."""

import numpy as np
import pandas as pd
import pytest

from daymark.operators import neighbours, prep
from pyspark.sql import functions as F


def brute(asked, held, dims, k):
    out = {}
    for i, q in asked.iterrows():
        gap = np.round(np.sqrt(((held[dims].to_numpy() - q[dims].to_numpy(float)) ** 2).sum(axis=1)), 9)
        best = pd.DataFrame({"d": gap, "id": held["id"]}).sort_values(["d", "id"]).head(k)
        out[tuple(q[dims])] = list(zip(best["id"], best["d"]))
    return out


@pytest.mark.parametrize("dims", [["x"], ["x", "y"], ["x", "y", "z"]])
def test_nearest_equals_brute_force(spark, monkeypatch, dims):
    monkeypatch.setattr(neighbours, "ROWS_PER_CELL", 12)
    rng = np.random.default_rng(11)
    held = pd.DataFrame(np.round(rng.normal(size=(400, 3)) * 4, 1), columns=["x", "y", "z"])
    held.loc[rng.random(400) < 0.35, ["x", "y", "z"]] = 1.5  # a third of the points are copies
    held["id"] = np.arange(400)
    asked = pd.DataFrame(np.round(rng.normal(size=(120, 3)) * 4, 1), columns=["x", "y", "z"])
    asked.loc[:40, ["x", "y", "z"]] = 1.5
    found = neighbours.nearest(spark.createDataFrame(asked), spark.createDataFrame(held), dims, 5, "id").toPandas()
    want = brute(asked.drop_duplicates(dims), held, dims, 5)
    got = {key: sorted(zip(part["id"], part["distance"]), key=lambda t: (t[1], t[0]))
           for key, part in found.groupby(dims if len(dims) > 1 else dims[0])}
    got = {k if isinstance(k, tuple) else (k,): v for k, v in got.items()}
    assert got == want


def test_knn_impute_falls_back_to_the_mean(spark):
    training = spark.createDataFrame([(1, 1.0, 10.0), (2, 2.0, 20.0), (3, 3.0, None)], "row_id long, a double, b double")
    rows = spark.createDataFrame([(9, None, None), (8, 1.0, None)], "row_id long, a double, b double")
    got = {r["row_id"]: (r["a"], r["b"]) for r in neighbours.knn_impute(training, rows, ["a", "b"], "row_id", k=1).collect()}
    assert got[9] == (2.0, 15.0)
    assert got[8] == (1.0, pytest.approx(10.0))


def test_chained_imputer_equals_row_by_row_chain(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    x[:, 2] = x[:, 0] - 2 * x[:, 1] + 0.1 * x[:, 2]
    x[rng.random((200, 3)) < 0.2] = np.nan
    frame = pd.DataFrame(x, columns=["a", "b", "c"])
    df = spark.createDataFrame(frame).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in frame])
    rounds, ridge = 4, 1e-3
    got = prep.ChainedImputer(["a", "b", "c"], rounds, ridge).fit(df).transform(df).toPandas().to_numpy()

    gone = np.isnan(x)
    mean = np.nanmean(x, axis=0)
    now = np.where(gone, mean, x)
    order = sorted(range(3), key=lambda i: (gone[:, i].sum(), i))
    for _ in range(rounds):
        for t in order:
            others = [i for i in range(3) if i != t]
            a, y = now[~gone[:, t]][:, others], now[~gone[:, t], t]
            s = a.std(axis=0)
            z = (a - a.mean(axis=0)) / s
            w = np.linalg.solve(z.T @ z / len(y) + ridge * np.eye(2), z.T @ (y - y.mean()) / len(y)) / s
            now[gone[:, t], t] = y.mean() + (now[gone[:, t]][:, others] - a.mean(axis=0)) @ w
    np.testing.assert_allclose(np.sort(got, axis=0), np.sort(now, axis=0), rtol=1e-9, atol=1e-9)


def clustered(n, seed):
    """Points on very different scales, many of them on one line, so cells end at different depths."""
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame(np.round(rng.normal(size=(n, 2)) * 10.0 ** rng.integers(-2, 4, size=(n, 1)), 3), columns=["x", "y"])
    frame.loc[rng.random(n) < 0.4, "y"] = 0.0
    frame.loc[rng.random(n) < 0.2, "x"] = 7.0
    frame["id"] = np.arange(n)
    return frame


@pytest.mark.parametrize("few", [0, 4096])
def test_cells_stay_small_and_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(neighbours, "ROWS_PER_CELL", 20)
    monkeypatch.setattr(neighbours, "FEW_CELLS", few)
    held, asked = clustered(900, 4), clustered(300, 5)[["x", "y"]].drop_duplicates()
    points, spots = spark.createDataFrame(held).withColumn("s", F.lit("a")), spark.createDataFrame(asked).withColumn("s", F.lit("a"))
    _, cells, depth = neighbours._in_cells(spots, points.dropDuplicates(["x", "y"]), ["x", "y"], "s")
    assert cells.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 20 and depth >= 2
    found = neighbours.nearest(spots, points, ["x", "y"], 4, "id", key="s").toPandas()
    want = brute(asked, held, ["x", "y"], 4)
    got = {spot: sorted(zip(part["id"], part["distance"]), key=lambda t: (t[1], t[0])) for spot, part in found.groupby(["x", "y"])}
    assert got == want


def test_strata_are_split_on_their_own_column(spark, monkeypatch):
    """One stratum uses the third column alone, one the first two, one has queries and no points."""
    monkeypatch.setattr(neighbours, "ROWS_PER_CELL", 15)
    rng = np.random.default_rng(8)
    base = pd.DataFrame(np.round(rng.normal(size=(600, 3)), 2), columns=["x", "y", "z"])
    base["s"] = rng.choice(["third", "both", "empty"], 600)
    base.loc[base["s"] == "third", ["x", "y"]] = 0.0
    base.loc[base["s"] == "both", "z"] = 0.0
    base["id"] = np.arange(600)
    held, asked = base[(base["id"] % 3 > 0) & (base["s"] != "empty")], base[base["id"] % 3 == 0]
    dims = ["x", "y", "z"]
    points = spark.createDataFrame(held)
    _, cells, _ = neighbours._in_cells(spark.createDataFrame(asked).select("s", *dims), points.dropDuplicates(["s", *dims]), dims, "s")
    assert cells.where("s = 'third'").select("_cell").distinct().count() > 5
    found = neighbours.nearest(spark.createDataFrame(asked), points, dims, 3, "id", key="s").toPandas()
    assert set(found["s"]) == {"third", "both"}
    for s in ("third", "both"):
        want = brute(asked[asked["s"] == s].drop_duplicates(dims), held[held["s"] == s], dims, 3)
        got = {spot: sorted(zip(part["id"], part["distance"]), key=lambda t: (t[1], t[0])) for spot, part in found[found["s"] == s].groupby(dims)}
        assert got == want


def test_neighbours_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, x double")
    some = spark.createDataFrame([(1, 2.0), (2, None)], "id long, x double")
    assert neighbours.nearest(some, empty, ["x"], 2, "id").count() == 0
    assert neighbours.nearest(empty, some, ["x"], 2, "id").count() == 0
    assert neighbours.nearest(some, some, ["x"], 2, "id").count() == 1


def test_equal_rows_are_imputed_by_one_search(spark, monkeypatch):
    rows = spark.createDataFrame([(i, float(i % 3) if i % 2 else None, float(i % 5)) for i in range(600)] + [(600 + i, None, None) for i in range(9)],
                                 "row_id long, a double, b double")
    asked = []
    real = neighbours.nearest
    monkeypatch.setattr(neighbours, "nearest", lambda queries, *a, **k: asked.append(queries.count()) or real(queries, *a, **k))
    got = {r["row_id"]: r["a"] for r in neighbours.knn_impute(rows, rows, ["a", "b"], "row_id", k=3).collect()}
    assert asked == [5] and len(got) == 609  # one search for each value of b, however many rows hold it
    known = [(r["row_id"], r["a"], r["b"]) for r in rows.where("a is not null").collect()]
    mean = sum(a for _, a, _ in known) / len(known)
    for i in range(609):
        if i >= 600:
            assert abs(got[i] - mean) < 1e-9
        elif i % 2 == 0:
            exact = sorted(j for j, _, b in known if b == i % 5)[:3]
            assert abs(got[i] - sum(j % 3 for j in exact) / 3) < 1e-9
