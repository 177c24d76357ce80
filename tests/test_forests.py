"""Forests grown from counts: the trees are Spark's, the whole board asks for no other fit, and copies of rows add no cells."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from daymark.operators import scoring
from daymark.operators.split import stratified_folds
from daymark.plans import classifying, forests
from daymark.plans.catalog import modelling


class Unbagged:
    """Draws every row once, so that one tree over all columns can be compared with Spark's."""

    def poisson(self, counts, shape):
        return np.broadcast_to(counts, shape)


@pytest.mark.parametrize("depth", [3, 30])
def test_tree_equals_sparks(spark, depth):
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 30, 3000), rng.integers(0, 2, 3000)
    label = (rng.random(3000) < 0.15 + 0.5 * (np.sin(x) > 0.2) * y).astype(int)
    rows = spark.createDataFrame(list(zip(x.astype(float).tolist(), y.astype(float).tolist(), label.tolist())), "x double, y double, label int")
    ready = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(rows)
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=3, maxBins=32).fit(ready)
    want = {(r["x"], r["y"]): r["p"] for r in model.transform(ready).select("x", "y", vector_to_array("probability")[1].alias("p")).distinct().collect()}
    spots = sorted(want)
    counts = np.array([[np.sum((x == a) & (y == b) & (label == c)) for c in (0, 1)] for a, b in spots])
    got = forests.grow(np.array(spots).astype(np.uint8), counts, np.ones(len(spots), bool), Unbagged(), 1, depth, 3)
    assert len(set(want.values())) > 3
    np.testing.assert_allclose(got, [want[s] for s in spots], rtol=1e-12)


def odd_rows(spark, n=600, copies=1):
    rows = [(i, int(i * 7919 % 13 < 4 + i % 3), None if i % 7 == 0 else float("nan") if i % 31 == 0 else float(i * 31 % 97), float(i % 2),
             None if i % 5 == 0 else "rare" if i == 8 else "abc"[i % 3]) for i in range(n)]
    made = spark.createDataFrame(rows, "row_id long, label int, size double, flag double, kind string")
    return made.withColumn("row_id", F.explode(F.sequence(F.col("row_id") * copies, F.col("row_id") * copies + copies - 1)))


VERSIONS = {"all": (["size", "flag"], ["kind"], True), "no kind": (["size"], [], False)}
SETTINGS = {"forest": {"trees": 60, "leaf": 3, "depth": 30}}


def test_whole_board_without_a_fit_per_forest(spark, monkeypatch):
    def no_forest(family, *rest, **settings):
        raise AssertionError(f"a {family} was fitted by itself")

    monkeypatch.setattr(classifying, "classifier", no_forest)
    board = classifying.preparation_ablation(odd_rows(spark), VERSIONS, ("forest",), 3, 2, settings=SETTINGS)
    assert {r["version"] for r in board.collect()} == set(VERSIONS) and board.where("forest between 0 and 1").count() == 2


def test_every_held_out_row_is_scored_alike_each_time(spark):
    folds = stratified_folds(odd_rows(spark), "row_id", "label", 3, 2)
    once, again = (forests.forest_counts(folds, VERSIONS, 3, SETTINGS["forest"])[0] for _ in range(2))
    held = {tuple(r) for r in folds.groupBy("repeat", "fold").agg(F.count("*"), F.count_if(F.expr("label = 1"))).collect()}
    for version in VERSIONS:
        assert {tuple(r) for r in once.where(F.col("version") == version).groupBy("repeat", "fold").agg(F.sum("n"), F.sum("pos")).collect()} == held
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


def test_copies_of_rows_add_no_cells(spark):
    sizes = [forests.cells_of(stratified_folds(odd_rows(spark, copies=c), "row_id", "label", 3, 1), {"all": VERSIONS["all"]}, 3).agg(
        F.count("*"), F.sum(F.col("t0") + F.col("t1") + F.col("h0") + F.col("h1"))).first() for c in (4, 40)]
    assert sizes[1][1] == 10 * sizes[0][1] and sizes[1][0] <= 1.1 * sizes[0][0]


def test_scores_close_to_sparks_forest(spark):
    rows = odd_rows(spark, 3000)
    mine = classifying.preparation_ablation(rows, VERSIONS, ("forest",), 3, 1, settings=SETTINGS)
    # A setting that only Spark's forests know sends every fit to them.
    theirs = classifying.preparation_ablation(rows, VERSIONS, ("forest",), 3, 1, settings={"forest": SETTINGS["forest"] | {"cacheNodeIds": True}})
    a, b = ({r["version"]: r["forest"] for r in board.collect()} for board in (mine, theirs))
    assert a.keys() == b.keys() and all(abs(a[v] - b[v]) < 0.03 for v in a)


def test_many_cells_and_odd_labels_are_left_to_sparks_forests(spark):
    rows = odd_rows(spark, 200)
    folds = stratified_folds(rows, "row_id", "label", 2, 1)
    assert forests.forest_counts(folds, VERSIONS, 2, {"trees": 2}, cells=3) == (None, set())
    assert forests.forest_counts(folds.withColumn("label", F.col("label") + 1), VERSIONS, 2) == (None, set())
    some = forests.forest_counts(folds, VERSIONS | {"flag": (["flag"], [], False)}, 2, {"trees": 2}, cells=3)
    assert some[1] == {"flag"}


def test_number_without_values_is_refused(spark):
    rows = odd_rows(spark, 40).withColumn("size", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="no value"):
        forests.forest_counts(stratified_folds(rows, "row_id", "label", 2, 1), VERSIONS, 2)


def test_counted_ranking_equals_ranking_of_rows(spark):
    scores = spark.range(200).select((F.col("id") % 3 == 0).cast("int").alias("label"), ((F.col("id") * 37 % 50) / 50).alias("score"))
    assert scoring.counted_ranking(scoring.score_counts(scores)).first() == scoring.ranking_metrics(scores).first()


def test_catalog_settings_are_known_to_the_counted_forests():
    assert set(modelling.ABLATION_SETTINGS["forest"]) == set(forests.SETTINGS)
