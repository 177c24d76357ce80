"""Logistic fits from shared passes: Spark's scores at its optimum, no fit by itself, and the rest left to Spark."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from daymark.operators.split import stratified_folds
from daymark.plans import classifying, logits
from daymark.plans.catalog import modelling

VERSIONS = {"all": (["size", "flag"], ["kind"], True), "no kind": (["size"], [], False)}


def odd_rows(spark, n=500):
    rows = [(i, int(i * 7919 % 13 < 4 + i % 3), None if i % 7 == 0 else float("nan") if i % 31 == 0 else float(i * 31 % 97) * 1e3, float(i % 2),
             None if i % 5 == 0 else "rare" if i == 8 else "abc"[i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, label int, size double, flag double, kind string")


def test_no_fit_by_itself(spark, monkeypatch):
    def no_fit(family, *rest, **settings):
        raise AssertionError(f"a {family} was fitted by itself")

    monkeypatch.setattr(classifying, "classifier", no_fit)
    board = classifying.preparation_ablation(odd_rows(spark), VERSIONS, ("logistic",), 3, 2, settings={"logistic": {"rounds": 3000}})
    assert board.columns == ["version", "logistic"] and board.where("logistic between 0 and 1").count() == 2


def test_scores_equal_sparks_at_its_optimum(spark):
    folds = stratified_folds(odd_rows(spark), "row_id", "label", 3, 1)
    counted, done = logits.logistic_counts(folds, VERSIONS, 3, {"rounds": 100})
    assert done == set(VERSIONS)
    for version, (numeric, categorical, flags) in VERSIONS.items():
        model = classifying.classifier("logistic", numeric, categorical, flags, rounds=1000, tol=1e-12).fit(folds.where("fold <> 0"))
        held = model.transform(folds.where("fold = 0")).select("label", vector_to_array("_probability")[1].alias("p")).collect()
        got = counted.where((F.col("version") == version) & (F.col("fold") == 0)).collect()
        mine = sorted(r["threshold"] for r in got for _ in range(r["n"]))
        assert mine == pytest.approx(sorted(r["p"] for r in held), abs=1e-6)
        assert sum(r["pos"] for r in got) == sum(r["label"] for r in held)
        assert sum(r["threshold"] * r["pos"] for r in got) == pytest.approx(sum(r["p"] * r["label"] for r in held), abs=1e-4)


def test_separable_and_one_class_labels_end(spark):
    rows = odd_rows(spark, 120)
    for label in (F.col("flag").cast("int"), F.lit(0)):
        folds = stratified_folds(rows.withColumn("label", label), "row_id", "label", 2, 1)
        counted, _ = logits.logistic_counts(folds, {"all": VERSIONS["all"]}, 2, {"rounds": 200, "alpha": 1e-6})
        assert counted.agg(F.sum("n")).first()[0] == 120


def test_rest_is_left_to_spark(spark):
    folds = stratified_folds(odd_rows(spark, 200), "row_id", "label", 2, 1)
    assert logits.logistic_counts(folds, VERSIONS, 2, {"elasticNetParam": 0.5}) == (None, set())
    assert logits.logistic_counts(folds.withColumn("label", F.col("label") + 1), VERSIONS, 2) == (None, set())
    many = folds.withColumn("kind", F.concat(F.lit("k"), F.col("row_id").cast("string")))
    assert logits.logistic_counts(many, VERSIONS, 2) == (None, set())
    assert set(modelling.ABLATION_SETTINGS["logistic"]) <= set(logits.SETTINGS)
