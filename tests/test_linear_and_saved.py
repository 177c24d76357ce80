"""Elastic-net and Huber solvers against their definitions; stages that are saved and loaded."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from daymark.operators import history, prep
from daymark.plans import bindings as b
from daymark.plans import classifying, forecasting, linear


@pytest.fixture(scope="module")
def frame(spark):
    return b.feature_frame(spark, "/root/testdata/sf0.01").where("lag_28 is not null and date < '1995-12-01'").cache()


@pytest.fixture(scope="module")
def arrays(frame):
    names = history.FEATURE_SETS["full"]
    rows = frame.orderBy("date").select("trips", *names).toPandas()
    x = rows[names].to_numpy(float)
    spread = x.std(axis=0)
    spread[spread < 1e-12] = 1.0
    return (x - x.mean(axis=0)) / spread, rows["trips"].to_numpy(float), x, names


def over_scaled(line, x):
    spread = x.std(axis=0)
    return line[0] + x.mean(axis=0) @ np.array(line[1:]), np.array(line[1:]) * spread


@pytest.mark.parametrize("alpha,l1_ratio", [(0.01, 0.5), (0.5, 0.9), (0.5, 0.0), (5.0, 1.0)])
def test_elastic_net_is_optimal(frame, arrays, alpha, l1_ratio):
    z, y, x, _ = arrays
    candidate = forecasting.ResidualForecaster("elastic", "full", alpha=alpha, l1_ratio=l1_ratio)
    shift, w = over_scaled(linear.fit_line(frame, candidate, ["series"], "date", "trips"), x)
    pull = z.T @ (y - shift - z @ w) / len(y) - alpha * (1 - l1_ratio) * w
    off = np.where(w != 0, np.abs(pull - alpha * l1_ratio * np.sign(w)), np.maximum(np.abs(pull) - alpha * l1_ratio, 0))
    assert off.max() < 1e-6 * y.std() and abs((y - shift - z @ w).mean()) < 1e-8 * y.std()


@pytest.mark.parametrize("alpha,epsilon", [(0.0001, 1.35), (1.0, 1.2), (50.0, 2.0)])
def test_huber_is_optimal(frame, arrays, alpha, epsilon):
    z, y, x, _ = arrays
    y = y + np.where(np.arange(len(y)) % 29 == 0, 60.0, 0.0)  # outliers
    days = frame.orderBy("date").select("date").toPandas()
    days["more"] = np.where(np.arange(len(days)) % 29 == 0, 60, 0)
    bent = frame.join(frame.sparkSession.createDataFrame(days), "date").withColumn("trips", F.col("trips") + F.col("more")).drop("more")
    candidate = forecasting.ResidualForecaster("huber", "full", alpha=alpha, epsilon=epsilon)
    shift, w = over_scaled(linear.fit_line(bent, candidate, ["series"], "date", "trips"), x)
    r = np.abs(y - shift - z @ w)
    low, high = 1e-6, 1e6  # the scale's condition grows with the scale
    for _ in range(200):
        sigma = (low * high) ** 0.5
        inside = r <= epsilon * sigma
        grows = len(y) - (r[inside] ** 2).sum() / sigma ** 2 - epsilon ** 2 * (~inside).sum()
        low, high = (low, sigma) if grows > 0 else (sigma, high)

    def loss(v):
        c, u, s = v[0], v[1:-1], np.exp(v[-1])
        t = np.abs(y - c - z @ u) / s
        return (s + s * np.where(t <= epsilon, t * t, 2 * epsilon * t - epsilon ** 2)).sum() + alpha * (u * u).sum()

    best = np.concatenate([[shift], w, [np.log(sigma)]])
    rng = np.random.default_rng(0)
    for size in (1e-1, 1e-2, 1e-3):
        for _ in range(200):
            assert loss(best + size * rng.normal(size=len(best))) >= loss(best) * (1 - 1e-9)


def test_half_life_and_targets_reach_the_solvers(frame):
    for family in linear.SOLVED:
        model = forecasting.ResidualForecaster(family, "compact", "residual7", half_life=40, alpha=0.1).fit(frame)
        grid = forecasting.grid_search_chrono(frame, [forecasting.ResidualForecaster(family, "compact", "log", 40, alpha=0.1)], splits=2)
        assert model.transform(frame).where("prediction is null").count() == 0 and grid.count() == 2
    plain, aged = (forecasting.ResidualForecaster("huber", "compact", half_life=h).fit(frame).stages[0].getStatement() for h in (0, 20))
    assert plain != aged


def saved(stage, loader, tmp_path):
    stage.write().overwrite().save(str(tmp_path))
    return loader.load(str(tmp_path))


@pytest.mark.parametrize("make", [
    lambda: forecasting.ResidualForecaster("ridge", "compact", "residual7", 30, alpha=3.0),
    lambda: forecasting.ResidualForecaster("elastic", "compact", alpha=0.2, l1_ratio=0.7),
    lambda: forecasting.BaselineForecaster("seasonal_average", decay=0.75, adjustment=0.5)])
def test_forecasters_and_their_models_come_back_equal(frame, tmp_path, make):
    estimator = make()
    again = saved(estimator, type(estimator), tmp_path / "estimator")
    assert again.describe() == estimator.describe() and again.extractParamMap().keys() == estimator.extractParamMap().keys()
    model = saved(again.fit(frame), PipelineModel, tmp_path / "model")
    columns = ["date", "prediction"]
    want = estimator.fit(frame).transform(frame).select(columns).orderBy("date").collect()
    assert model.transform(frame).select(columns).orderBy("date").collect() == want


def test_whole_classifier_pipeline_comes_back_equal(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 3, float(i % 7), None if i % 5 == 0 else float(i % 4), "ab"[i % 2]) for i in range(120)],
                                 "row_id int, label int, size double, width double, kind string").withColumn("label", (F.col("label") == 0).cast("int"))
    design = classifying.FeatureDesign(["size", "width"], ["kind"], ratios=[("size", "width")], engineered=True, keep=["row_id", "label"])
    fill = prep.ChainedImputer(["size", "width"], rounds=3)
    pipeline = Pipeline(stages=[design, fill, classifying.classifier("logistic", ["size", "width", "size_log1p"], ["kind"])])
    again = saved(pipeline, Pipeline, tmp_path / "pipeline")
    model = saved(again.fit(rows), PipelineModel, tmp_path / "model")
    want = classifying.score_rows(pipeline.fit(rows), rows, ["row_id"]).orderBy("row_id").collect()
    assert classifying.score_rows(model, rows, ["row_id"]).orderBy("row_id").collect() == want
    majority = saved(classifying.MajorityClassifier().fit(rows), PipelineModel, tmp_path / "majority")
    assert {r["score"] for r in majority.transform(rows).collect()} == {0.0}
