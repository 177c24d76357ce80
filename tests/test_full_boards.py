"""The preparation board and the nested cutoff run with the plan's versions, models, folds and settings."""

import inspect

from daymark.plans import classifying
from daymark.plans.catalog import modelling
from daymark.plans.registry import QUERIES


def test_whole_preparation_board(spark, small, monkeypatch):
    seen = {}
    real = classifying.preparation_ablation
    monkeypatch.setattr(classifying, "preparation_ablation", lambda *a, **k: seen.update(inspect.signature(real).bind(*a, **k).arguments))
    QUERIES["m19_preparation_ablation"](spark, small)
    assert len(seen["versions"]) == 5 and set(seen["families"]) == {"logistic", "forest"} and (seen["k"], seen["repeats"]) == (5, 2)
    assert seen["settings"]["forest"]["trees"] == 200 and seen["settings"]["logistic"]["rounds"] == 3000
    assert all(set(numeric + categorical) <= set(seen["df"].columns) for numeric, categorical, _ in seen["versions"].values())


def test_nested_cutoff_runs_until_it_converges(spark, small, monkeypatch):
    made = []
    monkeypatch.setattr(classifying, "nested_cutoff", lambda df, make, **k: made.append(make()))
    QUERIES["m18_nested_cutoff"](spark, small)
    assert made[0].getStages()[-1].getMaxIter() == 3000


def test_board_uses_the_settings(spark):
    rows = spark.createDataFrame([(i, i % 2, float(i % 7), "ab"[i % 3 == 0]) for i in range(60)], "row_id long, label int, size double, kind string")
    board = classifying.preparation_ablation(rows, {"all": (["size"], ["kind"], True)}, ("forest",), 2, 1, settings={"forest": modelling.ABLATION_SETTINGS["forest"] | {"trees": 3}})
    assert board.columns == ["version", "forest"] and 0 <= board.first()["forest"] <= 1
