"""Ranks, running totals and quantiles against pandas, with hot values and several ranges."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daymark.operators import ordered, profile
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    values = np.where(rng.random(3000) < 0.4, 7.0, np.round(rng.normal(size=3000), 2))
    frame = pd.DataFrame({"k": rng.choice(["a", "b", "c"], 3000, p=[0.7, 0.2, 0.1]), "v": values, "w": rng.integers(0, 5, 3000)})
    return frame, spark.createDataFrame(frame).repartition(4).cache()


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_match_pandas(skewed, descending):
    frame, df = skewed
    grouped = df.groupBy("k", "v").agg(F.sum("w").alias("w"))
    got = ordered.running_totals(grouped, "v", ["w"], ["k"], descending).toPandas()
    want = frame.groupby(["k", "v"], as_index=False)["w"].sum().sort_values(["k", "v"], ascending=[True, not descending])
    want["w_upto"] = want.groupby("k")["w"].cumsum()
    want["w_all"] = want.groupby("k")["w"].transform("sum")
    key = ["k", "v"]
    pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True)[key + ["w_upto", "w_all"]],
                                  want.sort_values(key).reset_index(drop=True)[key + ["w_upto", "w_all"]])


def test_quantiles_match_pandas(skewed):
    frame, df = skewed
    got = ordered.quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.975}, ["k"]).toPandas().set_index("k").sort_index()
    want = frame.groupby("k")["v"].quantile([0.1, 0.5, 0.975]).unstack()
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), rtol=0, atol=1e-12)


def test_mean_ranks_match_pandas(skewed):
    frame, df = skewed
    got = dict(ordered.value_ranks(df, "v").select("v", "mean_rank").collect())
    want = dict(zip(frame["v"], frame["v"].rank()))
    assert got == want


def test_numbered_is_a_row_number(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 3).alias("k"))
    bucket = F.conv(F.substring("h", 1, 3), 16, 10).cast("int")
    got = ordered.numbered(df, ["h"], bucket, ["k"]).toPandas().sort_values(["k", "h"])
    assert (got["position"] == got.groupby("k").cumcount() + 1).all()
    assert (got["position_of"] == got.groupby("k")["h"].transform("size")).all()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-3, 3)), min_size=4, max_size=30).filter(
    lambda rows: {r[0] for r in rows} == {0, 1}))
def test_mann_whitney_u_counts_pairs(spark, rows):
    got = profile.mann_whitney(spark.createDataFrame(rows, "label int, x int"), ["x"], p_value=False).first()
    pos, neg = [x for y, x in rows if y], [x for y, x in rows if not y]
    assert got["u"] == sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)


def test_spearman_matches_pandas(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"a": rng.integers(0, 9, 300).astype(float), "b": rng.normal(size=300)})
    frame.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(frame).select(F.nanvl("a", F.lit(None)).alias("a"), "b")
    got = profile.spearman_matrix(df, ["a", "b"]).first()["rho"]
    both = frame.dropna()
    assert got == pytest.approx(both["a"].rank().corr(both["b"].rank()), abs=1e-12)
