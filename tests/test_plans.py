"""Physical plans: pushed filters, narrow scans, reused shuffles, no pair-forming joins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (loads the catalog)
from daymark.operators import audit, history, scoring, sets
from daymark.plans import bindings as b
from daymark.plans.registry import QUERIES

# These run jobs of their own while the query is built.
EAGER = ("r", "s", "m7", "m8", "m10", "m11", "m12", "m13", "m14_blend_models", "m15", "m16", "m17", "m18", "m19", "m25")
LAZY = sorted(n for n in QUERIES if not n.startswith(EAGER) and not n.startswith("op") and n != "pipeline")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_query_forms_pairs_or_runs_row_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name != "x5_holiday_table_function":  # the table function itself is Python
        assert "BatchEvalPython" not in text


def test_year_filter_reaches_the_scan(spark, small):
    text = plan(audit.in_year(b.table(spark, small, "orders"), 1997, "o_orderdate").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_daily_counts_read_one_column_and_combine_before_the_shuffle(spark, small):
    text = plan(audit.daily_counts(b.table(spark, small, "lineitem"), "l_shipdate"))
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in text
    assert "partial_count" in text and text.count("Exchange hashpartitioning") == 1


def test_feature_frame_sorts_once(spark, small):
    text = plan(history.feature_frame(b.daily_shipments(spark, small)))
    assert text.count("Exchange ") == 2  # one for the daily counts, one for the series


def test_table_equality_takes_one_wide_shuffle(spark, small):
    a = b.daily_orders(spark, small)
    text = plan(sets.differences(a, a))
    assert text.count("Exchange hashpartitioning") <= 3  # at most the two daily counts and the comparison


def test_scores_are_shuffled_once(spark, small):
    df = scoring.ranking_metrics(b.scored(spark, small))
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_top_per_group_is_cut_before_the_shuffle(spark):
    from daymark.operators.joins import top_per_group

    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert plan(top_per_group(df, ["k"], [F.col("id")], 2)).count("WindowGroupLimit") >= 2
