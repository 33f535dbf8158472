"""Shape of the physical plans: shuffles, scans, joins."""

import re

import pytest

import __spark_entry__ as registry
from fleetpulse.operators import features, quality
from fleetpulse.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial(text):
    """The plan before adaptive execution rewrites it."""
    return text.split("== Initial Plan ==")[-1]


def test_features_need_no_shuffle_on_the_stored_table(spark, small):
    text = plan(features.rolling_features(tables.smart_daily(spark, small)))
    assert "Exchange" not in text
    assert len(re.findall(r"- Sort \[", text)) <= 1


def test_features_share_one_shuffle_on_any_other_frame(spark, small):
    text = plan(features.rolling_features(tables.smart_daily_plan(spark, small)))
    assert text.count("hashpartitioning(serial_number") == 1


def test_snapshots_are_read_by_column(spark, small):
    text = plan(registry.queries()["A4_weekday"](spark, small))
    assert "ReadSchema: struct<date:date,failure:int>" in text


def test_failures_are_pushed_down(spark, small):
    text = plan(registry.queries()["P1_recent_failures"](spark, small))
    assert "EqualTo(failure,1)" in text and "TakeOrderedAndProject" in text


def test_outliers_are_one_scan(spark, small):
    text = plan(quality.outliers(tables.smart_daily(spark, small)))
    assert text.count("FileScan") == 1


LAZY = [
    n for n in sorted(registry.queries()) if n.split("_")[0][0] in "APQJORWD" and not n.startswith("W14")
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_products(spark, small, name):
    text = plan(registry.queries()[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_partial_limit_before_the_shuffle_of_copies(spark, small):
    text = initial(plan(tables.smart_daily_plan(spark, small)))
    assert re.search(r"WindowGroupLimit .* Partial", text)
