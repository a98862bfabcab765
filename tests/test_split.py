"""The split without folds, and the facts that only the landed rows can give."""

import pytest
from pyspark.sql import functions as F

from shipwise.operators import ranking as rk
from shipwise.plans import catalog as c
from tests.conftest import SF001


def _parts(df, key):
    return {(r[key], r["split"]) for r in df.select(key, "split").collect()}


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_same_rows_with_and_without_folds(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    whole = rk.stratified_split(df, "y", "k")
    narrow = rk.stratified_split(df, "y", "k", folds=False)
    assert _parts(narrow, "k") == _parts(whole, "k") and narrow.count() == n
    assert narrow.columns == ["k", "y", "split"]


def test_no_rows_and_rows_without_a_label(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("c", 1)], "k string, y int")
    assert {k for k, _ in _parts(rk.stratified_split(df, "y", "k", folds=False), "k")} == {"b", "c"}
    for folds in (True, False):
        assert rk.stratified_split(df.filter("y = 7"), "y", "k", folds=folds).count() == 0


def test_engine_split_without_folds(spark):
    cols = ("row_key", "late_delivery_risk")
    assert _parts(c.split(spark, SF001, *cols), "row_key") == _parts(c.split(spark, SF001, *cols, folds=False), "row_key")


def test_split_reads_landed_rows_and_shuffles_nothing(spark):
    plan = c.split(spark, SF001, *c.SCORING_COLS, folds=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "lineitem" not in plan
