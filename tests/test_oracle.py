"""Engine vs DuckDB SQL on the smallest test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF001
from tests.oracle_harness import compare, duck_connect

FAST = ["scan_shipments", "audit_nulls", "target_share", "delay_rate_by_mode",
        "delay_rate_by_category", "column_redundancy", "label_dictionary", "feature_set",
        "stratified_split", "sample_batch", "metrics_auc", "classification_report",
        "allocate_two_option", "prescription_summary", "prescribe_end_to_end", "option_ledger",
        "closed_loop_calibration", "capacity_summary", "optimal_choice",
        "closed_loop_by_key", "csv_shipments", "csv_quarantine"]


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF001)


def test_every_sql_query_is_registered():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(queries()[name](spark, SF001), con, oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "loss_reduction_pct" in df.columns
