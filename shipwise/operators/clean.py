"""Cleaning step: drop fixed columns, cancelled rows and rows with trivial nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop the columns that are present (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def not_cancelled(df: DataFrame, status_col: str = "delivery_status",
                  cancelled: str = C.CANCELLED_STATUS) -> DataFrame:
    """Keep rows whose status is not 'cancelled'; a missing status is kept.

    ``status != x`` would drop NULL rows in SQL, so the test is null-safe.
    """
    return df.filter(~F.col(status_col).eqNullSafe(F.lit(cancelled)))


def drop_null_rows(df: DataFrame, subset) -> DataFrame:
    return df.na.drop("any", subset=[c for c in subset if c in df.columns])


def clean(df: DataFrame) -> DataFrame:
    """The whole cleaning step as one lazy plan (filters reach the scan side)."""
    df = drop_columns(df, C.CLEAN_DROP_COLS)
    df = not_cancelled(df)
    return drop_null_rows(df, C.CLEAN_NOT_NULL_COLS)
