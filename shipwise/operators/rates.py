"""Delay rate (mean of the 0/1 label) per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import round_half_up


def delay_rate(df: DataFrame, key: str, label: str = C.TARGET_COL,
               top_n: int | None = None, by_key: bool = False,
               digits: int = 6) -> DataFrame:
    """Mean label per non-null key.

    Sorted by rate (descending, key as tie-break) or by key; ``top_n`` keeps
    the first n (planned as TakeOrderedAndProject, no global sort).
    """
    out = (df.filter(F.col(key).isNotNull())
           .groupBy(key)
           .agg(F.avg(F.col(label)).alias("_rate"), F.count(F.lit(1)).alias("n_orders"))
           .select(key, round_half_up("_rate", digits).alias("delay_rate"), "n_orders"))
    out = out.orderBy(F.asc(key)) if by_key else out.orderBy(F.desc("delay_rate"), F.asc(key))
    return out.limit(top_n) if top_n else out


def shipping_mode_delay_rate(df: DataFrame) -> DataFrame:
    return delay_rate(df, "shipping_mode")


def region_delay_rate(df: DataFrame, top_n: int = C.TOP_N_GROUPS) -> DataFrame:
    return delay_rate(df, "order_region", top_n=top_n)


def category_delay_rate(df: DataFrame, top_n: int = C.TOP_N_GROUPS) -> DataFrame:
    return delay_rate(df, "category_name", top_n=top_n)


def scheduled_delay_rate(df: DataFrame) -> DataFrame:
    return delay_rate(df, "days_scheduled", by_key=True)
