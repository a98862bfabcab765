"""Deterministic cell scorer: a smoothed late rate per (shipping mode, category).

It stands in for the trained model wherever results must be checkable
against SQL (metrics, prescriptions): risk = (late + w·p0) / (n + w) per cell
of the training rows, p0 = overall training late rate; cells not seen in
training get p0. The cell table is bounded by the product of the two
cardinalities and is broadcast only after a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .ranking import bounded_broadcast

CELL_KEYS = ("shipping_mode", "category_name")


def fit_cell_scorer(train: DataFrame, label: str = C.TARGET_COL, keys=CELL_KEYS,
                    weight: float = C.SCORER_PRIOR_WEIGHT) -> tuple[DataFrame, DataFrame]:
    """Returns (cells(keys…, risk_score), prior(p0)) as small DataFrames."""
    keys = list(keys)
    prior = train.agg(F.avg(F.col(label)).alias("p0"))
    cells = (train.groupBy(*keys)
             .agg(F.sum(label).alias("__late"), F.count(F.lit(1)).alias("__n"))
             .crossJoin(F.broadcast(prior))
             .select(*keys, ((F.col("__late").cast("double") + F.lit(weight) * F.col("p0"))
                             / (F.col("__n").cast("double") + F.lit(weight))).alias("risk_score")))
    return cells, prior


def apply_cell_scorer(df: DataFrame, cells: DataFrame, prior: DataFrame,
                      keys=CELL_KEYS, out_col: str = "risk_score") -> DataFrame:
    """Null-safe join on the cell keys; unseen cells get the prior."""
    keys = list(keys)
    c = cells.select(*[F.col(k).alias(f"__c_{k}") for k in keys],
                     F.col("risk_score").alias("__cell_risk"))
    c = bounded_broadcast(c)
    cond = None
    for k in keys:
        e = df[k].eqNullSafe(c[f"__c_{k}"])
        cond = e if cond is None else cond & e
    out = (df.join(c, cond, "left")
           .crossJoin(F.broadcast(prior))
           .withColumn(out_col, F.coalesce(F.col("__cell_risk"), F.col("p0"))))
    return out.drop(*[f"__c_{k}" for k in keys], "__cell_risk", "p0")


def score_with_cells(split_df: DataFrame) -> DataFrame:
    """Fit on split='train', score the split='test' rows."""
    cells, prior = fit_cell_scorer(split_df.filter(F.col("split") == "train"))
    return apply_cell_scorer(split_df.filter(F.col("split") == "test"), cells, prior)
