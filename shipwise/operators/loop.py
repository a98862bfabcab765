"""Closed loop: compare predicted risk and prescribed loss with what happened.

Groups prescriptions by decision and risk decile (an aggregate bounded by
3 × 10 groups, partial-aggregated before the shuffle). Outcomes come with the
prescriptions, or later and apart, joined by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import cents_to_money, round_half_up, to_cents


def _decile():
    return F.least(F.lit(9), F.floor(F.col("risk_score") * F.lit(10.0)).cast("int"))


def join_outcomes(prescriptions: DataFrame, deliveries: DataFrame, key: str = "row_key",
                  label: str = C.TARGET_COL, at: str = "delivered_at") -> DataFrame:
    """Every prescription once, with the label of its last delivery (null while there is none).

    Deliveries without a label or key say nothing; of several for one key the latest counts, of
    equal times the late one. Deliveries that nobody prescribed for are left out. A label column of
    the prescriptions themselves is dropped, so it cannot leak in.
    """
    last = (deliveries.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
            .groupBy(key).agg(F.max(F.struct(F.col(at), F.col(label))).alias("__last")))
    return (prescriptions.drop(label).join(last, key, "left")
            .withColumn(label, F.col(f"__last.{label}")).drop("__last"))


def calibration_by_key(prescriptions: DataFrame, deliveries: DataFrame, key: str = "row_key",
                       label: str = C.TARGET_COL, at: str = "delivered_at",
                       params: C.PrescriptionParams = C.PARAMS) -> DataFrame:
    """``closed_loop_calibration`` of the orders with an outcome, and per group how many still wait."""
    joined = join_outcomes(prescriptions, deliveries, key, label, at).withColumn("risk_decile", _decile())
    groups = joined.groupBy("decision", "risk_decile").agg(F.count_if(F.col(label).isNull()).alias("n_open"))
    known = closed_loop_calibration(joined.filter(F.col(label).isNotNull()), label, params)
    return (groups.join(known, ["decision", "risk_decile"], "left")
            .withColumn("n_orders", F.coalesce("n_orders", F.lit(0).cast("bigint"))))


def closed_loop_calibration(decisions: DataFrame, label: str = C.TARGET_COL,
                            params: C.PrescriptionParams = C.PARAMS) -> DataFrame:
    r = float(params.voucher_reduction)
    late = F.col(label)
    v = F.col("value_at_risk")
    realised = (F.when(F.col("decision") == "upgrade", F.lit(0.0))
                .when(F.col("decision") == "discount", v * late.cast("double") * F.lit(1.0 - r))
                .otherwise(v * late.cast("double")))
    sq_err = (F.col("risk_score") - late.cast("double")) * (F.col("risk_score") - late.cast("double"))
    return (decisions.withColumns({"risk_decile": _decile(), "__exp_c": to_cents("expected_loss_after"),
                                   "__real_c": to_cents(realised), "__sq": sq_err})
            .groupBy("decision", "risk_decile")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.avg("risk_score").alias("__risk"),
                 F.avg(late.cast("double")).alias("__late"),
                 F.sum("__exp_c").alias("__exp_c"),
                 F.sum("__real_c").alias("__real_c"),
                 F.avg("__sq").alias("__brier"))
            .select("decision", "risk_decile", "n_orders",
                    round_half_up("__risk", 6).alias("mean_predicted_risk"),
                    round_half_up("__late", 6).alias("observed_late_rate"),
                    cents_to_money("__exp_c").alias("expected_loss_after"),
                    cents_to_money("__real_c").alias("realised_loss_after"),
                    round_half_up("__brier", 6).alias("brier_score")))
