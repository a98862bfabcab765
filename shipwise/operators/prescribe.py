"""Prescription: option costs, budgets, records and per-batch summaries.

Money that is summed is DECIMAL (exact); record values are rounded half-up
to cents as BIGINT and summed as integers, so a summary equals the sum of
the records it describes (the reference sums rounded records).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import cents_to_money, clip_lower, round_half_up, to_cents
from ..session import materialize
from .allocate import MONEY, allocate_best
from .core import improve


def build_options(scored: DataFrame, params: C.PrescriptionParams = C.PARAMS,
                  risk_col: str = "risk_score") -> DataFrame:
    """Cost and loss columns for the three options (narrow projection)."""
    price = F.col("price").cast("decimal(18,2)")
    return scored.withColumns({
        "upgrade_cost": (clip_lower(price, 0) * F.lit(Decimal(params.upgrade_rate))).cast(MONEY),
        "discount_cost": F.lit(Decimal(params.voucher_cost)).cast(MONEY),
        "value_at_risk": F.abs(F.col("profit")),
        "base_expected_loss": F.col(risk_col) * F.abs(F.col("profit")),
    })


def split_rejected(options: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rows with a missing or NaN price, profit or risk are
    not guessed at; they go to a separate output."""
    bad = _rejects()
    return options.filter(~bad), options.filter(bad)


def _rejects():
    return (F.col("upgrade_cost").isNull() | F.col("base_expected_loss").isNull()
            | F.isnan("base_expected_loss"))


def rejected_counts(options: DataFrame, part: str = "batch_id") -> DataFrame:
    """Per batch: orders, and how many of them ``split_rejected`` sets aside."""
    return options.groupBy(part).agg(F.count(F.lit(1)).alias("n_orders"),
                                     F.count_if(_rejects()).alias("n_rejected"))


def derived_budgets(options: DataFrame, part: str = "batch_id",
                    share: Decimal = C.BUDGET_SHARE) -> DataFrame:
    """Budget per batch = floor(share × full upgrade cost of the batch)."""
    return (options.groupBy(part)
            .agg(F.floor(F.sum("upgrade_cost") * F.lit(share)).cast(MONEY).alias("budget")))


def derived_capacities(options: DataFrame, part: str = "batch_id",
                       num: int = C.UPGRADE_SLOTS_NUM, den: int = C.UPGRADE_SLOTS_DEN) -> DataFrame:
    """Upgrade slots per batch = floor(orders × num / den) (exact integers)."""
    return (options.groupBy(part)
            .agg((F.count(F.lit(1)) * F.lit(num) / F.lit(den)).cast("bigint").alias("max_upgrades")))


def record_columns(decisions: DataFrame, params: C.PrescriptionParams = C.PARAMS) -> DataFrame:
    """Rounded per-order record values, flat (cents kept for exact sums)."""
    r = float(params.voucher_reduction)
    L = F.col("base_expected_loss")
    loss_disc = L * F.lit(1.0 - r)
    return decisions.withColumns({
        "__cost_c": to_cents("cost"),
        "__before_c": to_cents(L),
        "__after_c": to_cents("expected_loss_after"),
        "__up_c": to_cents("upgrade_cost"),
        "__disc_c": to_cents("discount_cost"),
        "__disc_loss_c": to_cents(loss_disc),
    }).withColumns({
        "risk_score_r": round_half_up("risk_score", 4),
        "value_at_risk_r": round_half_up("value_at_risk", 2),
        "cost_r": cents_to_money("__cost_c"),
        "expected_loss_before_r": cents_to_money("__before_c"),
        "expected_loss_after_r": cents_to_money("__after_c"),
        "upgrade_cost_r": cents_to_money("__up_c"),
        "discount_cost_r": cents_to_money("__disc_c"),
        "discount_loss_after_r": cents_to_money("__disc_loss_c"),
    })


def flat_records(decisions: DataFrame, key: str = "row_key", part: str = "batch_id") -> DataFrame:
    rec = record_columns(decisions)
    return rec.select(
        key, part, F.col("order_id"),
        F.col("risk_score_r").alias("risk_score"),
        F.col("value_at_risk_r").alias("value_at_risk"),
        "decision",
        F.col("cost_r").alias("cost"),
        F.col("expected_loss_before_r").alias("expected_loss_before"),
        F.col("expected_loss_after_r").alias("expected_loss_after"),
        F.col("upgrade_cost_r").alias("upgrade_cost"),
        F.lit(0.0).alias("upgrade_loss_after"),
        F.col("discount_cost_r").alias("discount_cost"),
        F.col("discount_loss_after_r").alias("discount_loss_after"),
        F.lit(0.0).alias("nothing_cost"),
        F.col("expected_loss_before_r").alias("nothing_loss_after"))


def nested_records(flat: DataFrame, key: str = "row_key", part: str = "batch_id") -> DataFrame:
    """The reference's per-order document as a nested struct column."""
    def opt(cost, loss):
        return F.struct(F.col(cost).alias("cost"), F.col(loss).alias("expected_loss_after"))

    return flat.select(part, F.struct(
        F.col(key).alias("row_key"), "order_id", "risk_score", "value_at_risk", "decision", "cost",
        "expected_loss_before", "expected_loss_after",
        F.struct(opt("upgrade_cost", "upgrade_loss_after").alias("upgrade"),
                 opt("discount_cost", "discount_loss_after").alias("discount"),
                 opt("nothing_cost", "nothing_loss_after").alias("nothing")).alias("options"),
    ).alias("order"))


def batch_summary(decisions: DataFrame, budgets: DataFrame, report: DataFrame | None = None,
                  part: str = "batch_id") -> DataFrame:
    """Per batch: size, budget, totals of the rounded records, reduction %,
    dense decision counts, exact cost and (when given) lp_bound and gap."""
    rec = record_columns(decisions)
    agg = rec.groupBy(part).agg(
        F.count(F.lit(1)).alias("batch_size"),
        F.sum("__cost_c").alias("__cost_c"),
        F.sum("__before_c").alias("__before_c"),
        F.sum("__after_c").alias("__after_c"),
        F.sum("cost").alias("__cost_exact"),
        *[F.count_if(F.col("decision") == o).alias(f"n_{o}") for o in C.OPTIONS])
    out = agg.join(budgets.select(part, "budget"), part, "left").select(
        part, "batch_size",
        F.col("budget").cast("double").alias("budget"),
        cents_to_money("__cost_c").alias("total_cost"),
        cents_to_money("__before_c").alias("expected_loss_before"),
        cents_to_money("__after_c").alias("expected_loss_after"),
        round_half_up(F.try_divide(((F.col("__before_c") - F.col("__after_c")) * 100).cast("double"),
                                   F.col("__before_c").cast("double")), 1).alias("loss_reduction_pct"),
        *[F.col(f"n_{o}") for o in C.OPTIONS],
        F.col("__cost_exact").cast("double").alias("total_cost_exact"))
    if report is not None:
        out = out.join(report.select(part, round_half_up("lp_bound", 2).alias("lp_bound_saving"),
                                     round_half_up("saving", 2).alias("achieved_saving"),
                                     round_half_up("gap", 2).alias("gap")), part, "left")
    return out


def nested_summary(summary: DataFrame, part: str = "batch_id") -> DataFrame:
    return summary.select(part, F.struct(
        "batch_size", "budget", "total_cost", "expected_loss_before", "expected_loss_after",
        "loss_reduction_pct",
        F.struct(*[F.col(f"n_{o}").alias(o) for o in C.OPTIONS]).alias("decision_counts"),
    ).alias("summary"))


def prescribe(scored: DataFrame, budgets: DataFrame | None = None, part: str = "batch_id",
              two_option: bool = False, fill_rounds: int | None = None,
              params: C.PrescriptionParams = C.PARAMS, capacities: DataFrame | str | None = None,
              exact: bool = False):
    """Scored orders → options → allocation. Returns a dict of DataFrames:
    decisions, report (per batch lp bound / gap), budgets, rejected.
    ``capacities`` (part, max_upgrades) adds the upgrade-slot limit;
    ``"derived"`` derives it from the valid orders like the budgets.
    ``exact`` improves the choice to the optimum (``core.improve``); the report
    then says which batches are proven ``optimal``. It knows no slot limit."""
    if exact and capacities is not None:
        raise ValueError("the exact choice knows no slot limit")
    options = build_options(scored, params)
    valid, rejected = split_rejected(options)
    if budgets is None:
        budgets = materialize(derived_budgets(valid, part))  # the allocation and the summaries read them
    if isinstance(capacities, str):
        if capacities != "derived":
            raise ValueError(f"unknown capacities: {capacities}")
        capacities = derived_capacities(valid, part)
    decisions, report = allocate_best(valid, budgets, part, params, two_option, fill_rounds,
                                      capacities=capacities)
    if exact:
        decisions, report = improve(decisions, report, part, params, two_option)
    return {"decisions": decisions, "report": report, "budgets": budgets, "rejected": rejected,
            "capacities": capacities}
