"""Board projections: what the reference's browser board shows, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import js_round, pad_label, risk_band


def _label_map(m: dict):
    return F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(v))])


def board_view(records: DataFrame, key: str = "row_key") -> DataFrame:
    """One card per order: label, risk percent and band, decision label;
    ordered by risk (descending) with the key as tie-break."""
    return (records.select(
        key, "batch_id",
        pad_label("order_id", C.ORDER_LABEL_WIDTH).alias("order_label"),
        js_round(F.col("risk_score") * F.lit(100.0)).alias("risk_pct"),
        risk_band("risk_score", C.RISK_BAND_HIGH, C.RISK_BAND_MEDIUM).alias("risk_band"),
        "decision",
        _label_map(C.DECISION_LABELS)[F.col("decision")].alias("decision_label"),
        "value_at_risk", "cost")
        .orderBy(F.desc("risk_score"), F.asc(key)))


def board_filter(records: DataFrame, decision: str = "all") -> DataFrame:
    """The board's decision filter; 'all' passes everything."""
    return records if decision == "all" else records.filter(F.col("decision") == decision)


def board_counts(records: DataFrame) -> DataFrame:
    """Counter per filter button: each option (zeros kept) and 'all'."""
    agg = records.agg(F.count(F.lit(1)).alias("all"),
                      *[F.count_if(F.col("decision") == o).alias(o) for o in C.OPTIONS])
    labels = {**C.DECISION_LABELS, "all": "All"}
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(o).alias("filter"), F.lit(labels[o]).alias("filter_label"),
                 F.col(o).alias("n"))
        for o in ("all",) + C.OPTIONS])).alias("c")).select("c.*")


def budget_usage(summary: DataFrame) -> DataFrame:
    """Budget used in percent, capped at 100 for display (rounded record
    costs can pass the budget by a few cents)."""
    pct = F.lit(100.0) * F.try_divide(F.col("total_cost"), F.col("budget"))
    return summary.select("batch_id", "total_cost", "budget",
                          pct.alias("budget_used_pct"),
                          F.least(F.lit(100.0), pct).alias("budget_bar_pct"))


def option_ledger(records: DataFrame, key: str = "row_key") -> DataFrame:
    """Options as long rows with the chosen flag (the card's ledger)."""
    rows = F.array(*[
        F.struct(F.lit(o).alias("option"), F.lit(C.OPTION_LABELS[o]).alias("option_label"),
                 F.col(f"{o}_cost").alias("option_cost"),
                 F.col(f"{o}_loss_after").alias("option_loss_after"))
        for o in C.OPTIONS])
    return (records.select(key, "batch_id", "decision", F.explode(rows).alias("o"))
            .select(key, "batch_id", "o.*",
                    (F.col("o.option") == F.col("decision")).alias("chosen"))
            .drop("decision"))


def money_text(c, digits: int = 2):
    """``x.toFixed(digits)`` for the board's money text."""
    return F.format_string(f"%.{digits}f", F.col(c) if isinstance(c, str) else c)
