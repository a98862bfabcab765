"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query reads the test tables through the derived ``shipments`` view and
runs on whole tables. The stages they share (clean → split → score →
options → allocation) are plain functions on DataFrames; rows that several
stages read are landed once, and Catalyst optimises what lies between.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import round_half_up
from ..operators import board, bundle, clean as cl, features as fe, metrics as me
from ..operators import profile as pr, rates as ra, ranking as rk, scoring as sc
from ..operators.core import improve
from ..operators.loop import calibration_by_key, closed_loop_calibration
from ..operators.prescribe import (rejected_counts, batch_summary, build_options, derived_budgets,
                                   flat_records, prescribe)
from ..session import ensure_checkpoint_dir, materialize
from ..sources import orders_csv
from ..sources.files import remove_path
from ..sources.tables import shipments

DATE_COLS = ("order_date", "shipping_date")


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in DATE_COLS if c in df.columns})


# ---- shared stages --------------------------------------------------------

def cleaned(spark, d) -> DataFrame:
    return cl.clean(shipments(spark, d))


def split(spark, d, *columns: str, folds: bool = True) -> DataFrame:
    """The split rows with only the columns named (all, if none is)."""
    rows = cleaned(spark, d)
    return rk.stratified_split(rows.select(*columns) if columns else rows, folds=folds)


# what scoring and the prescription queries read of the orders
SCORING_COLS = ("row_key", "order_id", C.TARGET_COL, *sc.CELL_KEYS, "order_country", "price", "profit")


def scored_test(spark, d) -> DataFrame:
    return sc.score_with_cells(split(spark, d, *SCORING_COLS, folds=False))


def batched(spark, d) -> DataFrame:
    return scored_test(spark, d).withColumn("batch_id", F.col("order_country"))


def prescribed(spark, d, two_option: bool = False):
    return prescribe(batched(spark, d), two_option=two_option)


def prescribed_with_capacity(spark, d):
    """Budget plus upgrade slots per batch (the README's capacity limit)."""
    return prescribe(batched(spark, d), capacities="derived")


def records(spark, d) -> DataFrame:
    return flat_records(prescribed(spark, d)["decisions"])


def sample_batch(spark, d, n: int = C.DEFAULT_BATCH_ORDERS, seed: int = C.DEFAULT_SAMPLE_SEED,
                 budget: float = C.DEFAULT_BUDGET):
    """The reference's entry point: n test orders sampled by seed, one budget."""
    sample = rk.sample_orders(materialize(scored_test(spark, d)), n, seed).withColumn("batch_id", F.lit("sample"))
    budgets = spark.range(1).select(F.lit("sample").alias("batch_id"),
                                    F.lit(budget).alias("budget"))
    return sample, budgets


def sample_batch_prescription(spark, d, **settings):
    sample, budgets = sample_batch(spark, d, **settings)
    return prescribe(sample, budgets=budgets)


# ---- queries --------------------------------------------------------------

def q_scan_shipments(spark, d):
    return _dates_as_text(shipments(spark, d))


def q_clean_shipments(spark, d):
    return _dates_as_text(cleaned(spark, d))


def q_audit_nulls(spark, d):
    return pr.audit_nulls(shipments(spark, d))


def q_target_share(spark, d):
    return pr.class_share(shipments(spark, d), C.TARGET_COL)


def q_column_types(spark, d):
    """Shape, type and nulls of every column, and how many columns share its type."""
    return pr.column_profile(shipments(spark, d)).drop("approx_distinct")


def q_status_counts(spark, d):
    return pr.value_counts(shipments(spark, d), "delivery_status")


def q_profile_columns(spark, d):
    return pr.column_profile(shipments(spark, d))


def q_column_redundancy(spark, d):
    return pr.column_redundancy(cleaned(spark, d), "shipping_mode", "days_scheduled")


def q_delay_rate_by_mode(spark, d):
    return ra.shipping_mode_delay_rate(cleaned(spark, d))


def q_delay_rate_by_region(spark, d):
    return ra.region_delay_rate(cleaned(spark, d))


def q_delay_rate_by_category(spark, d):
    return ra.category_delay_rate(cleaned(spark, d))


def q_delay_rate_by_scheduled(spark, d):
    return ra.scheduled_delay_rate(cleaned(spark, d))


def q_date_features(spark, d):
    return fe.add_date_features(cleaned(spark, d)).select(
        "row_key", "order_month", "order_dayofweek", "order_quarter", "order_is_weekend")


def q_label_dictionary(spark, d):
    return fe.fit_dictionary(cleaned(spark, d), C.CATEGORICAL_COLS)


def q_feature_set(spark, d):
    return fe.build_feature_set(cleaned(spark, d))


def q_encode_leftover(spark, d):
    return fe.encode_leftover_text(fe.build_feature_set(cleaned(spark, d)))


def q_encode_unseen(spark, d):
    s = split(spark, d, "row_key", C.TARGET_COL, *C.CATEGORICAL_COLS, folds=False)
    dictionary = materialize(fe.fit_dictionary(s.filter(F.col("split") == "train"), C.CATEGORICAL_COLS))
    test = fe.apply_dictionary(s.filter(F.col("split") == "test"), dictionary, C.CATEGORICAL_COLS)
    return fe.unseen_counts(test, C.CATEGORICAL_COLS)


def q_encode_saved(spark, d):
    """New orders (the test rows) encoded with a dictionary that was saved and loaded again."""
    s = split(spark, d, folds=False)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bundles/{uuid.uuid4().hex}"
    bundle.save(bundle.fit_encoding(s.filter(F.col("split") == "train")), path)
    saved = bundle.load(spark, path)
    out = bundle.encode(s.filter(F.col("split") == "test"), saved)
    return out.select("row_key", *saved.text_columns, "order_month", "order_dayofweek", "order_quarter", "order_is_weekend")


def q_stratified_split(spark, d):
    return split(spark, d, "row_key", C.TARGET_COL).select("row_key", C.TARGET_COL, "split", "fold")


def q_split_balance(spark, d):
    return pr.class_share(split(spark, d, "row_key", C.TARGET_COL, folds=False).filter(F.col("split") == "train"), C.TARGET_COL)


def q_stratified_folds(spark, d):
    return (split(spark, d, "row_key", C.TARGET_COL).filter(F.col("split") == "train")
            .groupBy("fold", C.TARGET_COL).agg(F.count(F.lit(1)).alias("n")))


def q_sample_batch(spark, d):
    wanted = ("row_key", "order_id", "shipping_mode", "price", "profit")
    test = split(spark, d, *wanted, C.TARGET_COL, folds=False).filter(F.col("split") == "test")
    return rk.sample_orders(test).select(*wanted)


def q_cell_scores(spark, d):
    return scored_test(spark, d).select("row_key", C.TARGET_COL,
                                        round_half_up("risk_score", 6).alias("risk_score"))


def _predicted(spark, d):
    return me.predict_at(scored_test(spark, d))


def q_metrics_accuracy_f1(spark, d):
    return me.accuracy_f1(_predicted(spark, d))


def q_metrics_auc(spark, d):
    return me.roc_auc(scored_test(spark, d))


def q_confusion_matrix(spark, d):
    return me.confusion_matrix(_predicted(spark, d))


def q_classification_report(spark, d):
    return me.classification_report(_predicted(spark, d))


def q_option_costs(spark, d):
    o = build_options(batched(spark, d))
    return o.select("row_key", "batch_id", round_half_up("risk_score", 6).alias("risk_score"),
                    F.col("upgrade_cost").cast("double").alias("upgrade_cost"),
                    F.col("discount_cost").cast("double").alias("discount_cost"),
                    round_half_up("value_at_risk", 6).alias("value_at_risk"),
                    round_half_up("base_expected_loss", 6).alias("base_expected_loss"))


def q_batch_budgets(spark, d):
    b = derived_budgets(build_options(batched(spark, d)))
    return b.select("batch_id", F.col("budget").cast("double").alias("budget"))


def q_rejected_orders(spark, d):
    return rejected_counts(build_options(batched(spark, d)))


def q_allocate_two_option(spark, d):
    dec = prescribed(spark, d, two_option=True)["decisions"]
    return dec.select("row_key", "batch_id",
                      (F.col("decision") == "upgrade").cast("int").alias("upgrade_decision"),
                      F.col("cost").cast("double").alias("cost"))


def q_upgrade_summary(spark, d):
    out = prescribed(spark, d, two_option=True)
    s = batch_summary(out["decisions"], out["budgets"])
    return s.select("batch_id", "budget", F.col("total_cost").alias("spent"),
                    F.col("expected_loss_before").alias("loss_before"),
                    F.col("expected_loss_after").alias("loss_after"),
                    F.col("n_upgrade").alias("n_upgraded"), "loss_reduction_pct")


def q_allocate_multi_option(spark, d):
    dec = prescribed(spark, d)["decisions"]
    return dec.select("row_key", "batch_id", "decision",
                      F.col("cost").cast("double").alias("cost"),
                      round_half_up("expected_loss_after", 6).alias("expected_loss_after"))


def q_multi_option_summary(spark, d):
    dec = prescribed(spark, d)["decisions"]
    agg = dec.groupBy("batch_id").agg(
        F.sum(F.when(F.col("decision") == "upgrade", F.col("cost"))).cast("double").alias("upgrade_spend"),
        F.sum(F.when(F.col("decision") == "discount", F.col("cost"))).cast("double").alias("discount_spend"),
        F.sum("cost").cast("double").alias("total_cost"),
        # decimals: sums of doubles depend on the order of their rows
        F.sum(F.col("base_expected_loss").cast("decimal(28,10)")).cast("double").alias("__before"),
        F.sum(F.col("expected_loss_after").cast("decimal(28,10)")).cast("double").alias("__after"))
    return agg.select(
        "batch_id", "upgrade_spend", "discount_spend", "total_cost",
        round_half_up("__before", 2).alias("loss_before"),
        round_half_up("__after", 2).alias("loss_after"),
        round_half_up(F.try_divide((F.col("__before") - F.col("__after")) * F.lit(100.0),
                                   F.col("__before")), 1).alias("loss_reduction_pct"))


def _optimal_rows(scored, budgets=None, two_option=False):
    """Per batch the greedy saving, the best one and its bound; whether it is proven and paid for."""
    greedy = prescribe(scored, budgets=budgets, two_option=two_option)
    decisions, report = improve(greedy["decisions"], greedy["report"], two_option=two_option)
    spent = decisions.groupBy("batch_id").agg(F.sum("cost").alias("cost"))
    return (report.join(greedy["report"].select("batch_id", F.col("saving").alias("greedy")), "batch_id")
            .join(spent, "batch_id")
            .select("batch_id", F.col("budget").cast("double").alias("budget"),
                    round_half_up("lp_bound", 4).alias("lp_bound"),
                    round_half_up("greedy", 4).alias("greedy_saving"),
                    round_half_up("saving", 4).alias("best_saving"), "optimal",
                    ((F.col("cost") <= F.col("budget")) & (F.col("cost") == F.col("spent"))).alias("within_budget")))


def q_optimal_choice(spark, d):
    return _optimal_rows(batched(spark, d))


def q_optimal_two_option(spark, d):
    return _optimal_rows(batched(spark, d), two_option=True)


def q_optimal_sample_batch(spark, d):
    """The reference's entry point, solved exactly as there."""
    return _optimal_rows(*sample_batch(spark, d))


def q_allocate_with_capacity(spark, d):
    dec = prescribed_with_capacity(spark, d)["decisions"]
    return dec.select("row_key", "batch_id", "decision",
                      F.col("cost").cast("double").alias("cost"),
                      round_half_up("expected_loss_after", 6).alias("expected_loss_after"))


def q_capacity_summary(spark, d):
    out = prescribed_with_capacity(spark, d)
    s = batch_summary(out["decisions"], out["budgets"], out["report"])
    return s.join(out["capacities"], "batch_id", "left")


def q_prescription_records(spark, d):
    return records(spark, d)


def q_prescription_summary(spark, d):
    out = prescribed(spark, d)
    return batch_summary(out["decisions"], out["budgets"], out["report"])


def q_prescribe_end_to_end(spark, d):
    out = sample_batch_prescription(spark, d)
    return batch_summary(out["decisions"], out["budgets"], out["report"])


def q_sample_batch_records(spark, d):
    return flat_records(sample_batch_prescription(spark, d)["decisions"])


def q_top_risk_decisions(spark, d):
    r = records(spark, d)
    return (r.orderBy(F.desc("risk_score"), F.asc("row_key")).limit(C.TOP_N_ORDERS)
            .select("row_key", "risk_score", "value_at_risk", "upgrade_cost", "discount_cost",
                    "decision"))


def q_decision_counts(spark, d):
    return pr.value_counts(prescribed(spark, d)["decisions"], "decision")


def q_board_view(spark, d):
    return board.board_view(records(spark, d))


def q_board_money(spark, d):
    """Money as a card shows it: value at risk, cost and what the order is expected to lose still."""
    return records(spark, d).select("row_key", "batch_id", board.money_text("value_at_risk").alias("value_text"),
                                    board.money_text("cost").alias("cost_text"),
                                    board.money_text("expected_loss_after").alias("loss_text"),
                                    board.money_text("cost", 0).alias("cost_whole_text"))


def q_board_filtered(spark, d):
    return board.board_filter(records(spark, d), "discount").select(
        "row_key", "batch_id", "risk_score", "decision", "cost")


def q_board_counts(spark, d):
    return board.board_counts(records(spark, d))


def q_budget_usage(spark, d):
    out = prescribed(spark, d)
    s = batch_summary(out["decisions"], out["budgets"])
    u = board.budget_usage(s)
    return u.select("batch_id", "total_cost", "budget",
                    round_half_up("budget_used_pct", 6).alias("budget_used_pct"),
                    round_half_up("budget_bar_pct", 6).alias("budget_bar_pct"))


def q_option_ledger(spark, d):
    return board.option_ledger(records(spark, d))


def q_closed_loop_calibration(spark, d):
    return closed_loop_calibration(prescribed(spark, d)["decisions"])


def q_closed_loop_by_key(spark, d):
    """Outcomes reported apart (orders whose delivery status is known), joined to the prescriptions by key.
    Both come from the view, which is landed once; of columns that must not be null, only whether they are."""
    known = [F.when(F.col(c).isNotNull(), F.lit("")).alias(c) for c in C.CLEAN_NOT_NULL_COLS]
    view = materialize(shipments(spark, d).select(*SCORING_COLS, "shipping_date", "delivery_status", *known), "zstd")
    deliveries = (view.filter(F.col("delivery_status").isNotNull())
                  .select("row_key", F.col("shipping_date").alias("delivered_at"), C.TARGET_COL))
    rows = rk.stratified_split(cl.clean(view).select(*SCORING_COLS), folds=False, landed=True)
    scored = sc.score_with_cells(rows).withColumn("batch_id", F.col("order_country"))
    return calibration_by_key(materialize(prescribe(scored)["decisions"], "zstd"), deliveries)


def _through_csv(spark, file_columns: DataFrame):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv/{uuid.uuid4().hex}"
    orders_csv.write_csv(file_columns, path, compression="gzip")  # 53 columns of text, read once
    found = orders_csv.intake(spark, path)
    remove_path(spark, path)  # the intake has landed its rows
    return found


def q_csv_shipments(spark, d):
    """Every order item exported as the reference's CSV and taken in again."""
    view = shipments(spark, d)
    return _dates_as_text(_through_csv(spark, orders_csv.as_file_columns(view)).rows.select(*view.columns))


def q_csv_quarantine(spark, d):
    """The same file with damaged prices (every 50th order) and dates (every 40th): rows set aside by reason."""
    order, price, date = F.col("Order Id").cast("bigint"), "Order Item Product Price", "order date (DateOrders)"
    damaged = orders_csv.as_file_columns(shipments(spark, d)).withColumns({
        price: F.when(order % 50 == 7, F.concat(F.lit("EUR "), F.col(price))).otherwise(F.col(price)),
        date: F.when(order % 40 == 3, F.lit("unknown")).otherwise(F.col(date))})
    found = _through_csv(spark, damaged)
    total = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("reason"), "n")
    return (found.reasons().unionByName(total(found.rows, "(accepted)"))
            .unionByName(total(found.quarantine, "(set aside)")))


def _model_queries():
    from ..operators import model as mo
    return {
        "train_delay_model": mo.q_train_delay_model,
        "feature_importance": mo.q_feature_importance,
        "model_comparison": mo.q_model_comparison,
        "tune_delay_model": mo.q_tune_delay_model,
        "score_batch": mo.q_score_batch,
        "baseline_vs_tuned": mo.q_baseline_vs_tuned,
        "model_prescription_summary": mo.q_model_prescription_summary,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    qs = {name[2:]: fn for name, fn in globals().items()
          if name.startswith("q_") and callable(fn)}
    qs.update(_model_queries())
    return qs
