"""Budgeted choice of one action per order, for many batches in one job.

Replaces the reference's integer program (one 200-order batch, one budget)
by the linear relaxation of the multiple-choice knapsack solved by sorting
(Dantzig 1957; Sinha & Zoltners 1979), repaired to whole decisions:

1. Each order with loss L > 0 becomes 1–2 *incremental steps* along its
   efficient frontier: upgrade cost u ≤ d/r → one step "upgrade"
   (Δcost u, Δsaving L); otherwise step 1 "discount" (d, r·L) and step 2
   "discount→upgrade" (u−d, (1−r)·L). Free steps (Δcost 0) come first.
2. Steps are ordered per batch by ``ord = (paid, -Δsaving/Δcost, row_key,
   step)`` and taken while the running cost stays within the budget
   (``take_until``: one window for normal batches, bucketed for huge ones).
3. Fill: the other steps are gone through in that order, and each is taken
   whose cost fits the remaining budget (and whose predecessor is taken);
   see ``fill.py``.

Per batch this leaves the first blocked step's ``ord`` and a short list of
phases. Whether a step is taken is a pure function of its own ``ord``/cost,
its predecessor's and those, so the final decision per order is one narrow
projection with a broadcast join of the per-batch table — no self-join, no
group-by per order. ``lp_bound`` (the relaxation's optimum) and ``gap`` make
the distance to the optimum visible per batch; ``core.py`` closes it.

``allocate_best`` adds a voucher pass on the money left, and starts a batch
from its best single order where that order alone saves more than the greedy
choice. Without slot limits the result saves at least half the optimum.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import materialize
from .fill import fill, phase_type
from .ranking import bounded_broadcast, take_until

MONEY = "decimal(20,4)"
NO_LIMIT = 2 ** 62


def _ord(paid, neg_eff, key, step) -> Column:
    return F.struct(paid.alias("paid"), neg_eff.alias("neg_eff"),
                    key.alias("row_key"), step.alias("step"))


def _step(act, dc, ds, key, step) -> Column:
    paid = F.when(dc > 0, F.lit(1)).otherwise(F.lit(0))
    neg_eff = F.when(dc > 0, -(ds / dc.cast("double"))).otherwise(F.lit(0.0))
    return F.struct(act.alias("act"), dc.alias("dc"), ds.alias("ds"),
                    _ord(paid, neg_eff, key, F.lit(step)).alias("ord"))


def order_steps(orders: DataFrame, params: C.PrescriptionParams = C.PARAMS,
                two_option: bool = False, key: str = "row_key") -> DataFrame:
    """Adds ``s1``/``s2`` step structs (NULL when absent) to each order.
    With a ``budget`` column, actions dearer than it make no step."""
    u = F.col("upgrade_cost").cast(MONEY)
    d = F.col("discount_cost").cast(MONEY)
    L = F.col("base_expected_loss")
    r = float(params.voucher_reduction)
    switch = (Decimal(params.voucher_cost) / Decimal(str(r)))
    has = L > F.lit(0.0)
    up_ok = disc_ok = F.lit(True)
    if "budget" in orders.columns:
        up_ok = F.coalesce(u <= F.col("budget"), F.lit(True))
        disc_ok = F.coalesce(d <= F.col("budget"), F.lit(True))
    two = F.lit(False) if two_option else ((u > F.lit(switch).cast(MONEY)) | ~up_ok)
    k = F.col(key)
    s1 = F.when(has, F.when(two & disc_ok, _step(F.lit("discount"), d, L * F.lit(r), k, 1))
                .when(~two & up_ok, _step(F.lit("upgrade"), u, L, k, 1)))
    s2 = F.when(has & two & up_ok & disc_ok,
                _step(F.lit("upgrade"), (u - d).cast(MONEY), L * F.lit(1.0 - r), k, 2))
    return orders.withColumns({"s1": s1, "s2": s2})


def _explode_steps(with_steps: DataFrame, part: str) -> DataFrame:
    st = F.explode(F.filter(F.array(
        F.struct(F.col("s1").alias("s"), F.lit(None).cast(with_steps.schema["s1"].dataType).alias("p")),
        F.struct(F.col("s2").alias("s"), F.col("s1").alias("p"))), lambda x: x["s"].isNotNull()))
    return (with_steps.select(part, st.alias("x"))
            .select(part, F.col("x.s.act").alias("act"), F.col("x.s.dc").alias("dc"),
                    F.col("x.s.ds").alias("ds"), F.col("x.s.ord").alias("ord"),
                    F.col("x.p.ord").alias("prev_ord"), F.col("x.p.dc").alias("prev_dc"),
                    _upgrades(F.col("x.s")).alias("du"), _upgrades(F.col("x.p")).alias("prev_du"))
            .withColumn("paid", F.col("ord.paid"))
            .withColumn("neg_eff", F.col("ord.neg_eff")))


def _upgrades(s: Column) -> Column:
    """Upgrade slots a step uses: 1 when it ends in an upgrade (the
    discount→upgrade step too), else 0; NULL for an absent step."""
    return F.when(s.isNotNull(), F.when(s["act"] == "upgrade", F.lit(1)).otherwise(F.lit(0)))


def _taken(o: Column, dc: Column, du: Column) -> Column:
    """Is a step taken, given its batch's ``block`` (first step of the prefix that does not fit) and
    ``phases`` of the fill (see ``fill``) on the same row."""
    block, phases = F.col("block"), F.coalesce("phases", F.array())
    later = F.exists(phases, lambda x: (x["after"].isNull() | (o > x["after"])) & (x["upto"].isNull() | (o <= x["upto"]))
                     & ((dc <= x["half"]) | (o == x["event"])) & (x["slots"] | (du == 0)))
    return block.isNull() | (o < block) | F.coalesce(later, F.lit(False))


def _round_summary(taken: DataFrame, part: str, k: int) -> DataFrame:
    blocked = F.when(~F.col("taken"), F.struct(F.col("ord").alias("o"), F.col("dc").alias("dc"),
                                                F.col("ds").alias("ds")))
    return taken.groupBy(part).agg(
        F.sum(F.when(F.col("taken"), F.col("dc"))).alias(f"spent{k}"),
        F.sum(F.when(F.col("taken"), F.col("ds"))).alias(f"saved{k}"),
        F.sum(F.when(F.col("taken"), F.col("du"))).alias(f"used{k}"),
        F.min(blocked).alias(f"__blk{k}"))


def allocate(orders: DataFrame, budgets: DataFrame, part: str = "batch_id",
             params: C.PrescriptionParams = C.PARAMS, two_option: bool = False,
             fill_rounds: int | None = None, max_window_rows: int | None = None,
             key: str = "row_key", capacities: DataFrame | None = None
             ) -> tuple[DataFrame, DataFrame]:
    """Returns (decisions, batch_report).

    ``orders`` needs part, key, upgrade_cost, discount_cost, base_expected_loss
    (no NULLs: reject those rows before). ``budgets`` needs (part, budget).
    ``capacities`` (optional) needs (part, max_upgrades): a second limit, the
    number of upgrades per batch (NULL or a missing row: no limit).
    decisions = orders + decision, cost, expected_loss_after;
    batch_report = per batch budget, spent, lp_bound, achieved saving, gap and
    break_ratio (saving per cost of the step that ends the prefix, NULL if all fit).
    With capacities, lp_bound is the optimum of the budget-only relaxation,
    still an upper bound of the optimum under both limits. ``fill_rounds=0``
    leaves out the fill.
    """
    capped = capacities is not None
    budgets = budgets.select(part, F.col("budget").cast(MONEY).alias("budget"))
    if budgets.filter(F.col("budget") < 0).limit(1).count():
        raise ValueError("negative budget")
    if capped:
        caps = capacities.select(part, F.col("max_upgrades").cast("bigint").alias("max_upgrades"))
        if caps.filter(F.col("max_upgrades") < 0).limit(1).count():
            raise ValueError("negative capacity")
        budgets = (budgets.join(caps, part, "left")
                   .withColumn("max_upgrades", F.coalesce("max_upgrades", F.lit(NO_LIMIT))))

    budgets_m = materialize(budgets)
    n_batches = budgets_m.count()
    budgets_b = F.broadcast(budgets_m) if n_batches <= C.KNOBS.max_broadcast_rows else budgets_m
    # the order table is read once per round: land it once (lineage cut)
    with_steps = materialize(order_steps(orders.drop("budget").join(
        budgets_b.select(part, "budget"), part, "left"), params, two_option, key).drop("budget"))
    steps = _explode_steps(with_steps, part)  # narrow, re-derived from the landed table
    check = (steps.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
             .join(budgets_b, part, "left")
             .agg(F.max("n").alias("max_rows"), F.count_if(F.col("budget").isNull()).alias("missing"))
             .first())
    if check["missing"]:
        raise ValueError("orders in a batch without a budget row")
    max_rows = check["max_rows"] or 0

    def greedy(cands: DataFrame, cap: str, capu: str | None = None) -> DataFrame:
        ws, cs = (["dc", "du"], [cap, capu]) if capu else ("dc", cap)
        return take_until(cands, [part], "ord", ws, cs, "paid", "neg_eff", "taken",
                          max_window_rows=max_window_rows, max_part_rows=max_rows)

    # greedy prefix over all steps
    t0 = greedy(steps.join(budgets_b, part), "budget", "max_upgrades" if capped else None)
    r0 = _round_summary(t0, part, 0)
    P = (budgets_b.join(r0, part, "left")
         .select(part, "budget", *(["max_upgrades"] if capped else []),
                 F.coalesce("spent0", F.lit(0).cast(MONEY)).alias("spent0"),
                 F.coalesce("saved0", F.lit(0.0)).alias("saved0"),
                 F.coalesce("used0", F.lit(0).cast("bigint")).alias("used0"),
                 F.col("__blk0.o").alias("block"), F.col("__blk0.dc").alias("bdc0"),
                 F.col("__blk0.ds").alias("bds0")))
    P = P.withColumn("rem", F.col("budget") - F.col("spent0"))
    P = P.withColumn("slots", F.col("max_upgrades") - F.col("used0") if capped else F.lit(NO_LIMIT))
    if capped:
        # the bound comes from the budget-only prefix (a relaxation)
        rb = _round_summary(greedy(steps.join(budgets_b, part), "budget"), part, 0)
        P = P.drop("bdc0", "bds0").join(rb.select(
            part, F.col("saved0").alias("lp_saved"), F.col("spent0").alias("lp_spent"),
            F.col("__blk0.dc").alias("bdc0"), F.col("__blk0.ds").alias("bds0")), part, "left")
    # P is budgets left-joined with per-batch aggregates: one row per budget row
    P = bounded_broadcast(P, rows=n_batches)

    filled = None
    if fill_rounds != 0:
        # what may still fit: behind the prefix, within what it leaves
        joined = steps.join(P.select(part, "block", "rem", "slots"), part)
        in_prefix = F.coalesce(F.col("prev_ord") < F.col("block"), F.lit(True))
        cands = (joined.filter(F.col("ord") > F.col("block"))
                 .filter((F.col("dc") <= F.col("rem")) & (F.col("du") <= F.col("slots")))
                 .filter(in_prefix | (F.col("prev_dc") <= F.col("rem")))
                 .select(part, "ord", "dc", "ds", "du", F.when(~in_prefix, F.col("prev_ord")).alias("prev_ord"),
                         "prev_dc", "rem", "slots"))
        filled = fill(cands, part, max_window_rows)
    if filled is None:
        P = P.withColumns({"phases": F.lit(None).cast(phase_type(with_steps)), "fill_spent": F.lit(0).cast(MONEY),
                           "fill_saved": F.lit(0.0)})
    else:
        P = (P.join(filled, part, "left")
             .withColumn("fill_spent", F.coalesce("fill_spent", F.lit(0).cast(MONEY)))
             .withColumn("fill_saved", F.coalesce("fill_saved", F.lit(0.0))))
        P = bounded_broadcast(P, rows=n_batches)

    spent, saved = F.col("spent0") + F.col("fill_spent"), F.col("saved0") + F.col("fill_saved")
    if capped:  # the budget-only prefix and what it leaves of the budget
        lp_saved = F.coalesce("lp_saved", F.lit(0.0))
        lp_rem = F.col("budget") - F.coalesce("lp_spent", F.lit(0).cast(MONEY))
    else:
        lp_saved, lp_rem = F.col("saved0"), F.col("rem")
    lp = lp_saved + F.coalesce(F.col("bds0") * (lp_rem.cast("double")
                                                / F.col("bdc0").cast("double")), F.lit(0.0))
    report = P.select(part, F.col("budget"), spent.cast(MONEY).alias("spent"), saved.alias("saving"),
                      lp.alias("lp_bound"), (lp - saved).alias("gap"),
                      (F.col("bds0") / F.col("bdc0").cast("double")).alias("break_ratio"))

    s1, s2 = F.col("s1"), F.col("s2")
    dec = with_steps.join(P.select(part, "block", "phases"), part, "left")
    dec = dec.withColumn("__t1", s1.isNotNull() & _taken(s1["ord"], s1["dc"], _upgrades(s1)))
    decision = (F.when(F.col("__t1") & s2.isNotNull() & _taken(s2["ord"], s2["dc"], _upgrades(s2)), F.lit("upgrade"))
                .when(F.col("__t1"), s1["act"])
                .otherwise(F.lit("nothing")))
    u = F.col("upgrade_cost").cast(MONEY)
    d = F.col("discount_cost").cast(MONEY)
    L = F.col("base_expected_loss")
    r = float(params.voucher_reduction)
    dec = dec.withColumn("decision", decision).withColumns({
        "cost": F.when(F.col("decision") == "upgrade", u)
                 .when(F.col("decision") == "discount", d).otherwise(F.lit(0).cast(MONEY)),
        "expected_loss_after": F.when(F.col("decision") == "upgrade", F.lit(0.0))
                                .when(F.col("decision") == "discount", L * F.lit(1.0 - r))
                                .otherwise(L),
    })
    return dec.drop("s1", "s2", "__t1", "block", "phases"), report


def voucher_fallback(decisions: DataFrame, report: DataFrame, part: str = "batch_id",
                     params: C.PrescriptionParams = C.PARAMS, key: str = "row_key",
                     max_window_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Second pass: an order whose only step was an upgrade cannot fall back
    to a voucher when the upgrade no longer fits the money or slots left, so
    orders left with nothing (and a loss) get a voucher while the batch's
    remaining budget allows, in order of saving per cost.

    Same plan shape as the main pass: a greedy prefix per batch
    (``take_until``), a per-batch table (first blocked step, spent, saved)
    broadcast behind a size check, and the decision as a pure function of
    the order's own step and that table — no join per order.
    """
    r = float(params.voucher_reduction)
    L, d = F.col("base_expected_loss"), F.col("discount_cost").cast(MONEY)
    idle = (F.col("decision") == "nothing") & (L > F.lit(0.0))
    paid = F.when(d > 0, F.lit(1)).otherwise(F.lit(0))
    neg_eff = F.when(d > 0, -((L * F.lit(r)) / d.cast("double"))).otherwise(F.lit(0.0))
    v_ord = _ord(paid, neg_eff, F.col(key), F.lit(3))
    rem = report.select(part, (F.col("budget") - F.col("spent")).alias("rem"))
    cands = (decisions.filter(idle)
             .select(part, v_ord.alias("ord"), d.alias("dc"), (L * F.lit(r)).alias("ds"))
             .join(bounded_broadcast(rem), part).filter(F.col("dc") <= F.col("rem"))
             .withColumns({"paid": F.col("ord.paid"), "neg_eff": F.col("ord.neg_eff"),
                           "du": F.lit(0)}))
    max_rows = (cands.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
                .agg(F.max("n")).first()[0] or 0)
    taken = take_until(cands, [part], "ord", "dc", "rem",
                       "paid", "neg_eff", "taken", max_window_rows=max_window_rows,
                       max_part_rows=max_rows)
    v = _round_summary(taken, part, 0).select(
        part, F.col("spent0").alias("v_spent"), F.col("saved0").alias("v_saved"),
        F.col("__blk0.o").alias("v_block"))
    v = bounded_broadcast(report.select(part, (F.col("budget") - F.col("spent")).alias("v_rem"))
                          .join(v, part, "left"))

    got = (idle & (d <= F.col("v_rem"))
           & (F.col("v_block").isNull() | (v_ord < F.col("v_block"))))
    dec = (decisions.join(v.select(part, "v_rem", "v_block"), part, "left")
           .withColumn("__v", got)
           .withColumns({
               "decision": F.when(F.col("__v"), F.lit("discount")).otherwise(F.col("decision")),
               "cost": F.when(F.col("__v"), d).otherwise(F.col("cost")),
               "expected_loss_after": F.when(F.col("__v"), L * F.lit(1.0 - r))
                                       .otherwise(F.col("expected_loss_after"))})
           .drop("v_rem", "v_block", "__v"))
    saving = F.col("saving") + F.coalesce("v_saved", F.lit(0.0))
    rep = (report.join(v, part, "left")
           .select(part, "budget",
                   (F.col("spent") + F.coalesce("v_spent", F.lit(0).cast(MONEY))).alias("spent"),
                   saving.alias("saving"), "lp_bound", (F.col("lp_bound") - saving).alias("gap"), "break_ratio"))
    return dec, rep


#: A single order must save this much more than the greedy choice, relatively:
#: sums of doubles differ in their last bits with the order of summation.
SINGLE_MARGIN = 1e-9


def best_single(orders: DataFrame, limits: DataFrame, part: str = "batch_id",
                params: C.PrescriptionParams = C.PARAMS, two_option: bool = False,
                key: str = "row_key") -> DataFrame:
    """Per batch the one order and action that saves most within the limits
    (part, budget[, max_upgrades]); ties go to the largest key. One partial
    aggregate, one row per batch: part, pick(saving, key, act, cost)."""
    u, d = F.col("upgrade_cost").cast(MONEY), F.col("discount_cost").cast(MONEY)
    L, r = F.col("base_expected_loss"), float(params.voucher_reduction)
    up_ok = u <= F.col("budget")
    if "max_upgrades" in limits.columns:
        up_ok = up_ok & (F.coalesce("max_upgrades", F.lit(1)) > 0)
    disc_ok = F.lit(False) if two_option else (d <= F.col("budget"))

    def action(saving, act, cost):
        return F.struct(saving.alias("saving"), F.col(key).alias("key"), F.lit(act).alias("act"),
                        cost.alias("cost"))
    pick = (F.when(up_ok, action(L, "upgrade", u))
            .when(disc_ok, action(L * F.lit(r), "discount", d)))
    return (orders.filter(L > 0).join(limits, part).groupBy(part).agg(F.max(pick).alias("pick"))
            .filter(F.col("pick").isNotNull()))


def allocate_best(orders: DataFrame, budgets: DataFrame, part: str = "batch_id",
                  params: C.PrescriptionParams = C.PARAMS, two_option: bool = False,
                  fill_rounds: int | None = None, max_window_rows: int | None = None,
                  key: str = "row_key", capacities: DataFrame | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """``allocate``, then vouchers for idle orders (three options), then the
    better of that and each batch's best single order. Where the single order
    wins, it is fixed and the rest of its batch is allocated on what it
    leaves. Arguments and results are those of ``allocate``."""
    def one_pass(o, b, c):
        dec, rep = allocate(o, b, part, params, two_option, fill_rounds, max_window_rows, key, c)
        return (dec, rep) if two_option else voucher_fallback(dec, rep, part, params, key,
                                                              max_window_rows)

    dec, rep = one_pass(orders, budgets, capacities)
    rep = materialize(rep)
    orders = dec.select(*[c for c in orders.columns if c != "budget"])  # landed by the first pass
    limits = rep.select(part, "budget")
    if capacities is not None:
        limits = limits.join(capacities.select(part, "max_upgrades"), part, "left")
    limits = bounded_broadcast(limits)
    picks = materialize(
        best_single(orders, limits, part, params, two_option, key)
        .join(rep.select(part, "saving"), part)
        .filter(F.col("pick.saving") > F.col("saving") * F.lit(1.0 + SINGLE_MARGIN))
        .select(part, "pick"))
    if picks.isEmpty():
        return dec, rep

    n = picks.count()
    picks_b = bounded_broadcast(picks, rows=n)
    rest = (orders.join(picks_b, part)
            .filter(F.col(key) != F.col("pick.key")).drop("pick"))
    left = (rep.join(picks_b, part)
            .select(part, (F.col("budget") - F.col("pick.cost")).alias("budget")))
    caps = None
    if capacities is not None:
        used = F.when(F.col("pick.act") == "upgrade", 1).otherwise(0)
        caps = (capacities.join(picks_b, part)
                .select(part, (F.col("max_upgrades") - used).alias("max_upgrades")))
    dec2, rep2 = one_pass(rest, left, caps)

    r = float(params.voucher_reduction)
    L = F.col("base_expected_loss")
    fixed = (orders.join(picks_b, part).filter(F.col(key) == F.col("pick.key"))
             .withColumns({
                 "decision": F.col("pick.act"), "cost": F.col("pick.cost"),
                 "expected_loss_after": F.when(F.col("pick.act") == "upgrade", F.lit(0.0))
                                         .otherwise(L * F.lit(1.0 - r))})
             .drop("pick"))
    kept = dec.join(picks_b.select(part), part, "left_anti")
    saving = F.col("pick.saving") + F.coalesce("s2", F.lit(0.0))
    won = (picks.join(rep.select(part, "budget", "lp_bound", "break_ratio"), part)
           .join(rep2.select(part, F.col("spent").alias("p2"), F.col("saving").alias("s2")),
                 part, "left")
           .select(part, "budget",
                   (F.col("pick.cost") + F.coalesce("p2", F.lit(0).cast(MONEY))).alias("spent"),
                   saving.alias("saving"), "lp_bound", (F.col("lp_bound") - saving).alias("gap"), "break_ratio"))
    rep_out = rep.join(picks_b.select(part), part, "left_anti").unionByName(won)
    return kept.unionByName(dec2).unionByName(fixed), rep_out
