"""Exact choice: the greedy allocation improved to the optimum around the break ratio.

With lam the saving per cost of the step at which the greedy prefix ends, an
option's worth is saving - lam * cost, and the sum of each order's best worth
plus lam times the budget is ``lp_bound``. A choice that takes other options
loses their *regrets* (best worth - worth) and lam times the money it leaves,
so any choice better than the present one has regrets below the present
``gap`` in all. Orders all of whose other options have more regret than that
are settled; the rest, few where the gap is small, are the core.

Per order this is a projection with a broadcast per-batch table. The core
orders of least regret, at most ``max_core`` of a batch, go through a dynamic
program over (cost, regret): dominated states, states that cannot come back
below the budget and states that cannot beat the best gap are dropped. If the
core was whole and no state was left out, the result is the optimum
(``optimal``); else ``gap`` still bounds the distance.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import materialize, ship_package
from .allocate import MONEY
from .ranking import bounded_broadcast

UNITS = 10_000
#: Sums of doubles differ in their last bits; a difference of less than this share of the bound is none.
MARGIN = 1e-11


@dataclass(frozen=True)
class CoreParams:
    max_core: int = 256  # orders of a batch in the dynamic program
    max_states: int = 50_000  # states kept after an order


def _options(params: C.PrescriptionParams, two_option: bool) -> Column:
    """Affordable options of an order: (worth, cheap, act, cost, saving), by worth, then cheapness."""
    L, lam, budget = F.col("base_expected_loss"), F.col("lam"), F.col("budget")

    def option(act, cost, saving):
        return F.struct((saving - lam * cost.cast("double")).alias("worth"), (-cost).cast(MONEY).alias("cheap"), F.lit(act).alias("act"),
                        cost.cast(MONEY).alias("cost"), saving.alias("saving"))
    out = [option("nothing", F.lit(0).cast(MONEY), F.lit(0.0))]
    named = [("upgrade", "upgrade_cost", L)] + ([] if two_option else [("discount", "discount_cost", L * F.lit(float(params.voucher_reduction)))])
    for act, cost, saving in named:
        out.append(F.when((L > 0) & (F.col(cost) <= budget), option(act, F.col(cost).cast(MONEY), saving)))
    return F.filter(F.array(*out), lambda o: o.isNotNull())


def solve_core(cost: int, budget: int, gap: float, lam: float, orders: list[list[tuple[int, float]]],
               max_states: int, margin: float) -> tuple[float, list[int] | None, int, bool]:
    """(gap, choice of each order or None if nothing beats ``gap``, cost, whether all states were kept).
    ``cost``: of all best options; ``orders``: each order's other options as (extra cost, regret);
    a choice is 0 for the best option, else the place of the other one, from 1."""
    down = np.cumsum([0, *[min(0, *(c for c, _ in o)) for o in orders[::-1]]])[::-1]
    up = np.cumsum([0, *[max(0, *(c for c, _ in o)) for o in orders[::-1]]])[::-1]
    spent, regret, whole, back = np.array([cost], np.int64), np.zeros(1), True, []
    for i, others in enumerate(orders):
        n = len(spent)
        spent = np.concatenate([spent, *[spent[:n] + c for c, _ in others]])
        regret = np.concatenate([regret, *[regret[:n] + r for _, r in others]])
        parent = np.tile(np.arange(n), len(others) + 1)
        act = np.repeat(np.arange(len(others) + 1), n)
        most = regret + lam * np.maximum(0, budget - spent - up[i + 1])
        keep = np.flatnonzero((spent + down[i + 1] <= budget) & (most < gap - margin))
        keep = keep[np.lexsort((regret[keep], spent[keep]))]
        worth = lam * spent[keep] - regret[keep]
        before = np.maximum.accumulate(np.append(-np.inf, worth))[:-1]
        keep = keep[worth > before]
        if len(keep) > max_states:
            keep, whole = np.sort(keep[np.argpartition(regret[keep], max_states)[:max_states]]), False
            keep = keep[np.argsort(spent[keep], kind="stable")]
        spent, regret = spent[keep], regret[keep]
        back.append((parent[keep], act[keep]))
        if len(keep) == 0:
            return gap, None, cost, whole
    total = np.where(spent <= budget, regret + lam * (budget - spent), np.inf)
    at = int(total.argmin())
    if not total[at] < gap - margin:
        return gap, None, cost, whole
    best, best_cost, choice = float(total[at]), int(spent[at]), []
    for parent, act in reversed(back):
        choice.append(int(act[at]))
        at = int(parent[at])
    return best, choice[::-1], best_cost, whole


def _solve(part: str, p: CoreParams):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """One row for the batch (no row_key), and one for each core order if the choice is better."""
        rows = rows.sort_values(["least", "core_key"], kind="stable")
        whole = len(rows) <= p.max_core
        rows = rows.head(p.max_core)
        b = rows.iloc[0]
        lam, margin = b["lam"] / UNITS, MARGIN * max(1.0, abs(b["lp_bound"]))
        others = [[(int(c), float(r)) for c, r in zip(cs, rs, strict=True)] for cs, rs in zip(rows["extra"], rows["regret"], strict=True)]
        gap, choice, cost, kept = solve_core(int(b["base"]), int(b["money"]), float(b["gap"]), lam, others, p.max_states, margin)
        out = [(key[0], None, None, choice is not None, whole and kept, gap, cost)]
        if choice is not None:
            out += [(key[0], k, acts[c], None, None, None, None)
                    for k, acts, c in zip(rows["core_key"], ([a, *o] for a, o in zip(rows["act"], rows["acts"], strict=True)), choice, strict=True)]
        return pd.DataFrame(out, columns=[part, "core_key", "act", "better", "optimal", "new_gap", "new_cost"]).astype(
            {"better": "boolean", "optimal": "boolean", "new_gap": "Float64", "new_cost": "Int64"})
    return run


def spread_batches(rows: DataFrame, part: str, batches: int) -> DataFrame:
    """The rows dealt by batch over several partitions for each batch, so few batches share a task. Cores are
    a few bytes and seconds of work each: by their bytes they would all be put into one task."""
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(4 * batches, most))
    # rows that lie by batch over as many partitions already would not be dealt again, but put together
    return rows.repartition(n + 1 if n == most else n, part)


def improve(decisions: DataFrame, report: DataFrame, part: str = "batch_id", params: C.PrescriptionParams = C.PARAMS,
            two_option: bool = False, key: str = "row_key", core: CoreParams = CoreParams()) -> tuple[DataFrame, DataFrame]:
    """(decisions, report) with the better choice per batch; ``report`` gets ``optimal``. For the results
    of ``allocate_best`` without slot limits."""
    ship_package(decisions.sparkSession)
    dec, rep = materialize(decisions), materialize(report)
    margin = F.lit(MARGIN) * F.greatest(F.lit(1.0), F.abs("lp_bound"))
    open_ = rep.filter(F.col("gap") > margin)
    n_open = open_.count()
    if n_open == 0:
        return dec, rep.withColumn("optimal", F.lit(True))
    lam = F.coalesce("break_ratio", F.lit(0.0))
    limits = bounded_broadcast(open_.select(part, "budget", "gap", "lp_bound", lam.alias("lam")), rows=n_open)
    rated = (dec.select(part, F.col(key).alias("core_key"), "upgrade_cost", "discount_cost", "base_expected_loss")
             .join(limits, part).withColumn("options", _options(params, two_option))
             .withColumn("best", F.array_max("options"))
             .withColumn("others", F.filter("options", lambda o: (o["act"] != F.col("best.act")) & (F.col("best.worth") - o["worth"] < F.col("gap")))))
    rated = materialize(rated.select(part, "core_key", "best", "others"))
    base = rated.groupBy(part).agg((F.sum("best.cost") * UNITS).cast("bigint").alias("base"))
    regret = F.transform("others", lambda o: F.col("best.worth") - o["worth"])
    cores = rated.filter(F.size("others") > 0).select(
        part, "core_key", F.col("best.act").alias("act"), F.col("others.act").alias("acts"), regret.alias("regret"), F.array_min(regret).alias("least"),
        F.transform("others", lambda o: ((o["cost"] - F.col("best.cost")) * UNITS).cast("bigint")).alias("extra"))
    first = Window.partitionBy(part).orderBy("least", "core_key")
    cores = (cores.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= core.max_core + 1).drop("place")
             .join(limits, part).join(base, part).withColumn("money", (F.col("budget") * UNITS).cast("bigint")).drop("budget"))
    key_type = rated.schema["core_key"].dataType.simpleString()
    solved = materialize(spread_batches(cores, part, n_open).groupBy(part).applyInPandas(
        _solve(part, core), f"{part} {rated.schema[part].dataType.simpleString()}, core_key {key_type}, act string, better boolean, "
                            "optimal boolean, new_gap double, new_cost bigint"))
    batches = solved.filter(F.col("better").isNotNull()).drop("core_key", "act")  # a row for each open batch

    better = bounded_broadcast(batches.filter("better").select(part))
    chosen = (rated.join(better, part)
              .join(bounded_broadcast(solved.filter(F.col("core_key").isNotNull()).select(part, "core_key", F.col("act").alias("core_act"))),
                    [part, "core_key"], "left")
              .select(part, F.col("core_key").alias(key), F.coalesce("core_act", "best.act").alias("new_act")))
    r = float(params.voucher_reduction)
    L, act = F.col("base_expected_loss"), F.col("decision")
    cost = (F.when(act == "upgrade", F.col("upgrade_cost").cast(MONEY)).when(act == "discount", F.col("discount_cost").cast(MONEY))
            .otherwise(F.lit(0).cast(MONEY)))
    after = F.when(act == "upgrade", F.lit(0.0)).when(act == "discount", L * F.lit(1.0 - r)).otherwise(L)
    dec = (dec.join(chosen, [part, key], "left").withColumn("decision", F.coalesce("new_act", "decision"))
           .withColumns({"cost": cost, "expected_loss_after": after}).select(*dec.columns))
    found, won = rep.join(batches, part, "left"), F.coalesce("better", F.lit(False))
    money = (F.col("new_cost").cast("decimal(24,0)") / F.lit(UNITS)).cast(MONEY)
    rep = found.select(
        part, "budget", F.when(won, money).otherwise(F.col("spent")).alias("spent"),
        F.when(won, F.col("lp_bound") - F.col("new_gap")).otherwise(F.col("saving")).alias("saving"), "lp_bound",
        F.when(won, F.col("new_gap")).otherwise(F.col("gap")).alias("gap"), "break_ratio", F.coalesce("optimal", F.lit(True)).alias("optimal"))
    return dec, rep
