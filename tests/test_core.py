"""The exact choice against all combinations and against a plain dynamic program."""

import itertools
import random
from decimal import Decimal

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from shipwise.operators.allocate import allocate_best
from shipwise.operators.core import CoreParams, improve, solve_core, spread_batches

SCHEMA = "batch_id string, row_key string, upgrade_cost decimal(20,4), discount_cost decimal(20,4), base_expected_loss double"


def optimum(rows, budget, two):
    """Largest saving within the budget, over undominated (cost, saving) states."""
    states = [(Decimal(0), 0.0)]
    for _, _, u, d, L in rows:
        options = [(Decimal(0), 0.0), (u, L)] + ([] if two else [(d, 0.6 * L)])
        nxt = sorted((c + x, -(s + y)) for c, s in states for x, y in options if c + x <= Decimal(str(budget)))
        states, best = [], -1.0
        for c, minus in nxt:
            if -minus > best:
                best = -minus
                states.append((c, best))
    return max(s for _, s in states)


def _orders(rng, batch, n):
    return [(batch, f"{batch}-{i}", Decimal(rng.randint(0, 4000)) / 100, Decimal("3.00"), rng.choice([0.0, rng.random() * 40, rng.random() * 90]))
            for i in range(n)]


@pytest.mark.parametrize("two", [False, True])
def test_optimum_of_batches(spark, two):
    rng = random.Random(2 + two)
    sizes = [0, 1, 2, 3, 5, 8, 13, 20, 20, 25, 25, 30, 30, 40, 40, 60, 80, 120]
    rows = {f"b{i}": _orders(rng, f"b{i}", n) for i, n in enumerate(sizes)}
    budgets = {b: round(rng.choice([0.1, 0.2, 0.36, 0.36, 0.6, 1.1]) * float(sum(r[2] for r in rs)), 2) for b, rs in rows.items()}
    orders = spark.createDataFrame([r for rs in rows.values() for r in rs], SCHEMA)
    bdf = spark.createDataFrame(list(budgets.items()), "batch_id string, budget double")
    first = allocate_best(orders, bdf, two_option=two)
    dec, rep = improve(*first, two_option=two)
    got = dec.collect()
    assert sorted(r.row_key for r in got) == sorted(r[1] for rs in rows.values() for r in rs) and dec.columns == first[0].columns
    greedy = {r.batch_id: r for r in first[1].collect()}
    better = 0
    for r in rep.collect():
        b = r.batch_id
        mine = [x for x in got if x.batch_id == b]
        saving = sum(x.base_expected_loss - x.expected_loss_after for x in mine)
        assert r.optimal and abs(saving - optimum(rows[b], budgets[b], two)) < 1e-7
        assert abs(r.saving - saving) < 1e-7 and sum(x.cost for x in mine) == r.spent <= Decimal(str(budgets[b]))
        assert greedy[b].saving <= r.saving + 1e-7 <= r.lp_bound + 2e-7 and abs(r.gap - (r.lp_bound - r.saving)) < 1e-7
        better += r.saving > greedy[b].saving + 1e-7
        for x in mine:
            want = {"upgrade": (x.upgrade_cost, 0.0), "discount": (x.discount_cost, x.base_expected_loss * (1.0 - 0.6)),
                    "nothing": (Decimal(0), x.base_expected_loss)}[x.decision]
            assert (x.cost, x.expected_loss_after) == want
    assert better >= 3


def test_small_cores_still_keep_the_bound(spark):
    """With a core of two orders and two states the choice is never worse and never called optimal."""
    rng = random.Random(6)
    rows = [r for i in range(6) for r in _orders(rng, f"b{i}", 60)]
    orders = spark.createDataFrame(rows, SCHEMA)
    bdf = spark.createDataFrame([(f"b{i}", 200.0) for i in range(6)], "batch_id string, budget double")
    first = allocate_best(orders, bdf)
    _, rep = improve(*first, core=CoreParams(max_core=2, max_states=2))
    greedy = {r.batch_id: r.saving for r in first[1].collect()}
    got = rep.collect()
    assert not all(r.optimal for r in got)
    for r in got:
        best = optimum([x for x in rows if x[0] == r.batch_id], 200, False)
        assert greedy[r.batch_id] - 1e-9 <= r.saving <= best + 1e-7 and r.spent <= 200
        assert not r.optimal or abs(r.saving - best) < 1e-7


def test_core_program_against_all_choices():
    rng = random.Random(9)
    for _ in range(300):
        orders = [[(rng.randint(-50, 50), rng.choice([0.0, rng.random() * 3])) for _ in range(rng.randint(1, 2))] for _ in range(rng.randint(1, 7))]
        cost, budget, lam, gap = rng.randint(0, 100), rng.randint(0, 100), rng.random() * 0.1, rng.random() * 6
        best, found = gap, None
        for combo in itertools.product(*[range(len(o) + 1) for o in orders]):
            c = cost + sum(o[i - 1][0] for o, i in zip(orders, combo) if i)
            x = sum(o[i - 1][1] for o, i in zip(orders, combo) if i) + lam * (budget - c)
            if c <= budget and x < best - 1e-12:
                best, found = x, combo
        got, choice, spent, whole = solve_core(cost, budget, gap, lam, orders, 10**6, 1e-13)
        assert whole and abs(got - best) < 1e-9 and (choice is None) == (found is None)
        if choice:
            assert spent == cost + sum(o[i - 1][0] for o, i in zip(orders, choice) if i) <= budget


def test_nothing_open(spark):
    orders = spark.createDataFrame([("b", "r", Decimal(1), Decimal(3), 9.0)], SCHEMA)
    bdf = spark.createDataFrame([("b", 5.0)], "batch_id string, budget double")
    dec, rep = improve(*allocate_best(orders, bdf))
    assert rep.first().optimal and dec.first().decision == "upgrade" and rep.filter(F.col("gap") > 0).count() == 0


def test_batches_do_not_share_a_task(spark):
    """Cores are small, so a plain grouping would put the programs of all batches into one task."""
    rows = spark.range(50).select(F.concat(F.lit("b"), F.col("id") % 25).alias("batch_id"))
    rows = rows.groupBy("batch_id").count().select("batch_id")  # as the cores, by batch already
    ids = spread_batches(rows, "batch_id", 25).groupBy("batch_id").applyInPandas(
        lambda x: x.head(1).assign(task=TaskContext.get().partitionId()), "batch_id string, task int").collect()
    assert len(ids) == 25 and len({r["task"] for r in ids}) >= 6
