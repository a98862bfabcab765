"""The fill against a plain scan: phases, ranges, slots, many steps that do not fit."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shipwise.operators.allocate import allocate, order_steps
from shipwise.operators.fill import Scan

SCHEMA = "batch_id string, row_key string, upgrade_cost decimal(20,4), discount_cost decimal(20,4), base_expected_loss double"


def plain(steps, money, slots):
    """Decisions of a plain scan over (order, cost, upgrade, key, act) steps of one batch."""
    taken = {}
    for o, cost, up, key, act in sorted(steps):
        if cost <= money and up <= slots and (o[3] == 1 or key in taken):
            money, slots = money - cost, slots - up
            taken[key] = act
    return taken


def steps_of(rows, budget, two):
    """The steps as the engine states them, collected."""
    df = order_steps(rows.withColumn("budget", F.lit(budget).cast("decimal(20,4)")), two_option=two)
    out = []
    for r in df.collect():
        for s in (r.s1, r.s2):
            if s is not None:
                out.append((tuple(s.ord), s.dc, int(s.act == "upgrade"), r.row_key, s.act))
    return out


def orders_of(rng, n, batch):
    costs = [rng.choice([0, 1, 50, 299, 300, 480, 500, 501, 650, 900, rng.randint(1, 6000)]) for _ in range(n)]
    return [(batch, f"{batch}-{i:04}", Decimal(c) / 100, Decimal(rng.choice([0, 2, 3])), rng.choice([0.0, 1.5, 4.0, 40.0, rng.random() * 90]))
            for i, c in enumerate(costs)]


@pytest.mark.parametrize("window", [None, 9])
@pytest.mark.parametrize("two", [False, True])
def test_fill_is_a_plain_scan(spark, two, window):
    rng = random.Random(3)
    sizes = {"a": 60, "b": 5, "c": 90, "d": 1, "e": 30}
    rows = [x for b, n in sizes.items() for x in orders_of(rng, n, b)]
    budgets = {"a": 40.0, "b": 2.0, "c": 91.37, "d": 0.0, "e": 500.0}
    slots = {"a": 4, "b": 0, "c": None, "d": 1, "e": 7}
    orders = spark.createDataFrame(rows, SCHEMA)
    bdf = spark.createDataFrame(list(budgets.items()), "batch_id string, budget double")
    cdf = spark.createDataFrame(list(slots.items()), "batch_id string, max_upgrades int")
    for caps in (None, cdf):
        dec, rep = allocate(orders, bdf, two_option=two, capacities=caps, max_window_rows=window)
        got = {r.row_key: r.decision for r in dec.collect() if r.decision != "nothing"}
        want = {}
        for b, budget in budgets.items():
            most = 10**9 if caps is None or slots[b] is None else slots[b]
            want |= plain(steps_of(orders.where(F.col("batch_id") == b), budget, two), Decimal(str(budget)), most)
        assert got == want
        spent = {r.batch_id: r.spent for r in rep.collect()}
        assert spent == {r[0]: r[1] for r in dec.groupBy("batch_id").agg(F.sum("cost")).collect()}


def test_a_thousand_blocking_pairs(spark):
    """Cheap steps between ones that just do not fit: one pass, few phases."""
    n = 1000
    rows = []
    for i in range(n):
        rows.append(("b", f"x{i:04}", Decimal(1), Decimal(3), float(5000 - 2 * i)))
        rows.append(("b", f"y{i:04}", Decimal(n - i) + Decimal("0.5"), Decimal(3), (5000 - 2 * i - 1) * (n - i + 0.5)))
    orders = spark.createDataFrame(rows, SCHEMA)
    bdf = spark.createDataFrame([("b", float(n))], "batch_id string, budget double")
    want = plain(steps_of(orders, float(n), True), Decimal(n), 10**9)
    for window in (None, 100):
        dec, _ = allocate(orders, bdf, two_option=True, max_window_rows=window)
        assert {r.row_key: r.decision for r in dec.collect() if r.decision != "nothing"} == want
    assert len(want) == n


def test_phases_are_few():
    rng = random.Random(5)
    for _ in range(200):
        money = rng.randint(0, 10**7)
        scan, taken = Scan(money, 10**9), []
        steps = [((1, -rng.random(), str(i), 1), rng.choice([0, 1, rng.randint(1, 10**rng.randint(1, 7))])) for i in range(300)]
        left = money
        for o, cost in sorted(steps):
            scan.see(o, cost, 1.0, 0, None, None)
            if cost <= left:
                left -= cost
                taken.append(o)
        assert len(scan.phases()) <= money.bit_length() + 2 and scan.money == left and scan.saved == len(taken)
        assert [o for o, cost in sorted(steps) if scan.took(o, cost)] == taken
