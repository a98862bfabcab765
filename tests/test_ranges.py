"""Ties and crowded scores: the bucketed plans against plain ones."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shipwise.operators import metrics as me
from shipwise.operators.ranking import take_until, take_until_window


def _steps(spark, weights, cap):
    rows = [("hot" if i % 10 else "small", f"k{i:05d}", Decimal(w), 1) for i, w in enumerate(weights)]
    return (spark.createDataFrame(rows, "part string, key string, w decimal(20,4), slot bigint")
            .withColumn("paid", F.when(F.col("w") > 0, 1).otherwise(0))
            .withColumn("neg_eff", F.when(F.col("w") > 0, F.lit(-0.5)).otherwise(F.lit(0.0)))
            .withColumn("ord", F.struct("paid", "neg_eff", F.md5("key"), "key"))
            .withColumns({"cap": F.lit(Decimal(cap)).cast("decimal(20,4)"), "slots": F.lit(300).cast("bigint")}))


@pytest.mark.parametrize("weight, cap, weights, caps", [
    ("2", "333", "w", "cap"),                       # every step as efficient as the others
    ("0", "0", ["w", "slot"], ["cap", "slots"]),    # every step free, slots run out
    ("2", "9999", "w", "cap"),                      # nothing crosses
])
def test_ties_are_split_by_the_whole_order(spark, monkeypatch, weight, cap, weights, caps):
    df = _steps(spark, [weight] * 2000, cap)
    want = {(r.key, r.taken) for r in take_until_window(df, ["part"], "ord", weights, caps).collect()}
    sorted_at_once = []
    plain = take_until_window

    def watched(rows, parts, *rest):
        sorted_at_once.append(rows.groupBy(*parts).count().agg(F.max("count")).first()[0] or 0)
        return plain(rows, parts, *rest)

    monkeypatch.setattr("shipwise.operators.ranking.take_until_window", watched)
    monkeypatch.setattr("shipwise.config.KNOBS", type(me.C.KNOBS)(take_until_ranges=4))
    out = take_until(df, ["part"], "ord", weights, caps, "paid", "neg_eff", max_window_rows=60)
    assert {(r.key, r.taken) for r in out.collect()} == want
    assert sorted_at_once and max(sorted_at_once) <= 60  # no task sorts more than the limit


def test_equal_order_keys_end(spark):
    """Rows that the order cannot tell apart are one window, not an endless split."""
    df = _steps(spark, ["2"] * 100, "50").withColumn("ord", F.struct("paid", "neg_eff"))
    out = take_until(df, ["part"], "ord", "w", "cap", "paid", "neg_eff", max_window_rows=10)
    taken = {r.part: r.n for r in out.where("taken").groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert taken == {"hot": 25, "small": 10}


@pytest.mark.parametrize("low, high", [(0.5, 0.5009), (-40.0, 70.0), (0.0, 0.0)])
def test_auc_wherever_the_scores_lie(spark, low, high):
    rnd = random.Random(8)
    rows = [(round(rnd.uniform(low, high), 5), rnd.randint(0, 1)) for _ in range(400)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "risk_score double, late_delivery_risk int")
    got = me.roc_auc(df, ranges=7).first()
    assert abs(got.roc_auc - want) < 1e-6 and (got.n_pos, got.n_neg) == (len(pos), len(neg))


def test_auc_of_no_rows(spark):
    got = me.roc_auc(spark.createDataFrame([], "risk_score double, late_delivery_risk int")).first()
    assert got.roc_auc is None
