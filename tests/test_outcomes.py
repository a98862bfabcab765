"""Outcomes that come apart and later: batch join, stream join, and the stream's balance."""

from datetime import datetime, timedelta
from decimal import Decimal

from shipwise.operators.loop import calibration_by_key, join_outcomes
from shipwise.streaming import outcomes_stream, prescribe_stream

DAY0 = datetime(2024, 1, 1)
DELIVERY = "row_key string, delivered_at timestamp, late_delivery_risk int"
ASKED = "row_key string, decision string, risk_score double, prescribed_at timestamp"


def _day(n):
    return DAY0 + timedelta(days=n)


def test_join_outcomes(spark):
    asked = spark.createDataFrame([("a", 9), ("b", 9), ("c", 9), (None, 9)], "row_key string, late_delivery_risk int")
    came = spark.createDataFrame([("a", _day(1), 1), ("a", _day(2), 0), ("b", _day(3), 0), ("b", _day(3), 1),
                                  ("c", _day(1), None), ("x", _day(1), 1), (None, _day(1), 1)], DELIVERY)
    got = {r.row_key: r.late_delivery_risk for r in join_outcomes(asked, came).collect()}
    assert got == {"a": 0, "b": 1, "c": None, None: None}


def test_calibration_counts_open_orders(spark):
    rows = [("a", "upgrade", 0.91, 10.0, 0.0), ("b", "upgrade", 0.95, 10.0, 0.0), ("c", "nothing", 0.1, 5.0, 0.5)]
    asked = spark.createDataFrame(rows, "row_key string, decision string, risk_score double, value_at_risk double, expected_loss_after double")
    got = {(r.decision, r.risk_decile): r for r in calibration_by_key(asked, spark.createDataFrame([("a", _day(1), 1)], DELIVERY)).collect()}
    assert (got[("upgrade", 9)].n_orders, got[("upgrade", 9)].n_open, got[("upgrade", 9)].observed_late_rate) == (1, 1, 1.0)
    assert (got[("nothing", 1)].n_orders, got[("nothing", 1)].n_open, got[("nothing", 1)].brier_score) == (0, 1, None)


def test_stream_of_delayed_outcomes(spark, tmp_dir):
    asked, came, out = f"{tmp_dir}/asked", f"{tmp_dir}/came", f"{tmp_dir}/out"
    put = lambda rows, schema, path: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def run():
        q = outcomes_stream.start(spark, asked, spark.createDataFrame([], ASKED).schema, came,
                                  spark.createDataFrame([], DELIVERY).schema, out, f"{tmp_dir}/ckpt",
                                  wait="5 days", lateness="1 day")
        assert q.awaitTermination(300)
        assert q.exception() is None

    put([("a", "upgrade", 0.9, _day(0)), ("b", "nothing", 0.2, _day(0)), ("late", "nothing", 0.3, _day(0))], ASKED, asked)
    put([("a", _day(2), 1), ("a", _day(2), 1)], DELIVERY, came)  # reported twice
    run()
    assert [(r.row_key, r.late_delivery_risk) for r in spark.read.parquet(out).collect()] == [("a", 1)]
    put([("d", "discount", 0.5, _day(30))], ASKED, asked)
    put([("d", _day(31), 0)], DELIVERY, came)
    run()
    put([("e", "discount", 0.5, _day(60))], ASKED, asked)
    put([("late", _day(4), 1), ("e", _day(61), 1)], DELIVERY, came)  # a month after its prescription left
    run()
    stored = spark.read.parquet(out)
    got = sorted((r.row_key, r.late_delivery_risk) for r in stored.collect() if r.row_key in "abcd")
    assert got == [("a", 1), ("b", None), ("d", 0)]
    assert [r.late_delivery_risk for r in stored.where("row_key = 'late'").collect()] == [None]
    settled = {r.row_key: r.late_delivery_risk for r in outcomes_stream.settle(stored, spark.read.parquet(came)).collect()}
    assert settled["late"] == 1 and settled["b"] is None and settled["a"] == 1


def test_balance_does_not_grow(spark, tmp_dir):
    """After many micro-batches there are two balances of a row per batch, equal to the sums."""
    out = f"{tmp_dir}/out"
    schema = prescribe_stream.BALANCE_SCHEMA
    for epoch in range(12):
        amounts = [("hot", Decimal("1.5"), 1)] + ([("rare", Decimal("2"), 0)] if epoch == 3 else [])
        for _ in range(2 if epoch == 7 else 1):  # one replay
            before = prescribe_stream.used_before(spark, out, epoch)
            prescribe_stream.advance_balance(before, spark.createDataFrame(amounts, schema), out, epoch)
        assert len(prescribe_stream._balances(spark, f"{out}_balance")) <= 2
    got = {r.batch_id: (r.spent, r.used) for r in prescribe_stream.used_before(spark, out, 12).collect()}
    assert got == {"hot": (Decimal("18.0000"), 12), "rare": (Decimal("2.0000"), 0)}
