"""Hand-made rows for the semantic traps (FIXTURES.md §C)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shipwise import config as C
from shipwise.functions.columns import pad_label, risk_band
from shipwise.operators import clean as cl, features as fe, metrics as me, rates as ra
from shipwise.operators.allocate import order_steps
from shipwise.operators.prescribe import batch_summary, flat_records, prescribe
from shipwise.operators.ranking import largest_remainder
from shipwise.sources.files import read_csv


def test_null_status_is_kept(spark):
    df = spark.createDataFrame([(1, None), (2, "Shipping canceled"), (3, "Late")],
                               "id int, delivery_status string")
    assert sorted(r.id for r in cl.not_cancelled(df).collect()) == [1, 3]


def test_null_group_key_left_out(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 0)],
                               "category_name string, late_delivery_risk int")
    rows = ra.delay_rate(df, "category_name").collect()
    assert [(r.category_name, r.delay_rate) for r in rows] == [("a", 0.5)]


def test_label_encoding_code_point_order(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("Z",), ("ñ",)], "c string")
    d = {r.value: r.code for r in fe.fit_dictionary(df, ["c"]).collect()}
    assert d == {"Z": 0, "a": 1, "b": 2, "nan": 3, "ñ": 4}


def test_unseen_value_gets_minus_one_and_is_counted(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("x",)], "c string")
    enc = fe.apply_dictionary(test, fe.fit_dictionary(train, ["c"]), ["c"])
    assert sorted(r.c for r in enc.collect()) == [-1, 0]
    assert fe.unseen_counts(enc, ["c"]).first().n_unseen == 1


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6),), (dt.datetime(2024, 1, 8),)],
                               "order_date timestamp_ntz")
    out = fe.add_date_features(df).orderBy("order_date").collect()
    assert [(r.order_dayofweek, r.order_is_weekend) for r in out] == [(5, 1), (0, 0)]


def test_text_dates_are_parsed(spark):
    df = spark.createDataFrame([("1/6/2024 10:00",)], "order_date string")
    r = fe.add_date_features(df, fmt="M/d/yyyy H:mm").first()
    assert (r.order_month, r.order_dayofweek, r.order_quarter) == (1, 5, 1)


def _orders(spark, rows):
    return spark.createDataFrame(
        rows, "row_key string, order_id bigint, batch_id string, price double, profit double, "
              "risk_score double")


def _budgets(spark, b):
    return spark.createDataFrame([("b", float(b))], "batch_id string, budget double")


def test_record_example(spark):
    orders = _orders(spark, [("k1", 42, "b", 60.00, 88.19, 0.9999)])
    out = prescribe(orders, budgets=_budgets(spark, 800))
    r = flat_records(out["decisions"]).first()
    assert (r.decision, r.cost, r.expected_loss_before, r.expected_loss_after) == \
        ("upgrade", 4.8, 88.18, 0.0)
    assert (r.discount_cost, r.discount_loss_after, r.nothing_loss_after) == (3.0, 35.27, 88.18)
    assert r.risk_score == 0.9999 and r.value_at_risk == 88.19


def test_clip_and_rejected(spark):
    orders = _orders(spark, [("k1", 1, "b", -5.0, 10.0, 0.5), ("k2", 2, "b", None, 10.0, 0.5)])
    out = prescribe(orders, budgets=_budgets(spark, 0))
    dec = {r.row_key: (r.decision, float(r.cost)) for r in out["decisions"].collect()}
    assert dec == {"k1": ("upgrade", 0.0)}  # free upgrade, taken with budget 0
    assert [r.row_key for r in out["rejected"].collect()] == ["k2"]


def test_zero_loss_means_nothing(spark):
    orders = _orders(spark, [("k1", 1, "b", 10.0, 10.0, 0.0), ("k2", 2, "b", 10.0, 0.0, 0.9)])
    out = prescribe(orders, budgets=_budgets(spark, 100))
    assert {r.decision for r in out["decisions"].collect()} == {"nothing"}


def test_switch_point(spark):
    rows = [(f"k{i}", i, "b", Decimal(u), Decimal("3.00"), 10.0)
            for i, u in enumerate(["2.99", "3.00", "4.99", "5.00", "5.01"])]
    df = spark.createDataFrame(rows, "row_key string, id int, batch_id string, "
                                     "upgrade_cost decimal(20,4), discount_cost decimal(20,4), "
                                     "base_expected_loss double")
    got = {r.id: r.s2 is not None for r in order_steps(df).collect()}
    assert got == {0: False, 1: False, 2: False, 3: False, 4: True}


def test_budget_zero_negative_ample(spark):
    orders = _orders(spark, [("k1", 1, "b", 10.0, 10.0, 0.5), ("k2", 2, "b", 100.0, 50.0, 0.5),
                             ("k3", 3, "b", 20.0, 0.0, 0.5)])
    zero = prescribe(orders, budgets=_budgets(spark, 0))["decisions"]
    assert {r.decision for r in zero.collect()} == {"nothing"}
    with pytest.raises(ValueError):
        prescribe(orders, budgets=_budgets(spark, -1))
    ample = {r.row_key: r.decision for r in
             prescribe(orders, budgets=_budgets(spark, 1000))["decisions"].collect()}
    assert ample == {"k1": "upgrade", "k2": "upgrade", "k3": "nothing"}


def test_unknown_batch_is_an_error(spark):
    orders = _orders(spark, [("k1", 1, "zz", 10.0, 10.0, 0.5)])
    with pytest.raises(ValueError):
        prescribe(orders, budgets=_budgets(spark, 10))


def test_auc_ties_count_half(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 1)], "risk_score double, late_delivery_risk int")
    assert me.roc_auc(df).first().roc_auc == 0.5


def test_auc_matches_pairwise_definition(spark):
    import random
    rnd = random.Random(3)
    rows = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "risk_score double, late_delivery_risk int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(me.roc_auc(df).first().roc_auc - want) < 1e-6


def test_summary_with_zero_loss_has_null_reduction(spark):
    orders = _orders(spark, [("k1", 1, "b", 10.0, 0.0, 0.5)])
    out = prescribe(orders, budgets=_budgets(spark, 10))
    s = batch_summary(out["decisions"], out["budgets"]).first()
    assert s.loss_reduction_pct is None and s.n_nothing == 1 and s.n_upgrade == 0


def test_risk_band_and_padding(spark):
    df = spark.createDataFrame([(0.66, "7"), (0.67, "12345"), (0.33, "12"), (0.34, "1234")],
                               "r double, id string")
    out = df.select(risk_band("r").alias("b"), pad_label("id").alias("p")).collect()
    assert [r.b for r in out] == ["medium", "high", "low", "medium"]
    assert [r.p for r in out] == ["0007", "12345", "0012", "1234"]


def test_latin1_csv_and_missing_markers(spark, tmp_dir):
    path = f"{tmp_dir}/in.csv"
    with open(path, "wb") as f:
        f.write(b"Customer Lname,Order Zipcode\nMu\xf1oz,NA\nSmith,12345\n")
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("Customer Lname", StringType()),
                         StructField("Order Zipcode", LongType())])
    rows = read_csv(spark, path, schema).collect()
    assert rows[0]["Customer Lname"] == "Muñoz" and rows[0]["Order Zipcode"] is None
    assert rows[1]["Order Zipcode"] == 12345


def test_largest_remainder():
    assert largest_remainder({0: 3, 1: 4}, 1, 5) == {0: 1, 1: 1}  # k = ceil(7/5) = 2
    k = largest_remainder({0: 22503, 1: 35169}, 1, 5)
    assert sum(k.values()) == -(-57672 // 5)


def test_money_text(spark):
    from shipwise.operators.board import money_text
    df = spark.createDataFrame([(4.8,), (1234.5,)], "x double")
    assert [r.t for r in df.select(money_text("x").alias("t")).collect()] == ["4.80", "1234.50"]
    assert df.select(money_text("x", 0).alias("t")).first().t == "5"


def test_auc_leaves_out_rows_without_score(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (0, None), (1, None)], f"{C.TARGET_COL} int, risk_score double")
    r = me.roc_auc(df).first()
    assert (r.roc_auc, r.n_pos, r.n_neg) == (1.0, 1, 1)

