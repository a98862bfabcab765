"""Saved dictionary and model: encoding, unseen values, versions, scoring, the stream."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shipwise.operators import bundle
from shipwise.operators.features import fit_dictionary
from shipwise.operators.ranking import range_rank
from shipwise.plans import catalog as c
from shipwise.session import materialize
from shipwise.streaming import prescribe_stream
from tests.conftest import SF001

SMALL = dict(maxIter=3, maxDepth=3, stepSize=0.3, subsamplingRate=1.0, featureSubsetStrategy="all", seed=42)


@pytest.fixture(scope="module")
def orders(spark):
    return materialize(c.split(spark, SF001))


def test_save_load_score(spark, orders, tmp_path):
    path = str(tmp_path / "scorer")
    train, new = (orders.filter(F.col("split") == x) for x in ("train", "test"))
    new = new.drop("split", "fold", "late_delivery_risk", "order_status").withColumn(
        "order_city", F.when(F.substring("row_key", 1, 1) == "a", F.lit("Atlantis")).otherwise(F.col("order_city")))
    first = bundle.fit_encoding(train)
    with pytest.raises(FileNotFoundError):
        bundle.load(spark, path)
    v1 = bundle.save(first, path)
    assert bundle.load(spark, path).model is None
    fitted = bundle.fit_model(train, SMALL)
    v2 = bundle.save(fitted, path)
    assert v1 != v2 and bundle.load(spark, path, v1).model is None
    again = bundle.load(spark, path)  # the version written last
    assert (again.text_columns, again.features) == (fitted.text_columns, fitted.features) and "order_status" in again.text_columns
    a, b = (bundle.score(new, x).select("row_key", "risk_score") for x in (fitted, again))
    assert a.exceptAll(b).count() == 0 and b.count() == new.count()
    counts = {r.column_name: (r.n_unseen, r.n_rows) for r in bundle.unseen(new, again).collect()}
    n = new.count()
    strange = new.filter(F.col("order_city") == "Atlantis").count()
    assert counts["order_city"][0] >= strange > 0 and counts["order_status"] == (n, n) and counts["shipping_mode"] == (0, n)

    # raw orders on a stream: scored with the saved bundle, a batch without a budget is set aside
    raw = new.withColumn("batch_id", F.col("order_country"))
    raw.write.parquet(str(tmp_path / "src"))
    budgets = spark.createDataFrame([(f"NATION_{i}", 30.0) for i in range(5)], "batch_id string, budget double")
    q = prescribe_stream.start(spark, str(tmp_path / "src"), raw.schema, budgets, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                               scorer=lambda batch: bundle.score(batch, again))
    q.awaitTermination(300)
    out, aside = spark.read.parquet(str(tmp_path / "out")), spark.read.parquet(str(tmp_path / "out") + "_rejected")
    paid = raw.join(budgets, "batch_id", "left_semi").count()
    assert 0 < out.count() == paid and aside.count() == n - paid
    assert all(r.s <= 30.05 for r in out.groupBy("batch_id").agg(F.sum("cost").alias("s")).collect())


def test_lowered_budget_does_not_stop_the_stream(spark, tmp_path):
    schema = "row_key string, order_id bigint, batch_id string, price double, profit double, risk_score double"
    first = spark.createDataFrame([("a", 1, "b", 60.0, 90.0, 0.9)], schema)
    later = spark.createDataFrame([("z", 2, "b", 60.0, 90.0, 0.9), ("y", 3, "x", 60.0, 90.0, 0.9)], schema)
    out = str(tmp_path / "out")
    for epoch, (rows, budget) in enumerate(((first, 20.0), (later, 1.0))):
        b = spark.createDataFrame([("b", budget)], "batch_id string, budget double")
        caps = spark.createDataFrame([("b", 1 - epoch)], "batch_id string, max_upgrades int")
        prescribe_stream.prescribe_micro_batch(b, out, capacities=caps)(rows, epoch)
    assert {(r.row_key, r.decision) for r in spark.read.parquet(out).collect()} == {("a", "upgrade"), ("z", "nothing")}
    assert [r.row_key for r in spark.read.parquet(out + "_rejected").collect()] == ["y"]


def test_range_rank_equals_window(spark, orders):
    rows = materialize(spark.range(3000).select((F.col("id") % 3).cast("string").alias("column_name"),
                                                F.md5(F.col("id").cast("string")).alias("value")))
    want = rows.withColumn("rank", (F.row_number().over(Window.partitionBy("column_name").orderBy("value")) - 1).cast("bigint"))
    for limit in (100, 2999, 10**6):
        got = range_rank(rows, "column_name", "value", max_window_rows=limit)
        assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == 3000
    cols = ["order_city", "product_name", "shipping_mode"]
    plain, ranged = fit_dictionary(orders, cols), fit_dictionary(orders, cols, max_window_rows=50)
    assert plain.count() == ranged.count() and plain.exceptAll(ranged.select(plain.columns)).count() == 0
