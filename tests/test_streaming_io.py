"""JSON sink/source, write-back and the streaming prescription driver."""

from pyspark.sql import functions as F

from shipwise.operators.prescribe import (batch_summary, flat_records, nested_records,
                                          nested_summary, prescribe)
from shipwise.plans import catalog as c
from shipwise.sources.files import read_prescriptions_json, write_back, write_prescriptions_json
from shipwise.streaming import prescribe_stream
from tests.conftest import SF001


def test_json_round_trip(spark, tmp_dir):
    out = prescribe(c.batched(spark, SF001))
    flat = flat_records(out["decisions"])
    orders = nested_records(flat)
    summary = nested_summary(batch_summary(out["decisions"], out["budgets"]))
    write_prescriptions_json(orders, summary, f"{tmp_dir}/json")
    o2, s2 = read_prescriptions_json(spark, f"{tmp_dir}/json", orders.schema, summary.schema)
    assert o2.count() == flat.count()
    assert s2.count() == summary.count()
    one = o2.filter(F.col("order.decision") == "discount").first()
    assert one.order.cost == one.order.options.discount.cost


def test_write_back_replaces_only_its_partitions(spark, tmp_dir):
    p = f"{tmp_dir}/wb"
    a = spark.createDataFrame([("x", 1), ("y", 2)], "batch_id string, v int")
    write_back(a, p)
    write_back(spark.createDataFrame([("x", 9)], "batch_id string, v int"), p)
    got = {(r.batch_id, r.v) for r in spark.read.parquet(p).collect()}
    assert got == {("x", 9), ("y", 2)}


def test_stream_prescriptions(spark, tmp_dir):
    scored = c.batched(spark, SF001).select("row_key", "order_id", "batch_id", "price", "profit",
                                            "risk_score", "late_delivery_risk")
    src = f"{tmp_dir}/src"
    scored.filter(F.col("batch_id") < "NATION_2").write.parquet(src + "/part1")
    budgets = spark.createDataFrame([(f"NATION_{i}", 50.0) for i in range(25)],
                                    "batch_id string, budget double")
    q = prescribe_stream.start(spark, src + "/part1", scored.schema, budgets,
                               f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination(300)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == scored.filter(F.col("batch_id") < "NATION_2").count()
    spent = out.groupBy("batch_id").agg(F.sum("cost").alias("s")).collect()
    assert all(r.s <= 50.0 + 0.05 for r in spent)


def test_stream_prescriptions_with_capacity(spark, tmp_dir):
    scored = c.batched(spark, SF001).select("row_key", "order_id", "batch_id", "price", "profit",
                                            "risk_score", "late_delivery_risk")
    src = f"{tmp_dir}/src"
    part = scored.filter(F.col("batch_id") < "NATION_2")
    part.write.parquet(src + "/part1")
    budgets = spark.createDataFrame([(f"NATION_{i}", 50.0) for i in range(25)],
                                    "batch_id string, budget double")
    caps = spark.createDataFrame([(f"NATION_{i}", 1) for i in range(25)],
                                 "batch_id string, max_upgrades int")
    q = prescribe_stream.start(spark, src + "/part1", scored.schema, budgets,
                               f"{tmp_dir}/out", f"{tmp_dir}/ckpt", capacities=caps)
    q.awaitTermination(300)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == part.count()
    per = out.groupBy("batch_id").agg(F.sum("cost").alias("s"),
                                      F.count_if(F.col("decision") == "upgrade").alias("u")).collect()
    assert all(r.s <= 50.0 + 0.05 and r.u <= 1 for r in per)


SCORED = ("row_key string, order_id bigint, batch_id string, price double, profit double, "
          "risk_score double")


def test_stream_keeps_a_batch_that_comes_in_two_files(spark, tmp_dir):
    """Both parts stay, share one budget and one set of slots, and a replay changes nothing."""
    out = f"{tmp_dir}/two"
    budgets = spark.createDataFrame([("b", 12.0)], "batch_id string, budget double")
    caps = spark.createDataFrame([("b", 1)], "batch_id string, max_upgrades int")
    parts = [[("s1", 1, "b", 60.0, 90.0, 0.9), ("s2", 2, "b", 80.0, 70.0, 0.5)],
             [("s3", 3, "b", 40.0, 95.0, 0.8), ("s4", 4, "b", 50.0, None, 0.7)],
             [("s5", 5, "b", 40.0, 99.0, 0.9)]]
    run = prescribe_stream.prescribe_micro_batch(budgets, out, capacities=caps)

    def rows(path, *cols):
        return sorted(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())

    for epoch, part in enumerate(parts):
        run(spark.createDataFrame(part, SCORED), epoch)
    got = rows(out, "row_key", "decision", "cost", "epoch_id")
    assert [r[0] for r in got] == ["s1", "s2", "s3", "s5"]
    assert sum(r[2] for r in got) <= 12.0
    assert sum(r[1] == "upgrade" for r in got) <= 1
    assert rows(out + "_rejected", "row_key", "epoch_id") == [("s4", 1)]
    spent = rows(out + "_spent", "epoch_id", "spent", "used")
    run(spark.createDataFrame(parts[1], SCORED), 1)  # replay of the second micro-batch
    assert rows(out, "row_key", "decision", "cost", "epoch_id") == got
    assert rows(out + "_spent", "epoch_id", "spent", "used") == spent
