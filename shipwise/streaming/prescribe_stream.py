"""Prescriptions for orders that keep arriving (Structured Streaming).

The reference prescribes one batch at a time; here new scored orders land as
files and every micro-batch is allocated. A batch may arrive in any number of
micro-batches: each one gets what the earlier ones left of its budget and
upgrade slots.

Three tables, partitioned by (batch_id, epoch_id) and written by dynamic
partition overwrite, so that a micro-batch replayed after a failure rewrites
its own partitions and touches no others:

* ``out_path``: the records;
* ``out_path`` + ``_rejected``: orders whose price, profit or risk is missing,
  or whose batch has no budget
  (batch_id, epoch_id, row_key, order_id, price, profit, risk_score);
* ``out_path`` + ``_spent``: money and upgrade slots used per batch and
  micro-batch, a ledger for readers.

What a micro-batch may still spend comes from ``out_path`` + ``_balance``: one
row per batch with all it used so far, as of an epoch. Each micro-batch adds its
amounts to the newest balance of an earlier epoch and writes its own, so a replay
allocates the same amounts; only the two newest balances are kept, so the state
does not grow with the number of micro-batches.

A budget (or slot limit) lowered below what is used counts as nothing left.
With ``scorer``, a function of the micro-batch such as ``bundle.score`` with a
saved bundle, raw orders are scored first.

Epochs count up in one checkpoint location: a new location needs a new
``out_path``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.allocate import MONEY
from ..operators.prescribe import flat_records, prescribe
from ..session import materialize
from ..sources.files import path_exists, write_back

SINK_PARTITIONS = ("batch_id", "epoch_id")
BALANCE_SCHEMA = "batch_id string, spent decimal(20,4), used bigint"
SPENT_SCHEMA = "spent decimal(20,4), used bigint, batch_id string, epoch_id bigint"


def _balances(spark: SparkSession, path: str) -> list[int]:
    """Epochs of the stored balances, in order (two, or three after a failure)."""
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in found]
    return sorted(int(n.removeprefix("epoch=")) for n in names if n.startswith("epoch="))


def used_before(spark: SparkSession, out_path: str, epoch_id: int) -> DataFrame:
    """Money and upgrade slots each batch used in earlier micro-batches: one row per batch.
    Without a balance (output of an earlier version) the ledger is summed once."""
    earlier = [e for e in _balances(spark, f"{out_path}_balance") if e < epoch_id]
    if earlier:
        return spark.read.schema(BALANCE_SCHEMA).parquet(f"{out_path}_balance/epoch={earlier[-1]}")
    ledger = f"{out_path}_spent"
    spent = (spark.read.schema(SPENT_SCHEMA).parquet(ledger) if path_exists(spark, ledger)
             else spark.createDataFrame([], SPENT_SCHEMA))
    return (spent.filter(F.col("epoch_id") < epoch_id).groupBy("batch_id")
            .agg(F.sum("spent").cast(MONEY).alias("spent"), F.sum("used").alias("used")))


def advance_balance(before: DataFrame, amounts: DataFrame, out_path: str, epoch_id: int) -> None:
    """Write the balance after this micro-batch, then drop all but it and the one it came from."""
    spark = before.sparkSession
    path = f"{out_path}_balance"
    (before.select("batch_id", "spent", "used").unionByName(amounts.select("batch_id", "spent", "used"))
     .groupBy("batch_id").agg(F.sum("spent").cast(MONEY).alias("spent"), F.sum("used").alias("used"))
     .write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}"))
    for old in [e for e in _balances(spark, path) if e < epoch_id][:-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/epoch={old}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def prescribe_micro_batch(budgets: DataFrame, out_path: str, fill_rounds: int | None = None,
                          capacities: DataFrame | None = None,
                          scorer: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch function: allocate the micro-batch within what earlier
    ones left, write its records, rejected orders and the amounts used.
    ``capacities`` (batch_id, max_upgrades) adds the upgrade-slot limit."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        if scorer is not None:
            batch = materialize(scorer(batch))
        ids = batch.select("batch_id").distinct()
        before = used_before(spark, out_path, epoch_id)
        b = (budgets.join(ids, "batch_id").join(before, "batch_id", "left")
             .select("batch_id", F.greatest(F.col("budget").cast(MONEY) - F.coalesce("spent", F.lit(0).cast(MONEY)),
                                            F.lit(0).cast(MONEY)).alias("budget")).filter(F.col("budget").isNotNull()))
        b = materialize(b)
        unpaid = batch.join(b, "batch_id", "left_anti")
        batch = batch.join(b.select("batch_id"), "batch_id", "left_semi")
        caps = None
        if capacities is not None:
            caps = (capacities.join(ids, "batch_id").join(before, "batch_id", "left")
                    .select("batch_id", F.greatest(F.col("max_upgrades").cast("bigint") - F.coalesce("used", F.lit(0)),
                                                   F.when(F.col("max_upgrades").isNotNull(), F.lit(0))).alias("max_upgrades")))
        out = prescribe(batch, budgets=b, fill_rounds=fill_rounds, capacities=caps)
        epoch = F.lit(epoch_id).cast("bigint").alias("epoch_id")
        decisions = materialize(out["decisions"])
        write_back(flat_records(decisions).select("*", epoch), out_path, SINK_PARTITIONS)
        rejected = ["row_key", "order_id", "price", "profit", "risk_score", "batch_id", epoch]
        write_back(out["rejected"].select(*rejected).unionByName(unpaid.select(*rejected)),
                   f"{out_path}_rejected", SINK_PARTITIONS)
        amounts = materialize(decisions.groupBy("batch_id").agg(
            F.sum("cost").cast(MONEY).alias("spent"),
            F.count_if(F.col("decision") == "upgrade").alias("used")))
        write_back(amounts.select("*", epoch), f"{out_path}_spent", SINK_PARTITIONS)
        advance_balance(before, amounts, out_path, epoch_id)
    return run


def start(spark: SparkSession, source_dir: str, schema: StructType, budgets: DataFrame,
          out_path: str, checkpoint_location: str, available_now: bool = True,
          fill_rounds: int | None = None,
          capacities: DataFrame | None = None,
          scorer: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Stream scored orders (Parquet files) → allocation → partitioned records; with ``scorer`` raw orders."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = (stream.writeStream
              .foreachBatch(prescribe_micro_batch(budgets, out_path, fill_rounds, capacities, scorer))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
