"""Delayed outcomes: prescriptions meet the deliveries that are reported later.

Two streams, joined by key within the time a delivery may take. Prescriptions
whose delivery never came leave the state once the watermark has passed, with
a null label. Every prescription comes out once; a delivery reported again
within the watermark counts once. A delivery that comes after its prescription
has left is not in the stream's output: ``settle`` joins the stored rows again
with all deliveries, as a batch.

State is bounded by ``wait`` plus ``lateness`` of both streams. Prescriptions
without a key or time have no place in the join and come out as never delivered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import config as C
from ..operators.loop import join_outcomes


def join_streams(prescriptions: DataFrame, deliveries: DataFrame, key: str = "row_key",
                 label: str = C.TARGET_COL, wait: str = "30 days", lateness: str = "1 day") -> DataFrame:
    """Left outer join of (key, prescribed_at, ...) with (key, delivered_at, label)."""
    asked = prescriptions.drop(label).withWatermark("prescribed_at", lateness)
    came = (deliveries.filter(F.col(label).isNotNull())
            .select(F.col(key).alias("__key"), F.col("delivered_at"), F.col(label))
            .withWatermark("delivered_at", lateness).dropDuplicatesWithinWatermark(["__key"]))
    within = ((F.col(key) == F.col("__key")) & (F.col("delivered_at") >= F.col("prescribed_at"))
              & (F.col("delivered_at") <= F.col("prescribed_at") + F.expr(f"interval {wait}")))
    return asked.join(came, within, "leftOuter").drop("__key")


def start(spark: SparkSession, prescriptions_dir: str, prescriptions_schema: StructType, deliveries_dir: str,
          deliveries_schema: StructType, out_path: str, checkpoint_location: str, available_now: bool = True,
          **join_settings) -> StreamingQuery:
    """Parquet files of both kinds → rows with their outcome, appended exactly once."""
    read = lambda path, schema: spark.readStream.schema(schema).parquet(path)
    joined = join_streams(read(prescriptions_dir, prescriptions_schema), read(deliveries_dir, deliveries_schema), **join_settings)
    writer = joined.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def settle(stored: DataFrame, deliveries: DataFrame, key: str = "row_key", label: str = C.TARGET_COL) -> DataFrame:
    """The stream's rows with whatever deliveries are known by now, those that came too late included."""
    return join_outcomes(stored.drop("delivered_at"), deliveries, key, label)
