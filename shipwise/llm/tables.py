"""Small helpers the operators share: landing tables, checked broadcasts, tidy columns."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipwise.session import materialize, ship_package

#: Rows per Arrow batch: texts are long rows, and a Python worker holds a few batches at a time.
ARROW_ROWS = "2000"
#: A side is broadcast only if it was counted and has at most so many rows (of a few longs each).
BROADCAST_ROWS = 1_000_000

#: What Python workers, which serve many tasks, keep from one task to the next: tables of known pieces.
WORKER_TABLES = {"shipwise.llm.byte_bpe": "_CODERS", "shipwise.llm.token_counts": "_COUNTERS"}

__all__ = ["BROADCAST_ROWS", "bounded", "discard", "kept", "land", "lean", "pick", "release_memory", "release_worker_tables", "unkept"]


def land(df: DataFrame) -> DataFrame:
    """Write to the shared folder of spark.checkpoint.dir and read back: lineage ends in files
    that every executor can read, so a lost executor costs only its running tasks."""
    return materialize(df)


def discard(*landed: DataFrame) -> None:
    """Delete landed tables that no later plan reads, and let Spark delete the shuffle files of the
    plans that made them (it does so when the driver's JVM finds them unused)."""
    gc.collect()
    for df in landed:
        spark = df.sparkSession
        folder = {f.rsplit("/", 1)[0] for f in df.inputFiles()}  # one folder of one table
        for f in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if landed:
        landed[0].sparkSession._jvm.System.gc()


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (landed, narrow) marked for broadcast if its count is small, else as it is: the join
    then shuffles, and skewed keys are split by the adaptive planner."""
    return F.broadcast(df) if df.count() <= rows else df


def prepare(spark: SparkSession) -> None:
    """What the Python workers of the session need: this package, and batches of bounded size."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > int(ARROW_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def release_memory() -> None:
    """Gives back what earlier tasks of this worker freed and Arrow's pool or the C library still holds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def release_worker_tables() -> None:
    """In a task that needs memory of its own: drops what an encoder left in this worker."""
    for module, name in WORKER_TABLES.items():
        tables = getattr(sys.modules.get(module), name, None)
        if tables:
            tables.clear()
            gc.collect()
    release_memory()


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], tables: bool = False):
    """The function of a mapInArrow, in a worker that gives back its memory: before the task what an encoder
    left (unless it needs these ``tables`` itself), and after it what the task freed, as idle workers stay
    beside the JVM while other stages run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory() if tables else release_worker_tables()
        try:
            yield from task(batches)
        finally:
            release_memory()
    return run


def pick(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under fixed names, so that clashing extra columns cannot matter."""
    prepare(docs.sparkSession)
    return docs.select(*[docs[old].alias(new) for new, old in columns.items()])


KEPT = "kept_"


def kept(docs: DataFrame, keep: tuple[str, ...]) -> tuple[dict[str, str], list[T.StructField]]:
    """For pick(): the columns in ``keep`` under a prefix; and their fields, for a map's schema."""
    names = {KEPT + c: c for c in keep}
    return names, [T.StructField(new, docs.schema[old].dataType) for new, old in names.items()]


def unkept(df: DataFrame, like: DataFrame) -> DataFrame:
    """The kept columns under their own names, in the order of ``like``."""
    return df.select(*[df[KEPT + c].alias(c) for c in like.columns])
