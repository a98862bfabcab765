"""Session helpers.

The library never overrides settings a cluster already provides; it only
fills in what is unset (as in tests and local benches).
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "shipwise",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session (tests, benches), whose driver is its only executor,
    gets a scratch folder if the setting is missing; on a cluster that is an
    error, because executors do not share a folder of the driver's machine.
    """
    sc = spark.sparkContext
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if not wanted:
        if sc.getCheckpointDir():
            return sc.getCheckpointDir()
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        wanted = tempfile.mkdtemp(prefix="shipwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", wanted)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(wanted)
    return sc.getCheckpointDir() or wanted


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not find it on their own path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="shipwise-pkg-")).resolve() / "shipwise_pkg.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, str(p.relative_to(top.parent)))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def materialize(df, compression=None):
    """Cut lineage at a reuse boundary: write the rows as a Parquet table in
    the shared checkpoint folder and read it back (survives lost executors,
    never a machine-local or local checkpoint; later reads prune columns and
    push filters into the scan). ``compression``: a Parquet codec other than
    the session's, for wide rows."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.parquet(path)
