"""Scans of the test tables and the derived ``shipments`` view.

The test tables do not contain the reference's order-item table, so every
query runs on ``shipments``: one row per ``lineitem`` row, joined to its
order, customer, nation, region and part, with columns that stand in for
the reference's columns (see FIXTURES.md §B).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import hex_unit

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, max_files: int | None = None) -> DataFrame:
    """Scan parallelism floor: a table in a handful of files (the test tables
    are one file with one row group) would run every downstream narrow stage
    in one task; spread it round-robin once. A table in more files than that
    is left alone however many task slots there are: a large table lands in
    many files and the scan already splits them by row group, so spreading
    it would only add a full shuffle. So it is with a few files of at least two
    row groups a slot."""
    limit = C.KNOBS.spread_max_files if max_files is None else max_files
    slots = df.sparkSession.sparkContext.defaultParallelism
    files = df.inputFiles()
    if len(files) > limit or len(files) >= slots or row_groups(df.sparkSession, files) >= 2 * slots:
        return df
    return df.repartition(slots)


def row_groups(spark: SparkSession, files: list[str]) -> int:
    """Row groups of some Parquet files, by their footers."""
    jvm, conf, n = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
            jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        try:
            n += reader.getRowGroups().size()
        finally:
            reader.close()
    return n


def _d(x: float):
    """A double literal (so that p ± 0.03 is double arithmetic everywhere)."""
    return F.lit(float(x))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived order-item table every query reads.

    Plan: (lineitem ⋈ part) ⋈ (orders ⋈ customer) are large-to-large joins left
    to Catalyst/AQE (sort-merge, or broadcast when Spark's own size statistics
    allow it), so lineitem, by far the most rows, is shuffled twice at most, and
    narrow: before its orders' columns are there, and with its key as 16 bytes.
    nation (25 rows) and region (5 rows) have a size fixed by the schema and are
    broadcast explicitly. Only the columns used are read.
    """
    li = spread(read_table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_linestatus", "l_shipdate")
    # the key and its hash-derived uniforms depend on lineitem alone: compute
    # them before the joins, so filters pushed into join conditions refer to
    # plain columns instead of re-evaluating md5 per reference
    li = li.withColumn("__md5", F.md5(F.concat_ws(
        "|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
        F.col("l_shipdate").cast("date").cast("string"))))
    li = li.withColumns({"__u2": hex_unit("__md5", 9), "__u3": hex_unit("__md5", 17)})
    u2, u3 = F.col("__u2"), F.col("__u3")
    # what is shuffled: 16 bytes for 32 hex digits (the first uniform is read off them again), and the other
    # uniforms' bands, as only bands are asked for
    li = li.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_linestatus", "l_shipdate", F.unhex("__md5").alias("__key"),
        F.when(u2 < _d(0.001), F.lit(0)).when(u2 < _d(0.0015), F.lit(1))
         .when(u2 > _d(0.999), F.lit(3)).otherwise(F.lit(2)).alias("__band2"),
        F.when(u3 < _d(0.86), F.lit(0)).when(u3 < _d(0.95), F.lit(1))
         .when(u3 < _d(0.99), F.lit(2)).otherwise(F.lit(3)).alias("__band3"))
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    pa = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")

    items = li.join(pa, li.l_partkey == pa.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate", "__key", "__band2", "__band3",
        "p_name", "p_brand", "p_type",
        # whole cents until after the last shuffle: they pack better than doubles
        F.floor(F.col("l_extendedprice") / F.col("l_quantity") + F.lit(0.5)).alias("__price"),
        F.floor((F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
                 - F.col("p_retailprice") * F.col("l_quantity")) / F.lit(10.0) + F.lit(0.5)).alias("__profit"))
    placed = od.join(cu, od.o_custkey == cu.c_custkey)
    j = (items.join(placed, items.l_orderkey == placed.o_orderkey)
         .join(F.broadcast(na), F.col("c_nationkey") == na.n_nationkey)
         .join(F.broadcast(rg), na.n_regionkey == rg.r_regionkey))

    u1, band2, band3 = hex_unit(F.hex("__key"), 1), F.col("__band2"), F.col("__band3")

    mode = F.col("o_orderpriority")
    base_p = (F.when(mode == "1-URGENT", _d(0.95)).when(mode == "2-HIGH", _d(0.76))
              .when(mode == "3-MEDIUM", _d(0.50)).when(mode == "4-NOT SPECIFIED", _d(0.45))
              .otherwise(_d(0.40)))
    p_late = (F.when(F.col("p_type") == "PROMO", base_p + _d(0.03))
              .when(F.col("p_type") == "SMALL", base_p - _d(0.03))
              .otherwise(base_p))
    j = j.withColumn("__late", F.when(u1 < p_late, F.lit(1)).otherwise(F.lit(0)))
    late = F.col("__late")
    days_scheduled = (F.when(mode == "1-URGENT", F.lit(0)).when(mode == "2-HIGH", F.lit(1))
                      .when(mode == "3-MEDIUM", F.lit(2)).otherwise(F.lit(4)))

    out = j.select(
        F.lower(F.hex("__key")).alias("row_key"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("p_name").alias("product_name"),
        F.when(band2 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_name")).alias("customer_lname"),
        F.when(band2 == 1, F.lit(None).cast("bigint"))
         .otherwise(F.lit(10000) + F.col("c_custkey") % 90000).cast("bigint")
         .alias("customer_zipcode"),
        F.when(band3 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.lit(10000) + F.col("o_orderkey") % 90000).cast("bigint")
         .alias("order_zipcode"),
        F.lit(None).cast("string").alias("product_description"),
        mode.alias("shipping_mode"),
        days_scheduled.cast("int").alias("days_scheduled"),
        late.cast("int").alias("late_delivery_risk"),
        (days_scheduled + F.when(late == 1, F.lit(1) + F.col("l_linenumber") % 3)
         .otherwise(F.lit(0))).cast("int").alias("days_real"),
        F.when(band3 == 3, F.lit(None).cast("string"))
         .when(band3 == 2, F.lit("Shipping canceled"))
         .when(late == 1, F.lit("Late")).otherwise(F.lit("On time")).alias("delivery_status"),
        F.col("r_name").alias("order_region"),
        F.col("n_name").alias("order_country"),
        F.concat(F.col("n_name"), F.lit("-"), (F.col("c_custkey") % 50).cast("string"))
         .alias("order_city"),
        F.when(band2 == 3, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("category_name"),
        F.col("p_brand").alias("department_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("l_linestatus").alias("payment_type"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipping_date"),
        (F.col("__price").cast("double") / F.lit(100.0)).alias("price"),
        (F.col("__profit").cast("double") / F.lit(100.0)).alias("profit"),
    )
    return out
