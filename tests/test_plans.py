"""Plan shape: the properties that matter at scale, read from the physical plan."""

from pyspark.sql import functions as F

from shipwise.operators import features as fe, ranking as rk
from shipwise.plans import catalog as c
from shipwise.sources.files import read_split, write_split
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    plan = _plan(c.q_delay_rate_by_mode(spark, SF001))
    lineitem_scan = [ln for ln in plan.splitlines() if "lineitem" in ln and "ReadSchema" in ln]
    assert lineitem_scan and "l_tax" not in lineitem_scan[0] and "l_returnflag" not in lineitem_scan[0]


def test_rank_has_no_single_partition_exchange(spark):
    df = c.cleaned(spark, SF001).withColumn("h", F.md5("row_key"))
    ranked = rk.rank_within(df, ["late_delivery_risk"], "h", "row_key", 2)
    ranked.collect()
    plan = _plan(ranked)
    assert "SinglePartition" not in plan
    assert "hashpartitioning(late_delivery_risk" in plan and "__bucket" in plan


def test_dictionary_join_is_broadcast(spark):
    enc = fe.build_feature_set(c.cleaned(spark, SF001))
    plan = _plan(enc)
    assert plan.count("BroadcastHashJoin") >= 8


def test_split_read_prunes_partitions(spark, tmp_dir):
    df = c.split(spark, SF001).select("row_key", "late_delivery_risk", "split")
    write_split(df, f"{tmp_dir}/split")
    test = read_split(spark, f"{tmp_dir}/split", "test")
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan
    assert test.count() == df.filter("split = 'test'").count()


def test_spread_only_for_tables_in_a_handful_of_files(spark, tmp_dir):
    from shipwise.sources.tables import read_table, spread
    one = read_table(spark, SF001, "lineitem")
    assert "RoundRobinPartitioning" in _plan(spread(one))
    many = f"{tmp_dir}/many"
    spark.range(0, 1000, numPartitions=6).write.parquet(many)
    df = spark.read.parquet(many)
    assert len(df.inputFiles()) == 6
    assert "RoundRobinPartitioning" not in _plan(spread(df))


def _shuffles_above(plan, table):
    """Hash exchanges between the root and the scan of ``table``, by the tree's indentation."""
    tree = [(len(ln) - len(ln.lstrip(" :+-")), ln) for ln in plan.splitlines() if ln.strip(" :+-")]
    at = next(i for i, (_, ln) in enumerate(tree) if "FileScan" in ln and f"{table}.parquet" in ln)
    depth, found = tree[at][0], 0
    for d, ln in reversed(tree[:at]):
        if d < depth:
            depth, found = d, found + ("Exchange hashpartitioning" in ln)
    return found


def test_lineitem_is_shuffled_twice_and_narrow(spark):
    from shipwise.sources.tables import shipments
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        plan = _plan(shipments(spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert _shuffles_above(plan, "lineitem") == 2
    assert _shuffles_above(plan, "orders") == 2
    assert "Exchange hashpartitioning(l_partkey" in plan and "Exchange hashpartitioning(l_orderkey" in plan


def test_csv_on_the_way_and_wide_landed_rows_are_compressed(spark, tmp_dir):
    import glob
    from shipwise.session import materialize
    from shipwise.sources import orders_csv
    df = spark.range(100).selectExpr("cast(id as string) as row_key", "id * 1.0d as price")
    orders_csv.write_csv(orders_csv.as_file_columns(df), f"{tmp_dir}/z", compression="gzip")
    assert glob.glob(f"{tmp_dir}/z/*.csv.gz")
    back = orders_csv.intake(spark, f"{tmp_dir}/z")
    assert back.quarantine.isEmpty()
    assert back.rows.select("row_key", "price").exceptAll(df).isEmpty() and back.rows.count() == 100
    assert all(".zstd." in f for f in back.rows.inputFiles())
    assert materialize(df, "zstd").count() == 100


def test_a_file_of_many_row_groups_is_not_spread(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from shipwise.sources.tables import spread
    rows = pa.table({"id": list(range(3200))})
    for groups in (4, 32):
        pq.write_table(rows, f"{tmp_dir}/g {groups}.parquet", row_group_size=3200 // groups)
    assert "RoundRobinPartitioning" in _plan(spread(spark.read.parquet(f"{tmp_dir}/g 4.parquet")))
    assert "RoundRobinPartitioning" not in _plan(spread(spark.read.parquet(f"{tmp_dir}/g 32.parquet")))


def test_closed_loop_by_key_joins_the_tables_once(spark):
    """What is left to run reads landed rows only: the joins behind the prescriptions are not run again for the outcomes."""
    plan = _plan(c.q_closed_loop_by_key(spark, SF001))
    assert "FileScan" in plan and "lineitem.parquet" not in plan


def test_landed_split_rows_hold_no_hash(spark):
    split = c.split(spark, SF001, "row_key", "late_delivery_risk", folds=False)
    assert spark.read.parquet(*split.inputFiles()).columns == ["row_key", "late_delivery_risk"]


def test_narrow_values_go_through_the_joins(spark):
    plan = c.shipments(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "__u1" not in plan


def test_exported_csv_is_removed_once_it_is_landed(spark):
    from shipwise.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/") + "/csv"
    p = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    before = len(fs.listStatus(p)) if fs.exists(p) else 0
    assert c.q_csv_shipments(spark, SF001).count() == 6000
    assert not fs.exists(p) or len(fs.listStatus(p)) == before
