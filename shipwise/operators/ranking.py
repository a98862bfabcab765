"""Ranking primitives that never sort a whole (possibly huge) group in one task.

* ``rank_within`` — 0-based rank of each row inside its partition by a hex
  hash. Bucket = hex prefix of the hash (a pure, order-preserving function
  of the sort key, so ties stay together and a recomputed stage gives the
  same bucket). Per-bucket counts → running offsets over buckets (a table
  bounded by the bucket count) → window inside (partition, bucket) only.
* ``take_until`` — rows in a given order while the running weight stays
  within a capacity. Small partitions: one window. Large partitions: weight
  per order-preserving bucket, running sum over buckets, take buckets before
  the crossing one whole, run the exact window only inside the crossing
  bucket (refining the bucket when that is still large).

Both return exactly what the plain window returns.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import seeded_hash
from ..session import materialize


def bounded_broadcast(df: DataFrame, max_rows: int | None = None,
                      rows: int | None = None) -> DataFrame:
    """Materialise a small derived table (lineage cut) and broadcast it only if
    its row count is within the bound; otherwise leave the join to a shuffle.
    ``rows``: the row count when the caller already knows it exactly (saves
    the counting job)."""
    max_rows = C.KNOBS.max_broadcast_rows if max_rows is None else max_rows
    df = materialize(df)
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= max_rows else df


def hex_digits_for(n_rows: int, rows_per_bucket: int | None = None) -> int:
    per = rows_per_bucket or C.KNOBS.rows_per_bucket
    if n_rows <= per:
        return 1
    return min(8, max(1, math.ceil(math.log(n_rows / per, 16))))


def rank_within(df: DataFrame, part_cols, hash_col: str, key_col: str,
                digits: int, rank_col: str = "rank") -> DataFrame:
    """0-based rank inside ``part_cols`` by (hash_col, key_col)."""
    part_cols = list(part_cols)
    b = "__bucket"
    with_b = df.withColumn(b, F.substring(F.col(hash_col), 1, digits))
    counts = with_b.groupBy(*part_cols, b).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*part_cols).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part_cols, b, F.coalesce(F.sum("__n").over(before), F.lit(0))
                            .cast("bigint").alias("__off"))
    offsets = bounded_broadcast(offsets)
    inner = Window.partitionBy(*part_cols, b).orderBy(hash_col, key_col)
    return (with_b.join(offsets, on=[*part_cols, b])
            .withColumn(rank_col, (F.col("__off") + F.row_number().over(inner) - 1).cast("bigint"))
            .drop(b, "__off"))


def range_rank(df: DataFrame, part_col: str, value_col: str, rank_col: str = "rank",
               max_window_rows: int | None = None) -> DataFrame:
    """0-based rank of ``value_col`` inside ``part_col``, for (landed) rows that do not repeat.

    One window while the rows fit; beyond that ranges of (part, value) by
    sampled boundaries, their counts as offsets (a table of as many rows as
    there are ranges and parts), and a window inside each range only.
    """
    limit = C.KNOBS.max_window_rows if max_window_rows is None else max_window_rows
    n = df.count()
    if n <= limit:
        w = Window.partitionBy(part_col).orderBy(value_col)
        return df.withColumn(rank_col, (F.row_number().over(w) - 1).cast("bigint"))
    r = "__range"
    dealt = materialize(df.repartitionByRange(-(-n // limit), part_col, value_col).withColumn(r, F.spark_partition_id()))
    before = Window.partitionBy(part_col).orderBy(r).rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(part_col, r).agg(F.count(F.lit(1)).alias("__n"))
    offsets = bounded_broadcast(offsets.select(part_col, r, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")))
    inner = Window.partitionBy(part_col, r).orderBy(value_col)
    return (dealt.join(offsets, [part_col, r])
            .withColumn(rank_col, (F.col("__off") + F.row_number().over(inner) - 1).cast("bigint")).drop(r, "__off"))


def largest_remainder(counts: dict, num: int, den: int) -> dict:
    """Share k = ceil(N·num/den) over classes by largest remainder (exact ints)."""
    n = sum(counts.values())
    k = -(-n * num // den)
    base = {c: (k * m) // n for c, m in counts.items()}
    rem = {c: (k * m) % n for c, m in counts.items()}
    left = k - sum(base.values())
    for c in sorted(counts, key=lambda c: (-rem[c], c))[:left]:
        base[c] += 1
    return base


def _test_rows(k: dict, label: str):
    """Test rows of the row's class, as a column."""
    out = F.lit(0)
    for c, n in sorted(k.items()):
        out = F.when(F.col(label) == F.lit(c), F.lit(n)).otherwise(out)
    return out


def _last_of_class(base: DataFrame, fine: DataFrame, k: dict, label: str, key: str) -> list:
    """(class, hash, key) of the k-th row of each class that has a k: one row a class."""
    before = Window.partitionBy(label).orderBy("__fb").rowsBetween(Window.unboundedPreceding, -1)
    holds = (fine.withColumns({"__off": F.coalesce(F.sum("__n").over(before), F.lit(0)), "__k": _test_rows(k, label)})
             .filter((F.col("__off") < F.col("__k")) & (F.col("__k") <= F.col("__off") + F.col("__n")))
             .select(F.col(label).alias("__c"), "__fb", "__off", "__k"))
    inside = base.join(bounded_broadcast(holds), (F.col(label) == F.col("__c")) & (F.substring("__h", 1, 4) == F.col("__fb")))
    rank = F.col("__off") + F.row_number().over(Window.partitionBy("__c").orderBy("__h", key))
    return inside.select("__c", "__h", F.col(key).alias("__key"), "__k", rank.alias("__r")).filter("__r = __k").collect()


def _up_to(last: list, base: DataFrame, label: str, key: str):
    """Is the row at or before its class's last row? (hash, key) is a total order."""
    out, type_ = F.lit(False), base.schema[key].dataType
    for r in last:
        same = (F.col("__h") == r["__h"]) & (F.col(key) <= F.lit(r["__key"]).cast(type_))
        out = F.when(F.col(label) == r["__c"], (F.col("__h") < r["__h"]) | same).otherwise(out)
    return out


def stratified_split(df: DataFrame, label: str = C.TARGET_COL, key: str = "row_key",
                     seed: int = C.SPLIT_SEED, num: int = C.TEST_FRACTION_NUM,
                     den: int = C.TEST_FRACTION_DEN, n_folds: int = C.N_FOLDS,
                     folds: bool = True, landed: bool = False) -> DataFrame:
    """Adds ``split`` ('train'/'test') and ``fold`` (train rows only). Rows without a label have no class and are left out.

    Within each class rows are ordered by md5(seed|key); the first k_class are
    test, k shared over classes by largest remainder; the train rows' fold is
    their rank among train rows modulo n_folds.

    The input runs once: its rows are landed, so pass only the columns that are
    needed, or ``landed`` rows. Their hash is cheaper computed again than kept. Two passes over the landed rows follow: (1)
    counts per (class, 4-hex-digit bucket), a table bounded by 2 × 65,536
    rows, from which the class sizes and the bucket offsets are derived; (2)
    the rank inside (class, bucket). Without ``folds`` only the last test row
    of each class is looked for, in the one bucket that holds it, and every
    row is told by comparing it with that row: nothing else is shuffled.
    """
    h, fb = "__h", "__fb"
    rows = df.filter(F.col(label).isNotNull())
    base = (rows if landed else materialize(rows, "zstd")).withColumn(h, seeded_hash(seed, key))
    fine = materialize(base.groupBy(label, F.substring(h, 1, 4).alias(fb))
                       .agg(F.count(F.lit(1)).alias("__n")))
    counts = {r[0]: r[1] for r in fine.groupBy(label).agg(F.sum("__n")).collect()}
    k = largest_remainder(counts, num, den)
    if not folds:
        last = _last_of_class(base, fine, k, label, key)
        split = F.when(_up_to(last, base, label, key), F.lit("test")).otherwise(F.lit("train"))
        return base.withColumn("split", split).drop(h)
    digits = min(4, hex_digits_for(sum(counts.values())))
    b = "__bucket"
    per_b = fine.groupBy(label, F.substring(fb, 1, digits).alias(b)).agg(F.sum("__n").alias("__n"))
    before = Window.partitionBy(label).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = bounded_broadcast(per_b.select(
        label, b, F.coalesce(F.sum("__n").over(before), F.lit(0)).cast("bigint").alias("__off")))
    inner = Window.partitionBy(label, b).orderBy(h, key)
    ranked = (base.withColumn(b, F.substring(h, 1, digits)).join(offsets, on=[label, b])
              .withColumn("__rank", (F.col("__off") + F.row_number().over(inner) - 1).cast("bigint")))
    kc = _test_rows(k, label)
    return (ranked
            .withColumn("split", F.when(F.col("__rank") < kc, F.lit("test")).otherwise(F.lit("train")))
            .withColumn("fold", F.when(F.col("__rank") >= kc,
                                       F.pmod(F.col("__rank") - kc, F.lit(n_folds)).cast("int")))
            .drop(h, b, "__off", "__rank"))


def sample_orders(df: DataFrame, n: int = C.DEFAULT_BATCH_ORDERS,
                  seed: int = C.DEFAULT_SAMPLE_SEED, key: str = "row_key",
                  strict: bool = True) -> DataFrame:
    """Exactly n rows without replacement, reproducible by seed.

    Planned as TakeOrderedAndProject: each task keeps its n best, one merge.
    Like the reference, asking for more rows than exist is an error.
    """
    if strict and df.limit(n).count() < n:
        raise ValueError(f"cannot sample {n} rows: fewer rows available")
    return df.orderBy(seeded_hash(seed, key), F.col(key)).limit(n)


# --------------------------------------------------------------------------
# take_until
# --------------------------------------------------------------------------

FREE_BUCKET = -(2 ** 62)


def _eff_bucket(paid_col: str, neg_eff_col: str, res: int):
    """Order-preserving bucket of (paid, neg_eff): free rows first, then by
    efficiency on a log scale with ``res`` buckets per doubling."""
    eff = -F.col(neg_eff_col)
    return (F.when(F.col(paid_col) == 0, F.lit(FREE_BUCKET))
            .otherwise(-F.floor(F.log2(eff) * F.lit(float(res))))).cast("bigint")


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def _within(run_cols, cap_cols):
    ok = F.lit(True)
    for r, c in zip(run_cols, cap_cols):
        ok = ok & (r <= F.col(c))
    return ok


def take_until_window(df: DataFrame, part_cols, ord_col: str, weight_col, cap_col,
                      out_col: str = "taken") -> DataFrame:
    w = (Window.partitionBy(*part_cols).orderBy(ord_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ws, cs = _as_list(weight_col), _as_list(cap_col)
    return df.withColumn(out_col, _within([F.sum(x).over(w) for x in ws], cs))


def _by_ranges(df: DataFrame, part_cols, ord_col: str, bucket: str, limit: int) -> DataFrame:
    """Rows dealt into ranges of (partition, order) by sampled bounds and landed, so that the range
    of a row does not change. The order is total, so equal efficiencies fall apart here too."""
    n = df.count()
    ranges = max(2, min(C.KNOBS.take_until_ranges, 2 * -(-n // limit)))
    return materialize(df.repartitionByRange(ranges, *part_cols, ord_col)
                       .withColumn(bucket, F.spark_partition_id().cast("bigint")))


def take_until(df: DataFrame, part_cols, ord_col: str, weight_col, cap_col,
               paid_col: str, neg_eff_col: str, out_col: str = "taken",
               max_window_rows: int | None = None, res: int = 64,
               max_part_rows: int | None = None, _depth: int = 0) -> DataFrame:
    """Rows (ordered by ``ord_col`` inside ``part_cols``) are taken while the
    running sum of ``weight_col`` ≤ ``cap_col``; with lists of weights and
    caps, while every running sum is within its cap (still a prefix, since
    weights are ≥ 0 and every running sum only grows).

    ``ord_col`` must start with (paid, neg_eff) so that the efficiency bucket
    is monotone in it, and must be total. ``max_part_rows`` (largest
    partition), when known, saves the counting pass that picks the plan.

    The first split is by efficiency and moves no rows. If the crossing bucket
    is still large (many equal efficiencies, free steps under a slot limit) its
    rows are dealt into ranges of the whole order, as often as needed.
    """
    part_cols = list(part_cols)
    ws, cs = _as_list(weight_col), _as_list(cap_col)
    limit = C.KNOBS.max_window_rows if max_window_rows is None else max_window_rows
    if max_part_rows is None:
        max_part_rows = (df.groupBy(*part_cols).agg(F.count(F.lit(1)).alias("n"))
                         .agg(F.max("n")).first()[0] or 0)
    if max_part_rows <= limit:
        return take_until_window(df, part_cols, ord_col, ws, cs, out_col)

    b, st = f"__b{_depth}", f"__st{_depth}"
    wsum = [f"__w{_depth}_{i}" for i in range(len(ws))]
    bf = [f"__bf{_depth}_{i}" for i in range(len(ws))]
    cap_in = [f"__cap{_depth}_{i}" for i in range(len(ws))]
    if _depth == 0:
        with_b = df.withColumn(b, _eff_bucket(paid_col, neg_eff_col, res))
    else:
        with_b = _by_ranges(df, part_cols, ord_col, b, limit)
    per_bucket = with_b.groupBy(*part_cols, *cs, b).agg(
        *[F.sum(x).alias(y) for x, y in zip(ws, wsum)], F.count(F.lit(1)).alias("__n"))
    before = (Window.partitionBy(*part_cols).orderBy(b)
              .rowsBetween(Window.unboundedPreceding, -1))
    status = per_bucket.select(
        *part_cols, b, "__n", *wsum, *cs,
        *[F.coalesce(F.sum(y).over(before), F.lit(0)).alias(z) for y, z in zip(wsum, bf)])
    status = status.select(
        *part_cols, b, "__n", *bf,
        F.when(_within([F.col(z) + F.col(y) for y, z in zip(wsum, bf)], cs), F.lit("all"))
         .when(_within([F.col(z) for z in bf], cs), F.lit("cross"))
         .otherwise(F.lit("none")).alias(st))
    status = bounded_broadcast(status)
    joined = with_b.join(status.drop("__n"), on=[*part_cols, b])

    settled = joined.filter(F.col(st) != "cross").withColumn(out_col, F.col(st) == "all")
    crossing = (joined.filter(F.col(st) == "cross")
                .select(*df.columns, b,
                        *[(F.col(c) - F.col(z)).alias(y) for c, z, y in zip(cs, bf, cap_in)]))
    max_cross = (status.filter(F.col(st) == "cross").agg(F.max("__n")).first()[0] or 0)
    if _depth > 0 and max_cross >= max_part_rows:  # rows of one order key: nothing is left to split by
        inner = take_until_window(crossing, [*part_cols, b], ord_col, ws, cap_in, out_col)
    else:
        inner = take_until(crossing, [*part_cols, b], ord_col, ws, cap_in,
                           paid_col, neg_eff_col, out_col, limit, res,
                           max_part_rows=max_cross, _depth=_depth + 1)
    cols = list(df.columns) + [out_col]
    return settled.select(*cols).unionByName(inner.select(*cols))
