"""Profiling aggregates: null audit, class shares, value counts, column profile.

All are single-pass aggregates with map-side partial aggregation; results
are bounded by the number of columns or distinct values, never by rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_half_up


def null_counts_long(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, from one scan."""
    wide = df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_count")


def audit_nulls(df: DataFrame) -> DataFrame:
    """Columns with at least one null, most nulls first."""
    return (null_counts_long(df)
            .filter(F.col("null_count") > 0)
            .orderBy(F.desc("null_count"), F.asc("column_name")))


def value_counts(df: DataFrame, column: str, count_col: str = "n") -> DataFrame:
    """Counts per non-null value, most frequent first (missing values left out)."""
    return (df.filter(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.desc(count_col), F.asc(column)))


def class_share(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """Normalised value counts: share of each non-null value.

    The total comes from a one-row aggregate of the (small) grouped result,
    attached with a broadcast cross join instead of a global window.
    """
    counts = (df.filter(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select(column, "n",
                    round_half_up(F.col("n") / F.col("_total"), digits).alias("share"))
            .orderBy(F.desc("n"), F.asc(column)))


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, null count, approximate distinct count, the table's
    shape (rows, columns) and how many columns share its type (the
    reference's dtype histogram), all from one scan."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in df.columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n__{c}"))
        aggs.append(F.approx_count_distinct(c).alias(f"d__{c}"))
    wide = df.agg(*aggs)
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                 F.col(f"n__{c}").alias("null_count"),
                 F.col(f"d__{c}").alias("approx_distinct"),
                 F.col("__rows").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))
        for i, c in enumerate(df.columns)])).alias("p")).select("p.*")
    type_counts = {}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        type_counts[t] = type_counts.get(t, 0) + 1
    type_map = F.create_map(*[x for t, n in type_counts.items() for x in (F.lit(t), F.lit(n))])
    return stacked.withColumn("columns_of_type", type_map[F.col("data_type")])


def column_redundancy(df: DataFrame, a: str, b: str, digits: int = 6) -> DataFrame:
    """How close ``a`` → ``b`` is to a function: per value of ``a`` the number
    of distinct ``b`` values and the share of its most frequent ``b``."""
    pairs = (df.filter(F.col(a).isNotNull())
             .groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))
    return (pairs.groupBy(a)
            .agg(F.count(F.lit(1)).alias("n_values"),
                 F.sum("n").alias("n_rows"),
                 F.max("n").alias("top_n"))
            .select(a, "n_values", "n_rows",
                    round_half_up(F.col("top_n") / F.col("n_rows"), digits).alias("top_share"))
            .orderBy(a))
