"""Join diagnostics: why did this join duplicate my rows?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fanout(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows in and out of an inner join, worst multiplicity and orphan keys.

    Both sides are reduced to counts per key before they meet, so the join's
    size is that of the keys and its output is never produced.
    """
    a = left.groupBy(F.col(left_key).alias("k")).agg(F.count("*").alias("nl"))
    b = right.groupBy(F.col(right_key).alias("k")).agg(F.count("*").alias("nr"))
    both = a.where("k is not null").join(b.where("k is not null"), "k", "full_outer")
    return both.agg(
        F.sum("nl").alias("rows_left"),
        F.sum("nr").alias("rows_right"),
        F.sum(F.col("nl") * F.col("nr")).alias("rows_joined"),
        F.max(F.when(F.col("nl").isNotNull(), F.col("nr"))).alias("max_right_per_key"),
        F.max(F.when(F.col("nr").isNotNull(), F.col("nl"))).alias("max_left_per_key"),
        F.count_if(F.col("nr").isNull()).alias("left_keys_without_right"),
        F.count_if(F.col("nl").isNull()).alias("right_keys_without_left"),
    )


def matched(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows that have a partner (each once, however many partners)."""
    keys = right.select(F.col(right_key).alias(left_key))
    return left.join(keys, left_key, "left_semi")


def unmatched(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows without a partner."""
    keys = right.select(F.col(right_key).alias(left_key))
    return left.join(keys, left_key, "left_anti")


def lookup(rows: DataFrame, column: str, table: DataFrame, how: str = "inner", shares: int = 1_000) -> DataFrame:
    """Rows beside their row of ``table``, which holds one row per value of ``column``; rows without a value are left out.

    Values that hold over 1/``shares`` of the rows, which are fewer than ``shares`` whatever the size, meet their rows
    by broadcast. No other value can fill a task of the shuffle that joins the rest.
    """
    known = rows.where(F.col(column).isNotNull())
    total = known.agg(F.count("*")).scalar()
    sizes = known.groupBy(column).agg(F.count("*").alias("_n"))
    hot = F.broadcast(sizes.where(F.col("_n") * shares > total).select(column))
    warm = known.join(hot, column, "left_semi").join(F.broadcast(table.join(hot, column, "left_semi")), column, how)
    return warm.unionByName(known.join(hot, column, "left_anti").join(table, column, how))
