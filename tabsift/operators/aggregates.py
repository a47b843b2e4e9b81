"""Whole-table and grouped aggregates, each in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col, share
from ..session import one_row
from . import quantiles


def describe(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Count, min, median, mean, max and sample deviation of one column."""
    stats = df.agg(
        F.count(column).alias("n"),
        F.round(F.min(column), digits).alias("min"),
        F.round(F.avg(column), digits).alias("mean"),
        F.round(F.max(column), digits).alias("max"),
        F.round(F.stddev_samp(column), digits).alias("stddev"),
    )
    median = one_row(quantiles.exact(df, column, {"median": 0.5}))
    return stats.withColumn("median", F.round(median["median"], digits))


def null_census(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: missing rows and their share; a single scan."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long(wide, columns, lambda c: [F.col(c).alias("nulls"), F.col("_n").alias("rows"), share(F.col(c), F.col("_n")).alias("pct")])


def _long(wide: DataFrame, columns: Sequence[str], make) -> DataFrame:
    """Turn a one-row wide aggregate into one row per column, without a second scan."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), *make(c)) for c in columns])
    return wide.select(F.inline(items))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values per column.

    Each row becomes one (column, value) per column and is de-duplicated before
    the shuffle, so nothing is repeated per distinct aggregate.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(columns)])
    seen = df.select(F.explode(pairs).alias("p")).select("p.*").where("v is not null").distinct()
    return seen.agg(*[F.count_if(F.col("i") == i).alias(c) for i, c in enumerate(columns)])


def correlation(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int = 6) -> DataFrame:
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    items = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"`{a}|{b}`"), digits).alias("corr")) for a, b in pairs]
    )
    return wide.select(F.inline(items))


def joined_correlation(
    facts: DataFrame, x: str, key: str, dims: DataFrame, y: str, dim_key: str, digits: int = 6
) -> DataFrame:
    """Correlation of a fact column with a column of its dimension row.

    Facts are reduced to per-key moments before the join, so a key that holds a
    third of all rows ships as one row.
    """
    moments = (
        facts.where(F.col(x).isNotNull())
        .groupBy(F.col(key).alias("_k"))
        .agg(F.count("*").cast("double").alias("n"), F.avg(x).alias("mx"), F.var_pop(x).alias("vx"))
    )
    side = dims.select(F.col(dim_key).alias("_k"), F.col(y).alias("y")).where(F.col("y").isNotNull())
    both = moments.join(side, "_k")
    # Moments are taken about the means, so large values do not cancel.
    total = F.sum("n")
    mean = one_row(both.agg((F.sum(F.col("n") * F.col("mx")) / total).alias("x"), (F.sum(F.col("n") * F.col("y")) / total).alias("y")))
    dx, dy = F.col("mx") - mean["x"], F.col("y") - mean["y"]
    s = both.agg(
        F.sum(F.col("n") * dx * dy).alias("xy"),
        F.sum(F.col("n") * (F.col("vx") + dx * dx)).alias("xx"),
        F.sum(F.col("n") * dy * dy).alias("yy"),
    )
    corr = F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy")))
    return s.select(F.lit(x).alias("a"), F.lit(y).alias("b"), F.round(corr, digits).alias("corr"))


def class_share(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their share of all rows.

    The grand total is the sum over the grouped rows, read back as a scalar, so
    no window gathers the classes in one task.
    """
    counts = df.groupBy(F.col(label)).agg(F.count("*").alias("n"))
    total = one_row(counts.agg(F.sum("n").alias("total")))["total"]
    return counts.withColumn("pct", share(F.col("n"), total))


def mean_with_without(df: DataFrame, flag: Column, x: Column | str, by: Sequence[Column | str] = ()) -> DataFrame:
    """Rows with the flag and the mean of ``x`` with and without it, in one pass.

    Rows whose flag is NULL (no text to search) belong to neither side and are
    counted apart.
    """
    x = col(x)
    return df.groupBy(*by).agg(
        F.count_if(flag).alias("n_with"),
        F.count_if(~flag).alias("n_without"),
        F.count_if(flag.isNull()).alias("n_unknown"),
        F.round(F.avg(F.when(flag, x)), 2).alias("mean_with"),
        F.round(F.avg(F.when(~flag, x)), 2).alias("mean_without"),
    )


def median_check(df: DataFrame, column: str) -> DataFrame:
    """Rows at or below and at or above the median: each must be at least half."""
    median = one_row(quantiles.exact(df, column, {"m": 0.5}))["m"]
    return df.agg(
        F.count(column).alias("n"),
        F.count_if(F.col(column) <= median).alias("at_or_below"),
        F.count_if(F.col(column) >= median).alias("at_or_above"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def variation(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean, population deviation and their ratio per column."""
    wide = df.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    return _long(
        wide,
        columns,
        lambda c: [
            F.round(F.col(f"{c}_m"), 2).alias("mean"),
            F.round(F.col(f"{c}_s"), 2).alias("stddev_pop"),
            F.round(F.try_divide(F.col(f"{c}_s"), F.col(f"{c}_m")), digits).alias("cv"),
        ],
    )


def profile_groups(df: DataFrame, by: str, medians: dict[str, str], means: dict[str, str], rates: dict[str, str]) -> DataFrame:
    """Card per group: rows, medians, means and percentages of boolean columns.

    ``{"price_median": "price"}`` names the output; groups must be few enough to
    describe one by one (segments, clusters).
    """
    card = df.groupBy(by).agg(
        F.count("*").alias("rows"),
        *[F.round(F.avg(c), 4).alias(out) for out, c in means.items()],
        *[F.round(100 * F.avg(F.col(c).cast("int")), 4).alias(out) for out, c in rates.items()],
    )
    if not medians:
        return card
    found = quantiles.exact_columns(df, medians, 0.5, by=[by]).withColumnRenamed(by, "_by")
    return card.join(found, card[by].eqNullSafe(found["_by"]), "left").drop("_by")
