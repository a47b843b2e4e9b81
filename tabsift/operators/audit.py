"""Audit of a typed-but-dirty table: typed is not the same as valid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import share
from ..session import broadcast_if_small, one_row
from . import quantiles
from .aggregates import _long

# Fixed value: a column whose commonest value fills this share teaches nothing.
DEAD_SHARE = 0.999


def tail_alarm(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean against median and deviation against mean, one row per column."""
    wide = df.agg(
        *[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("sd", F.stddev_samp), ("n", F.count))]
    )
    medians = one_row(quantiles.exact_columns(df, {c: c for c in columns}, 0.5))
    wide = wide.withColumns({f"{c}_med": medians[c].cast("double") for c in columns})
    mean, sd, med = (lambda c: F.col(f"{c}_mean")), (lambda c: F.col(f"{c}_sd")), (lambda c: F.col(f"{c}_med"))
    return _long(
        wide,
        columns,
        lambda c: [
            F.col(f"{c}_n").alias("n"),
            F.round(mean(c), 2).alias("mean"),
            F.round(med(c), 2).alias("median"),
            F.round(sd(c), 2).alias("stddev"),
            F.round(F.try_divide(mean(c), med(c)), 4).alias("mean_to_median"),
            (sd(c) > F.abs(mean(c))).alias("spread_exceeds_mean"),
        ],
    )


def outlier_leverage(df: DataFrame, column: str, limit: float) -> DataFrame:
    """How much of the spread hangs on the rows above ``limit``; one pass, no rows removed."""
    x = F.col(column)
    wide = df.agg(
        F.count_if(x > limit).alias("suspects"),
        F.count(x).alias("n"),
        F.stddev_samp(x).alias("_with"),
        F.stddev_samp(F.when(x <= limit, x)).alias("_without"),
    )
    return wide.select(
        "suspects",
        "n",
        share(F.col("suspects"), F.col("n")).alias("pct"),
        F.round("_with", 2).alias("stddev_with"),
        F.round("_without", 2).alias("stddev_without"),
        F.round(100 * (1 - F.try_divide(F.col("_without"), F.col("_with"))), 2).alias("spread_removed_pct"),
    )


def impossible_values(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values at or below the floor and above the ceiling, for every column at once."""
    aggs = [F.count("*").alias("_n")]
    for c, (low, high) in bounds.items():
        aggs += [F.count_if(F.col(c) <= low).alias(f"{c}_low"), F.count_if(F.col(c) > high).alias(f"{c}_high")]
    return _long(
        df.agg(*aggs),
        list(bounds),
        lambda c: [F.col(f"{c}_low").alias("too_low"), F.col(f"{c}_high").alias("too_high"), F.col("_n").alias("rows")],
    )


def cross_column(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows that break each named between-column constraint, in one pass."""
    aggs = [F.count("*").alias("_n")] + [F.count_if(c).alias(f"_c{i}") for i, c in enumerate(checks.values())]
    items = [
        F.struct(F.lit(name).alias("check"), F.col(f"_c{i}").alias("broken"), share(F.col(f"_c{i}"), F.col("_n"), 3).alias("pct"))
        for i, name in enumerate(checks)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def dead_columns(df: DataFrame, columns: Sequence[str] | None = None, dead_share: float = DEAD_SHARE) -> DataFrame:
    """Columns with one value, or with one value on nearly every row.

    A constant column has equal minimum and maximum. A near-constant one has a
    heavy hitter, which the top-k sketch names and a second pass counts exactly.
    No value is shuffled, whatever the column's cardinality.
    """
    columns = list(columns or df.columns)
    first = df.agg(
        *[F.expr(f"approx_top_k(`{c}`, 1)").alias(f"{c}_top") for c in columns],
        *[F.min(c).alias(f"{c}_min") for c in columns],
        *[F.max(c).alias(f"{c}_max") for c in columns],
    )
    top = one_row(first)
    wide = df.agg(
        F.count("*").alias("_n"),
        *[F.count(c).alias(f"{c}_n") for c in columns],
        *[F.count_if(F.col(c) == top[f"{c}_top"][0]["item"]).alias(f"{c}_k") for c in columns],
        *[F.first(top[f"{c}_top"][0]["item"].cast("string")).alias(f"{c}_v") for c in columns],
        *[F.first(top[f"{c}_min"].eqNullSafe(top[f"{c}_max"])).alias(f"{c}_one") for c in columns],
    )
    heavy = lambda c: F.try_divide(F.col(f"{c}_k"), F.col(f"{c}_n")) >= dead_share
    return _long(
        wide,
        columns,
        lambda c: [
            F.col(f"{c}_one").alias("is_constant"),
            F.when(heavy(c), F.col(f"{c}_v")).alias("dominant_value"),
            F.when(heavy(c), F.col(f"{c}_k")).alias("dominant_rows"),
            (F.col(f"{c}_one") | F.coalesce(heavy(c), F.lit(True))).alias("is_dead"),
        ],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("times")).where("times > 1")


def duplicate_texts(df: DataFrame, text: str, ident: str) -> DataFrame:
    """Exact copies of a long text: only a 256-bit digest is shuffled, not the text. Missing texts are no copies."""
    return (
        df.where(F.col(text).isNotNull())
        .select(F.sha2(text, 256).alias("digest"), ident)
        .groupBy("digest")
        .agg(F.count("*").alias("copies"), F.min(ident).alias("first_id"))
        .where("copies > 1")
    )


def dedup_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key.

    Filtering the row number lets Spark keep one row per key and input partition
    before the shuffle, so a key with a third of all rows costs one task nothing.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group; groups are cut to ``n`` before the shuffle too."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def split_leak(df: DataFrame, keys: Sequence[str], in_test: Column) -> DataFrame:
    """Duplicate keys with copies on both sides of a train/test split."""
    sides = df.groupBy(*keys).agg(F.count("*").alias("times"), F.count_if(in_test).alias("in_test"))
    return sides.agg(
        F.count_if(F.col("times") > 1).alias("duplicate_keys"),
        F.count_if((F.col("in_test") > 0) & (F.col("in_test") < F.col("times"))).alias("leaking_keys"),
        F.coalesce(F.sum(F.when((F.col("in_test") > 0) & (F.col("in_test") < F.col("times")), F.col("times"))), F.lit(0)).alias(
            "leaking_rows"
        ),
    )


def swapped_columns(df: DataFrame, a: str, a_range: tuple, b: str, b_range: tuple) -> DataFrame:
    """Rows whose two values fit their ranges only after an exchange."""
    as_is = F.col(a).between(*a_range) & F.col(b).between(*b_range)
    exchanged = F.col(b).between(*a_range) & F.col(a).between(*b_range)
    return df.where(exchanged & ~as_is)


def scale_suspects(df: DataFrame, column: str, segment: str, powers: Sequence[int] = (-3, -2, 2, 3)) -> DataFrame:
    """Values outside their segment's p1–p99 that land inside after a power of ten.

    They are reported, not repaired: the right power cannot be known.
    """
    edges = quantiles.exact(df, column, {"p01": 0.01, "p99": 0.99}, by=[segment]).withColumnRenamed(segment, "_segment")
    edges = broadcast_if_small(edges)
    x, low, high = F.col(column), F.col("p01"), F.col("p99")
    moved = F.coalesce(
        *[F.when((x / F.lit(float(10**k) if k > 0 else 1.0 / 10 ** -k)).between(low, high), F.lit(k)) for k in powers]
    )
    # Rows without a segment are a segment of their own.
    held = df.join(edges, df[segment].eqNullSafe(edges["_segment"])).drop("_segment")
    return held.where(~x.between(low, high)).withColumn("power", moved).where(F.col("power").isNotNull())
