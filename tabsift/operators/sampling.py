"""Seeded samples, and how wrong a slice of the head would be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import union_all


def draw(ident: str, seed: int) -> Column:
    """A pseudo-random but reproducible key of a row, the same in any layout."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(ident).cast("string")), 256)


def hash_sample(df: DataFrame, ident: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in seeded order; a top-n per task, never a global sort."""
    return df.orderBy(draw(ident, seed), F.col(ident)).limit(n)


def head_slice(df: DataFrame, ident: str, n: int) -> DataFrame:
    return df.orderBy(ident).limit(n)


def sample_bias(df: DataFrame, ident: str, flag: Column, n: int, seed: int = 42) -> DataFrame:
    """Rate of ``flag`` in the seeded sample, in the head and in the whole, with z-scores."""
    marked = df.select(ident, flag.alias("_f"))

    def rate(name: str, part: DataFrame) -> DataFrame:
        return part.agg(F.count("*").alias("rows"), F.count_if("_f").alias("hits")).select(F.lit(name).alias("part"), "rows", "hits")

    parts = union_all(
        [rate("whole", marked), rate("sample", hash_sample(marked, ident, n, seed)), rate("head", head_slice(marked, ident, n))]
    )
    whole = parts.where("part = 'whole'").select(F.struct("rows", "hits")).scalar()
    p = F.try_divide(whole["hits"].cast("double"), whole["rows"])
    seen = F.try_divide(F.col("hits").cast("double"), F.col("rows"))
    error = F.sqrt(p * (1 - p) / F.col("rows"))
    return parts.select("part", "rows", "hits", F.round(100 * seen, 3).alias("pct"), F.round(F.try_divide(seen - p, error), 4).alias("z"))


def bucket(ident: str, seed: int = 42, buckets: int = 100) -> Column:
    """A bucket number 0..buckets-1 from the first 32 bits of the row's draw."""
    word = F.conv(F.substring(draw(ident, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(word, F.lit(buckets))
