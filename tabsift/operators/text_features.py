"""Features mined from free text: test the hypothesis, build the flag, count its cover."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.scalars import contains, share
from ..session import one_row
from . import quantiles
from .aggregates import _long

TOKEN_BREAK = "[^a-z0-9à-öø-ÿ]+"


def add_flags(df: DataFrame, text: str, patterns: Mapping[str, str]) -> DataFrame:
    """One boolean column per pattern, all in a single projection."""
    return df.withColumns({name: contains(text, p) for name, p in patterns.items()})


def coverage(df: DataFrame, flags: Sequence[str], rare_pct: float = 5.0) -> DataFrame:
    """How many rows each flag marks, and whether it is too rare to move a metric."""
    wide = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    pct = lambda f: F.try_divide(F.lit(100.0) * F.col(f), F.col("_n"))
    return _long(
        wide,
        flags,
        lambda f: [F.col(f).alias("rows"), F.round(pct(f), 2).alias("pct"), (pct(f) < rare_pct).alias("too_rare")],
    )


def overlap(df: DataFrame, flags: Sequence[str], medians: Mapping[str, Column | str]) -> DataFrame:
    """Rows and medians for every combination of flags that occurs."""
    out = df.groupBy(*flags).agg(F.count("*").alias("rows"))
    if not medians:
        return out
    found = quantiles.exact_columns(df, dict(medians), 0.5, by=flags)
    same = [out[f].eqNullSafe(found[f]) for f in flags]
    return out.join(found, same, "left").select(*[out[c] for c in out.columns], *[found[m] for m in medians])


def category(text: str, rules: Mapping[str, str], otherwise: str = "outro") -> Column:
    """One category per row: the first pattern that matches, in the given order."""
    out = None
    for name, p in rules.items():
        out = F.when(contains(text, p), name) if out is None else out.when(contains(text, p), name)
    return out.otherwise(otherwise)


def tokens(text: str) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != ""))


def uncovered_tokens(df: DataFrame, text: str, covered: Column) -> DataFrame:
    """Words of rows no rule covers, against how often covered rows use them.

    One scan counts, per word, the rows on both sides; words are counted where
    they are read, so a frequent word crosses the network once per task.
    """
    rows = df.select(F.coalesce(covered, F.lit(False)).alias("_c"), tokens(text).alias("_t"))
    sides = one_row(rows.agg(F.count_if(~F.col("_c")).alias("u"), F.count_if("_c").alias("c")))
    counts = (
        rows.select("_c", F.explode("_t").alias("token"))
        .groupBy("token")
        .agg(F.count_if(~F.col("_c")).alias("uncovered_rows"), F.count_if("_c").alias("covered_rows"))
        .where("uncovered_rows > 0")
    )
    here = F.col("uncovered_rows") / sides["u"]
    there = F.try_divide(F.col("covered_rows").cast("double"), sides["c"])
    return counts.withColumn("lift", F.round(F.try_divide(here, there), 4))


def amount_match(df: DataFrame, text: str, truth: str, tolerance: float = 0.02) -> DataFrame:
    """Amounts named in the text: how many, how many parse, how many tell the truth."""
    found = F.col("_amount")
    return df.withColumn("_amount", scalars.amount_in_text(text)).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(text).contains("R$")).alias("with_sign"),
        F.count(found).alias("parsed"),
        F.count_if(F.abs(found - F.col(truth)) < F.lit(tolerance) * F.col(truth)).alias("matching"),
    )


def gap(card: DataFrame) -> DataFrame:
    """Relative gap of a with/without card, in percent."""
    return card.withColumn("gap_pct", share(F.col("mean_with") - F.col("mean_without"), F.col("mean_without"), 2))
