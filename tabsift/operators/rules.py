"""Cut, repair, derive: cleaning rules whose cost is counted, not guessed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import share
from ..session import one_row
from . import quantiles


@dataclass(frozen=True)
class Rule:
    """A named condition that a valid row satisfies (NULL counts as failing)."""

    name: str
    keep: Column

    @property
    def fails(self) -> Column:
        return ~F.coalesce(self.keep, F.lit(False))


def between(column: str, low, high) -> Rule:
    """Both ends included."""
    return Rule(f"{column}_between", F.col(column).between(low, high))


def present(column: str) -> Rule:
    return Rule(f"{column}_present", F.col(column).isNotNull())


def _all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that satisfy every rule; plain conditions still reach the scan."""
    return df.where(reduce(lambda a, b: a & b, [r.keep for r in rules]))


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """What every rule costs: rows it fails, rows only it fails, rows kept by all.

    Gross cuts overlap, so they do not add up to the rows that leave.
    """
    aggs = [F.count("*").alias("_rows"), F.count_if(_all_of([~r.fails for r in rules])).alias("_kept")]
    for i, r in enumerate(rules):
        others = [~o.fails for o in rules if o is not r]
        aggs += [F.count_if(r.fails).alias(f"_g{i}"), F.count_if(r.fails & _all_of(others)).alias(f"_o{i}")]
    items = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.col(f"_g{i}").alias("cut"),
            F.col(f"_o{i}").alias("cut_alone"),
            F.col("_rows").alias("rows"),
            F.col("_kept").alias("kept"),
            share(F.col(f"_g{i}"), F.col("_rows"), 3).alias("cut_pct"),
        )
        for i, r in enumerate(rules)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def with_failures(df: DataFrame, rules: Sequence[Rule], column: str = "failed_rules") -> DataFrame:
    """Every row with the names of the rules it fails (empty for a good row)."""
    return df.withColumn(column, F.array_compact(F.array(*[F.when(r.fails, F.lit(r.name)) for r in rules])))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their reasons: nothing is dropped silently."""
    marked = with_failures(df, rules)
    good = marked.where(F.size("failed_rules") == 0).drop("failed_rules")
    return good, marked.where(F.size("failed_rules") > 0)


def drop_columns(df: DataFrame, reasons: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """The table without the named columns, and what was left out and why."""
    unknown = [c for c in reasons if c not in df.columns]
    if unknown:
        raise ValueError(f"not in the table: {unknown}")
    report = df.sparkSession.createDataFrame(list(reasons.items()), "column string, reason string")
    return df.drop(*reasons), report


def swap_repair(df: DataFrame, a: str, b: str, inverted: Column) -> DataFrame:
    """Exchange two columns where ``inverted`` betrays that they were swapped."""
    fixed = {a: F.when(inverted, F.col(b)).otherwise(F.col(a)), b: F.when(inverted, F.col(a)).otherwise(F.col(b))}
    return df.select(*[fixed[c].alias(c) if c in fixed else F.col(c) for c in df.columns])


def cut_above_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """Rows at or below the column's own p-quantile instead of a chosen constant."""
    limit = one_row(quantiles.exact(df, column, {"q": p}))["q"]
    return df.where(F.col(column) <= limit)


def confirm(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """One row that compares a column before and after cleaning.

    ``is_empty`` is the alarm for a filter that silently removed everything.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        median = one_row(quantiles.exact(df, column, {"m": 0.5}))["m"]
        return df.agg(
            F.count("*").alias(f"rows_{tag}"),
            F.round(F.avg(column), 2).alias(f"mean_{tag}"),
            F.round(F.stddev_samp(column), 2).alias(f"stddev_{tag}"),
        ).withColumn(f"median_{tag}", F.round(median, 2))

    first = one_row(side(before, "before"))
    out = side(after, "after")
    for c in ("rows_before", "mean_before", "stddev_before", "median_before"):
        out = out.withColumn(c, first[c])
    return out.withColumn("is_empty", F.col("rows_after") == 0).withColumn(
        "pct_kept", share(F.col("rows_after"), F.col("rows_before"), 3)
    )
