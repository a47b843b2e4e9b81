"""Categories as means of the answer, learned so that no training row sees its own answer.

A category of many values needs no slot and no tree bin per value: it becomes one number per output, the mean of the
answer among its rows, drawn towards the mean of all rows by ``smoothing`` rows' worth. A training row gets the mean
over the other folds, any other row the mean over all training rows. The table has one row per value and is joined,
so the number of values is bounded by no task's and no driver's memory.

Defined cases: a missing value is a value of its own; a value not seen in the other folds (training) or at all
(prediction) has the mean of all rows there; one fold only is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup
from ..session import broadcast_if_small

# Fixed value: what stands for a missing category, here and in the model's other encodings.
MISSING = "__null__"
FOLDS = 5
SMOOTHING = 10.0


def _value(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(MISSING))


def target_means(df: DataFrame, column: str, targets: Sequence[Column], fold: Column, folds: int = FOLDS, smoothing: float = SMOOTHING) -> DataFrame:
    """Per value of the column: ``rows``, ``means`` (one per target, over all rows) and ``by_fold`` (the same without each fold).

    ``fold`` is a whole number from 0 to ``folds`` - 1. Sums are made before the shuffle, so a value with a third of
    all rows is a few numbers per task.
    """
    if folds < 2 or smoothing <= 0:
        raise ValueError("means without the own fold need two folds or more, and a smoothing above 0")
    several = range(len(targets))
    tall = df.select(_value(column).alias("value"), fold.cast("int").alias("f"), *[t.cast("double").alias(f"t{j}") for j, t in enumerate(targets)])
    per = tall.groupBy("value", "f").agg(F.count("*").alias("n"), *[F.sum(f"t{j}").alias(f"s{j}") for j in several])
    whole = {r["f"]: r for r in per.groupBy("f").agg(F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in several]).collect()}  # a row per fold

    def prior(j: int, without: int | None = None) -> float | None:
        kept = [r for f, r in whole.items() if f != without]
        n = sum(r["n"] for r in kept)
        return sum(r[f"s{j}"] for r in kept) / n if n else None

    def of(name: str, f: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("f") == f, F.col(name))), F.lit(0)).alias(f"{name}_{f}")

    wide = per.groupBy("value").agg(
        F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in several], *[of(c, f) for c in ("n", *[f"s{j}" for j in several]) for f in range(folds)]
    )

    def mean(total: Column, n: Column, towards: float | None) -> Column:
        return (total + smoothing * F.lit(towards).cast("double")) / (n + smoothing)

    over_all = F.array(*[mean(F.col(f"s{j}"), F.col("n"), prior(j)) for j in several])
    others = [F.array(*[mean(F.col(f"s{j}") - F.col(f"s{j}_{f}"), F.col("n") - F.col(f"n_{f}"), prior(j, f)) for j in several]) for f in range(folds)]
    return wide.select("value", F.col("n").alias("rows"), over_all.alias("means"), F.array(*others).alias("by_fold"))


def encoded(df: DataFrame, column: str, table: DataFrame, unseen: Sequence[float], fold: Column | None = None) -> DataFrame:
    """The rows with ``_t_<column>``, a vector of means: without the row's ``fold`` if one is given.

    A small table is broadcast; a larger one meets the rows by shuffle, where common values still go by broadcast.
    """
    key, out = f"_v_{column}", f"_t_{column}"
    picked = table.select(F.col("value").alias(key), F.col("means" if fold is None else "by_fold").alias(out))
    rows = df.withColumn(key, _value(column))
    small = broadcast_if_small(picked, 100_000)
    if small is not picked or df.isStreaming:
        beside = rows.join(small, key, "left")
    else:
        beside = lookup(rows, key, picked, "left")
    means = F.col(f"`{out}`") if fold is None else F.get(F.col(f"`{out}`"), fold.cast("int"))
    known = F.coalesce(means, F.array(*[F.lit(float(v)) for v in unseen]))
    return beside.withColumn(out, array_to_vector(known)).drop(key)
