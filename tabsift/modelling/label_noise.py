"""Rows whose rule-made label is doubted by a model that never saw them.

Only labels with declared sources are looked at: a label that a rule derived can be wrong where an observed one is a
fact. Every row is scored by a model trained on the other folds, without the label's sources. A class counts as likely
for a row if its probability reaches the mean that the class has among rows given it; the joint count of given and
likely classes shows where labels leak into one another, and the rows off its diagonal are the suspects.

Defined cases: rows without a label are left out; a row for which no class is likely is no suspect and has a null
likely class; a class that only one fold holds is never likely there; an empty table cannot be trained on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.leakage import Feature, ancestors, refuse_leaks
from ..session import staged
from .models import predict, train

FOLDS = 3


class LabelSourceError(ValueError):
    """The label is not declared as derived from other columns, so its noise cannot be told from hard rows."""


def out_of_fold(
    df: DataFrame, label: str, features: Sequence[str], catalog: Mapping[str, Feature], kind: str = "LOGISTIC_REG",
    folds: int = FOLDS, fold: Column | None = None, **options,
) -> DataFrame:
    """All columns and ``probs``, an array of (label, prob) from a model trained on the other folds.

    A row's fold is a hash of its features and label, so equal rows are scored by the same model; ``fold`` gives
    another rule, a whole number. Training is once per fold; scoring is map-only.
    """
    if not ancestors(label, catalog):
        raise LabelSourceError(f"{label} has no declared sources: state what it is derived from")
    refuse_leaks(features, label, catalog)
    number = F.xxhash64(*[F.col(f"`{c}`") for c in (*features, label)]) if fold is None else fold
    rows = staged(df.where(F.col(f"`{label}`").isNotNull()).withColumn("_fold", F.pmod(number, F.lit(folds)).cast("int")), "folds")
    parts = []
    for i in range(folds):
        fit = rows.where(F.col("_fold") != i).select(*[F.col(f"`{c}`") for c in features], F.col(f"`{label}`"))
        model = train(fit, kind, label, split_method="NONE", stage=False, **options)
        scored = predict(model, rows.where(F.col("_fold") == i))
        parts.append(scored.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`predicted_{label}_probs`").alias("probs")))
    return reduce(DataFrame.unionByName, parts)


def _own(label: str) -> Column:
    return F.get(F.filter("probs", lambda p: p["label"] == F.col(f"`{label}`")), F.lit(0))["prob"]


def likely(scored: DataFrame, label: str) -> DataFrame:
    """The scored rows, read once more, with ``likely``, ``given_prob`` and ``likely_prob``."""
    means = scored.select(F.col(f"`{label}`").alias("c"), _own(label).alias("p")).groupBy("c").agg(F.avg("p").alias("t")).collect()  # a row per class
    reached = F.lit(None).cast("double")
    limit = {r.c: float(r.t) for r in means if r.t is not None}

    def of_class(p: Column) -> Column:
        out = reached
        for c, t in limit.items():
            out = F.when(p["label"] == F.lit(c), F.lit(t)).otherwise(out)
        return out

    candidates = F.filter("probs", lambda p: p["prob"] >= of_class(p))
    best = F.array_max(F.transform(candidates, lambda p: F.struct(p["prob"].alias("prob"), p["label"].alias("label"))))
    return scored.withColumn("_best", best).select(
        *[F.col(f"`{c}`") for c in scored.columns], F.col("_best.label").alias("likely"), _own(label).alias("given_prob"), F.col("_best.prob").alias("likely_prob")
    )


def joint_counts(marked: DataFrame, label: str) -> DataFrame:
    """Rows per given and likely class."""
    return marked.groupBy(F.col(f"`{label}`").alias("given"), "likely").agg(F.count("*").alias("rows"))


def suspects(marked: DataFrame, label: str) -> DataFrame:
    """Rows whose likely class is another than the given one, with ``doubt``, by how much it is the more probable."""
    wrong = marked.where(F.col("likely").isNotNull() & (F.col("likely") != F.col(f"`{label}`")))
    return wrong.withColumn("doubt", F.col("likely_prob") - F.coalesce("given_prob", F.lit(0.0)))


def find(df: DataFrame, label: str, features: Sequence[str], catalog: Mapping[str, Feature], kind: str = "LOGISTIC_REG", **options) -> DataFrame:
    """The suspects of a table in one call."""
    scored = staged(out_of_fold(df, label, features, catalog, kind, **options), "out-of-fold")
    return suspects(likely(scored, label), label)
