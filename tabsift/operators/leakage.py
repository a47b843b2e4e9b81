"""Leakage guards: metrics that improve for the wrong reason."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import share
from .aggregates import _long


class LeakageError(ValueError):
    """A feature set that would teach the model its own answer."""


@dataclass(frozen=True)
class Feature:
    """A declared column: what it was computed from and when it is known."""

    name: str
    derived_from: tuple[str, ...] = ()
    available_at: str = "before"  # "before" or "after" the event to predict


def ancestors(name: str, catalog: Mapping[str, Feature]) -> set[str]:
    """Every column a column was computed from, directly or not."""
    seen: set[str] = set()
    open_ = list(catalog[name].derived_from) if name in catalog else []
    while open_:
        c = open_.pop()
        if c not in seen:
            seen.add(c)
            open_ += catalog[c].derived_from if c in catalog else ()
    return seen


def lineage_verdicts(features: Iterable[str], label: str, catalog: Mapping[str, Feature]) -> list[tuple[str, str]]:
    """``(feature, reason)`` for each feature that touches the label or its sources."""
    sources = ancestors(label, catalog)
    out = []
    for f in features:
        up = ancestors(f, catalog)
        if f == label:
            out.append((f, "is the label"))
        elif f in sources:
            out.append((f, "the label was derived from it"))
        elif label in up:
            out.append((f, "derived from the label"))
        elif up & sources:
            out.append((f, "shares the label's source " + ", ".join(sorted(up & sources))))
        elif f in catalog and catalog[f].available_at != "before":
            out.append((f, "known only after the event"))
    return out


def refuse_leaks(features: Iterable[str], label: str, catalog: Mapping[str, Feature]) -> None:
    bad = lineage_verdicts(features, label, catalog)
    if bad:
        raise LeakageError("; ".join(f"{f}: {why}" for f, why in bad))


def late_features(df: DataFrame, stamps: Mapping[str, tuple[str | Column, str | Column]]) -> DataFrame:
    """Rows whose feature was filled after the event it should predict."""
    aggs = [F.count("*").alias("_n")]
    for name, (filled, event) in stamps.items():
        f, e = (F.col(c) if isinstance(c, str) else c for c in (filled, event))
        aggs.append(F.count_if(f > e).alias(name))
    return _long(
        df.agg(*aggs),
        list(stamps),
        lambda c: [F.col(c).alias("late_rows"), F.col("_n").alias("rows"), share(F.col(c), F.col("_n"), 2).alias("pct")],
    )


def label_copies(df: DataFrame, label: str, features: Sequence[str], tolerance: float = 0.02, alarm: float = 0.5) -> DataFrame:
    """Share of non-null values of each feature that equal the label within tolerance.

    A rare copied column hides in every aggregate metric; it does not hide here.
    """
    y = F.col(label)
    aggs = []
    for f in features:
        near = F.abs(F.col(f) - y) < F.lit(tolerance) * F.abs(y)
        aggs += [F.count(f).alias(f"{f}_n"), F.count_if(near).alias(f"{f}_k")]
    rate = lambda f: F.try_divide(F.col(f"{f}_k").cast("double"), F.col(f"{f}_n"))
    return _long(
        df.agg(*aggs),
        features,
        lambda f: [
            F.col(f"{f}_n").alias("filled"),
            F.col(f"{f}_k").alias("equal_to_label"),
            F.round(rate(f), 4).alias("rate"),
            F.coalesce(rate(f) >= alarm, F.lit(False)).alias("is_copy"),
        ],
    )


def error_by_group(df: DataFrame, truth: str, predicted: str, group: Column | str, name: str = "group") -> DataFrame:
    """Rows and mean absolute error per subgroup."""
    g = F.col(group) if isinstance(group, str) else group
    return df.groupBy(g.alias(name)).agg(
        F.count("*").alias("rows"), F.round(F.avg(F.abs(F.col(predicted) - F.col(truth))), 4).alias("mae")
    )


def subgroup_gaps(df: DataFrame, truth: str, predicted: str, features: Sequence[str], alarm: float = 0.25) -> DataFrame:
    """Error where each feature is filled against error where it is not, in one pass.

    A much smaller error on the filled side says the model reads its answer there.
    """
    e = F.abs(F.col(predicted) - F.col(truth))
    aggs = []
    for f in features:
        has = F.col(f).isNotNull()
        aggs += [
            F.count_if(has).alias(f"{f}_n1"),
            F.count_if(~has).alias(f"{f}_n0"),
            F.avg(F.when(has, e)).alias(f"{f}_e1"),
            F.avg(F.when(~has, e)).alias(f"{f}_e0"),
        ]
    drop = lambda f: 1 - F.try_divide(F.col(f"{f}_e1"), F.col(f"{f}_e0"))
    return _long(
        df.agg(*aggs),
        features,
        lambda f: [
            F.col(f"{f}_n1").alias("rows_filled"),
            F.col(f"{f}_n0").alias("rows_missing"),
            F.round(f"{f}_e1", 4).alias("mae_filled"),
            F.round(f"{f}_e0", 4).alias("mae_missing"),
            F.round(drop(f), 4).alias("relative_gap"),
            F.coalesce(drop(f) >= alarm, F.lit(False)).alias("suspicious"),
        ],
    )


def too_good(metrics: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Long ``(model, metric, value)`` rows with an alarm on values above their limit."""
    limit = F.coalesce(*[F.when(F.col("metric") == m, F.lit(float(v))) for m, v in limits.items()])
    return metrics.withColumn("alarm", F.coalesce(F.col("value") > limit, F.lit(False)))


def verdict_frame(spark: SparkSession, features: Iterable[str], label: str, catalog: Mapping[str, Feature]) -> DataFrame:
    bad = dict(lineage_verdicts(features, label, catalog))
    return spark.createDataFrame([(f, f in bad, bad.get(f)) for f in features], "feature string, refused boolean, reason string")
