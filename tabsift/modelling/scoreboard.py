"""Compare models on one shared hold-out, next to the baseline they must beat."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from . import evaluate as ev
from .models import CLUSTER_COUNTS, REGRESSORS, UNSUPERVISED, Model, evaluate, predict, train, train_each
from .split import split as _split

# What ``train`` takes beside the options of a model.
TRAINING = {"split_method", "split_column", "global_explain", "catalog", "stage"}


def split(df: DataFrame, policy: str, seed: int = 42):
    """One written table, cut once: every model of a comparison sees the same rows."""
    return _split(staged(df, "compared"), policy, seed)


def _long(spark, rows: list[tuple[str, dict]]) -> DataFrame:
    flat = [(name, metric, None if v is None else float(v)) for name, metrics in rows for metric, v in metrics.items()]
    return spark.createDataFrame(flat, "model string, metric string, value double")


def _baseline(df: DataFrame, label: str, regression: bool) -> dict:
    if regression:
        return ev.mean_baseline(df, label).first().asDict()
    top = ev.majority_baseline(df, label).first()
    return {"accuracy": top["accuracy_pct"] / 100.0}


def scoreboard(models: Mapping[str, Model], holdout: DataFrame) -> DataFrame:
    """Long ``(model, metric, value)`` rows, baseline included.

    The hold-out is read once per model, and only the columns that model needs.
    """
    first = next(iter(models.values()))
    rows = [("baseline", _baseline(holdout, first.label, first.kind in REGRESSORS))]
    rows += [(name, evaluate(m, holdout).first().asDict()) for name, m in models.items()]
    return _long(holdout.sparkSession, rows)


def model_search(df: DataFrame, label: str, kinds: Sequence[str], seed: int = 42, split_method: str = "AUTO", **options) -> DataFrame:
    """Train several model types on one split and score all of them on its other side.

    Types that prepare their rows alike share the prepared rows, and no type is measured on the rows it learned from.
    """
    fit, held = split(df, split_method, seed)
    ways = {k: {"seed": seed, **options.get(k, {})} for k in kinds}
    if any(k.upper() in UNSUPERVISED or set(o) & TRAINING for k, o in ways.items()) or len({k.upper() in REGRESSORS for k in kinds}) > 1:
        return scoreboard({k: train(fit, k, label, split_method="NONE", stage=False, **o) for k, o in ways.items()}, held)
    models = train_each(fit, held, list(ways), label, list(ways.values()))
    rows = [("baseline", _baseline(held, label, models[0].kind in REGRESSORS))]
    return _long(held.sparkSession, rows + [(k, m.metrics) for k, m in zip(ways, models, strict=True)])


def ablate(
    df: DataFrame, label: str, kind: str, groups: Mapping[str, Sequence[str]], seed: int = 42, split_method: str = "AUTO", **options
) -> DataFrame:
    """The same model without each named group of columns, and with all of them."""
    fit, held = split(df, split_method, seed)
    models = {"all": train(fit, kind, label, split_method="NONE", stage=False, seed=seed, **options)}
    for name, columns in groups.items():
        models[f"without_{name}"] = train(fit.drop(*columns), kind, label, split_method="NONE", stage=False, seed=seed, **options)
    return scoreboard(models, held)


def seed_spread(df: DataFrame, label: str, kind: str, seeds: Sequence[int], split_method: str = "AUTO", **options) -> DataFrame:
    """Lowest and highest value of each metric over repeated trainings on one split.

    Every training takes the same prepared rows, and the hold-out is read once for all models.
    """
    fit, held = split(df, split_method)
    models = train_each(fit, held, kind, label, [{**options, "seed": s} for s in seeds])
    rows = [(str(s), m.metrics) for s, m in zip(seeds, models, strict=True)]
    return _long(df.sparkSession, rows).groupBy("metric").agg(
        F.count("value").alias("runs"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def k_sweep(df: DataFrame, ks: Sequence[int] = CLUSTER_COUNTS, seed: int = 42) -> DataFrame:
    """Davies–Bouldin index per number of clusters; the lowest marks the choice."""
    df = staged(df, "clustered")
    found = [(k, evaluate(train(df, "KMEANS", num_clusters=k, seed=seed, stage=False), df).first()[0]) for k in ks]
    best = min(found, key=lambda t: t[1])[0]
    return df.sparkSession.createDataFrame([(k, v, k == best) for k, v in found], "num_clusters int, davies_bouldin_index double, chosen boolean")


def segment_feature(df: DataFrame, label: str, columns: Sequence[str], kind: str, k: int = 4, seed: int = 42, **options) -> DataFrame:
    """Does a segment found without the label help a model that predicts it?

    The clustering is trained on the training side only and never sees the label.
    """
    if label in columns:
        raise ValueError("a segment built with the label would leak it")
    fit, held = split(df, "AUTO", seed)
    segments = train(fit.select(*columns), "KMEANS", num_clusters=k, seed=seed)

    def mark(part: DataFrame) -> DataFrame:
        return predict(segments, part).withColumn("segment", F.col("CENTROID_ID").cast("string")).drop("CENTROID_ID")

    models = {"with_segment": train(mark(fit), kind, label, split_method="NONE", seed=seed, **options)}
    plain = train(fit, kind, label, split_method="NONE", stage=False, seed=seed, **options)
    both = scoreboard(models, mark(held))
    return both.unionByName(scoreboard({"without_segment": plain}, held).where("model <> 'baseline'"))

