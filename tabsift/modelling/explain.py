"""What did this model use? Attributions in the units of its answer, per source column."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import union_all
from ..session import staged
from . import trees
from .models import TREES, Model, _scored

CELL = 64  # places of a column's values looked up together
BUCKETS = 1024  # of a column's values, for running sums


def attributions(model: Model, df: DataFrame) -> list[tuple[str, float]]:
    """``(feature, attribution)``, largest first; with several classes the mean over them."""
    return ranked(model, outputs(model, df))


def class_attributions(model: Model, df: DataFrame) -> list[tuple]:
    """``(class, feature, attribution)`` of a classifier, per class largest first; of two classes the second's."""
    return ranked_by_class(model, outputs(model, df))


def _names(model: Model) -> list[str]:
    return [c for c, _ in (model.features if model.kind == "DNN_CLASSIFIER" else model.slots)]


def ranked(model: Model, found: np.ndarray) -> list[tuple[str, float]]:
    return sorted(zip(_names(model), found.mean(axis=0).tolist(), strict=True), key=lambda t: (-t[1], t[0]))


def ranked_by_class(model: Model, found: np.ndarray) -> list[tuple]:
    classes = model.classes[1:] if len(model.classes) == 2 else model.classes
    rows = [(c, n, float(v)) for c, row in zip(classes, found, strict=True) for n, v in zip(_names(model), row, strict=True)]
    return sorted(rows, key=lambda t: (str(t[0]), -t[2], t[1]))


def outputs(model: Model, df: DataFrame) -> np.ndarray:
    """Mean absolute attributions, outputs x columns: an output per class, or one for regressors and two classes."""
    if model.kind in TREES:
        found = trees.mean_values(_scored(model, df), trees.ensembles(model.pipeline.stages[-1], model.slots))
        return found[1:] if len(model.classes) == 2 else found
    return _linear(model, df) if model.kind in ("LINEAR_REG", "LOGISTIC_REG") else _redrawn(model, df)


def shapley(model: Model, df: DataFrame) -> DataFrame:
    """Rows with ``explained``: per output its class, the ``baseline``, and the Shapley value of every column.

    Baseline and values sum up to the row's answer: the value of a regressor, the probability of a forest's class,
    the margin (half the log-odds) of a boosted classifier's class. Of two classes only the second is given. Map-only.
    """
    if model.kind not in TREES:
        raise ValueError("Shapley values are read from trees; other models have attributions()")
    ensemble = trees.ensembles(model.pipeline.stages[-1], model.slots)
    rows = trees.row_values(_scored(model, df), ensemble, df.columns)
    classes = [str(c) for c in model.classes] or [None]
    first, base = (1 if len(classes) == 2 else 0), ensemble.baseline
    each = []
    for o in range(first, ensemble.outputs):
        parts = [F.struct(F.lit(n).alias("feature"), F.col("_values")[o][i].alias("attribution")) for i, n in enumerate(ensemble.players)]
        each.append(F.struct(F.lit(classes[o]).cast("string").alias("label"), F.lit(float(base[o])).alias("baseline"), F.array(*parts).alias("parts")))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], F.array(*each).alias("explained"))


def _linear(model: Model, df: DataFrame) -> np.ndarray:
    """Exact mean absolute contribution: one column's slots summed, centred on their mean.

    Two aggregates over the data whatever the number of columns.
    """
    fitted = model.pipeline.stages[-1]
    several = model.kind == "LOGISTIC_REG" and len(model.classes) > 2
    weights = fitted.coefficientMatrix.toArray() if several else fitted.coefficients.toArray()[None, :]
    parts, x = [], F.col("_x")
    for of_class in weights.tolist():
        at = 0
        for _, width in model.slots:
            w = of_class[at : at + width]
            if width == 1:
                part = x[at] * w[0]
            else:
                lit = F.array(*[F.lit(float(v)) for v in w])
                part = F.aggregate(F.zip_with(F.slice(x, at + 1, width), lit, lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
            parts.append(part)
            at += width
    rows = _scored(model, df).select(vector_to_array("_features").alias("_x")).select(*[p.alias(f"c{i}") for i, p in enumerate(parts)])
    mean = rows.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(len(parts))]).first()
    away = rows.agg(*[F.avg(F.abs(F.col(f"c{i}") - F.lit(mean[i]))).alias(f"c{i}") for i in range(len(parts))]).first()
    return np.array([v or 0.0 for v in away]).reshape(len(weights), len(model.slots))


def _redrawn(model: Model, df: DataFrame) -> np.ndarray:
    """Mean absolute change of each class's probability when one column is drawn anew from its own values.

    The draw is a hash of the row into the whole column's values, each as often as it occurs, so no rows are
    exchanged and the result is repeatable. A missing value is one of them; a whole vector is not redrawn.
    """
    names = [c for c, _ in model.features]
    vectors = [isinstance(df.schema[c].dataType, (T.ArrayType, T.UserDefinedType)) for c in names]
    rows = redrawn(df, [None if v else c for c, v in zip(names, vectors, strict=True)], names)
    draws = [f"_d{i}" for i, v in enumerate(vectors) if not v]
    probs = vector_to_array("probability")
    rows = _scored(model, rows).select(*names, *draws, probs.alias("_base"))
    for i, c in enumerate(names):
        if vectors[i]:
            rows = rows.withColumn(f"_f{i}", F.col("_base"))
            continue
        kept = [k for k in rows.columns if k not in names]
        swapped = rows.withColumn(f"_orig_{i}", F.col(c)).withColumn(c, F.col(f"_d{i}"))
        out = _scored(model, swapped).withColumn(f"_f{i}", probs)
        back = [F.col(f"_orig_{i}").alias(c) if n == c else F.col(n) for n in names]
        rows = out.select(*back, *kept, f"_f{i}")
    classes = range(1, 2) if len(model.classes) == 2 else range(len(model.classes))
    change = [F.avg(F.abs(F.col(f"_f{i}")[o] - F.col("_base")[o])) for o in classes for i in range(len(names))]
    row = rows.agg(*[c.alias(f"f{n}") for n, c in enumerate(change)]).first()
    return np.array([v or 0.0 for v in row]).reshape(len(classes), len(names))


def redrawn(df: DataFrame, redraw: list[str | None], names: list[str]) -> DataFrame:
    """The columns ``names``, and for each i of ``redraw`` that is a column a value of it as ``_d{i}``, written once."""
    key = F.xxhash64(*[F.col(f"`{c}`") for c in names])
    rows = df.select(*[F.col(f"`{c}`") for c in names], key.alias("_key"))
    for i, c in enumerate(redraw):
        if c is None:
            continue
        cells, total = _cells(df, c)
        if not total:
            rows = rows.withColumn(f"_d{i}", F.col(f"`{c}`"))
            continue
        place = F.pmod(F.xxhash64("_key", F.lit(i)), F.lit(total))
        rows = rows.withColumn("_place", place).withColumn("_cell", F.floor(F.col("_place") / CELL).cast("long"))
        last = F.element_at(F.filter("_values", lambda v: v["start"] <= F.col("_place")), -1)
        rows = rows.join(cells, "_cell").withColumn(f"_d{i}", last["value"]).drop("_cell", "_place", "_values")
    return staged(rows.drop("_key"), "redrawn")


def _cells(df: DataFrame, c: str) -> tuple[DataFrame, int]:
    """All values of a column side by side, each as wide as it is frequent, cut into cells of CELL places; their length.

    A cell holds the values that lie in it with the place where each begins. Values are counted first; they are laid
    out by hash bucket, so that running sums are per bucket and only the buckets' totals meet in one place.
    """
    value = F.col("value")
    counted = df.select(F.col(f"`{c}`").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    order = F.xxhash64(value)
    counted = staged(counted.withColumn("_bucket", F.pmod(order, F.lit(BUCKETS))), "values")
    at, begins = 0, []
    for r in sorted(counted.groupBy("_bucket").agg(F.sum("n").alias("n")).collect(), key=lambda r: r["_bucket"]):
        begins.append((r["_bucket"], at))
        at += r["n"]
    offsets = F.broadcast(df.sparkSession.createDataFrame(begins, "_bucket long, _begin long"))
    running = F.sum("n").over(W.partitionBy("_bucket").orderBy(order, value).rowsBetween(W.unboundedPreceding, W.currentRow))
    laid = counted.withColumn("_end", running).join(offsets, "_bucket")
    laid = laid.select("value", (F.col("_begin") + F.col("_end") - F.col("n")).alias("start"), (F.col("_begin") + F.col("_end") - 1).alias("_stop"))
    spans = F.sequence(F.floor(F.col("start") / CELL).cast("long"), F.floor(F.col("_stop") / CELL).cast("long"))
    spread = laid.select("value", "start", F.explode(spans).alias("_cell"))
    cells = spread.groupBy("_cell").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("_values"))
    return staged(cells, "cells"), at


def global_explain(model: Model, spark, class_level: bool = False) -> DataFrame:
    """The attributions stored at training; they cannot be asked for afterwards. ``class_level`` gives them per class."""
    if model.attribution is None:
        raise ValueError("train with global_explain=True to keep attributions with the model")
    if class_level:
        rows = [(str(c), f, v) for c, f, v in model.class_attribution]
        return spark.createDataFrame(rows, "label string, feature string, attribution double").orderBy("label", F.desc("attribution"), "feature")
    return spark.createDataFrame(model.attribution, "feature string, attribution double").orderBy(F.desc("attribution"), "feature")


def compare_rankings(models: Mapping[str, Model], spark) -> DataFrame:
    """Each feature's rank and attribution per model: importance belongs to a model."""
    long = union_all([global_explain(m, spark).withColumn("model", F.lit(name)) for name, m in models.items()])
    ranked = long.withColumn("rank", F.rank().over(W.partitionBy("model").orderBy(F.desc("attribution"))))
    wide: list[Column] = []
    for name in models:
        here = F.col("model") == name
        wide += [F.max(F.when(here, F.col("rank"))).alias(f"{name}_rank"), F.max(F.when(here, F.col("attribution"))).alias(f"{name}_attribution")]
    return ranked.groupBy("feature").agg(*wide)
