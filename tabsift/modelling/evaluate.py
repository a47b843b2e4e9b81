"""Metrics, confusion, baselines and errors as aggregates over predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import col
from ..operators import quantiles, records
from ..session import broadcast_if_small, one_row, staged

REGRESSION = ("mean_absolute_error", "mean_squared_error", "median_absolute_error", "r2_score", "explained_variance")
CLASSIFICATION = ("precision", "recall", "accuracy", "f1_score", "log_loss", "roc_auc")

# Different scores that one range of the curve should hold.
BIN_ROWS = 100_000


def regression_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row of metrics; everything but the median error is a single aggregate."""
    pairs = df.select(col(truth).cast("double").alias("y"), col(predicted).cast("double").alias("p")).dropna()
    pairs = pairs.withColumn("e", F.col("y") - F.col("p"))
    median = one_row(quantiles.exact(pairs, F.abs("e"), {"m": 0.5}))["m"]
    # Population variances keep the sums centred: no large squares are subtracted.
    return pairs.agg(
        F.avg(F.abs("e")).alias("mean_absolute_error"),
        F.avg(F.col("e") * F.col("e")).alias("mean_squared_error"),
        (1 - F.try_divide(F.avg(F.col("e") * F.col("e")), F.var_pop("y"))).alias("r2_score"),
        (1 - F.try_divide(F.var_pop("e"), F.var_pop("y"))).alias("explained_variance"),
    ).select("mean_absolute_error", "mean_squared_error", median.alias("median_absolute_error"), "r2_score", "explained_variance")


def classification_metrics(df: DataFrame, truth: Column, predicted: Column, score: Column) -> DataFrame:
    """Metrics of a binary classifier; ``score`` is the probability of TRUE."""
    rows = df.select(truth.cast("boolean").alias("y"), predicted.cast("boolean").alias("p"), score.cast("double").alias("s")).dropna()
    y, p = F.col("y"), F.col("p")
    s = F.least(F.greatest(F.col("s"), F.lit(1e-15)), F.lit(1 - 1e-15))
    hit, hits, called = F.count_if(y & p), F.count_if(y), F.count_if(p)
    auc = one_row(roc_auc(rows, "y", "s"))["roc_auc"]
    return rows.agg(
        F.try_divide(hit.cast("double"), called).alias("precision"),
        F.try_divide(hit.cast("double"), hits).alias("recall"),
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.try_divide(2.0 * hit, hits + called).alias("f1_score"),
        (-F.avg(F.when(y, F.ln(s)).otherwise(F.ln(1 - s)))).alias("log_loss"),
    ).select("precision", "recall", "accuracy", "f1_score", "log_loss", auc.alias("roc_auc"))


def multiclass_metrics(df: DataFrame, truth: Column, predicted: Column, prob_of_truth: Column) -> DataFrame:
    """Macro precision, recall and F1, accuracy and log loss from class counts."""
    rows = df.select(truth.cast("string").alias("y"), predicted.cast("string").alias("p"), prob_of_truth.alias("q")).dropna(subset=["y", "p"])
    q = F.greatest(F.coalesce(F.col("q"), F.lit(0.0)), F.lit(1e-15))
    cells = rows.groupBy("y", "p").agg(F.count("*").alias("n"), F.sum(-F.ln(q)).alias("loss"))
    sides = cells.select(F.explode(F.array(F.struct(F.col("y").alias("c"), F.lit(True).alias("is_y")), F.struct(F.col("p").alias("c"), F.lit(False).alias("is_y")))).alias("k"), "n", "y", "p")
    per_class = sides.groupBy("k.c").agg(
        F.sum(F.when(F.col("k.is_y") & (F.col("y") == F.col("p")), F.col("n")).otherwise(0)).alias("hit"),
        F.sum(F.when(F.col("k.is_y"), F.col("n")).otherwise(0)).alias("real"),
        F.sum(F.when(~F.col("k.is_y"), F.col("n")).otherwise(0)).alias("called"),
    ).where("real > 0")
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    macro = one_row(
        per_class.agg(
            F.avg(ratio(F.col("hit"), F.col("called"))).alias("precision"),
            F.avg(ratio(F.col("hit"), F.col("real"))).alias("recall"),
            F.avg(ratio(2.0 * F.col("hit"), F.col("real") + F.col("called"))).alias("f1_score"),
        )
    )
    total = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).alias("hit"), F.sum("loss").alias("loss"))
    return total.select(
        macro["precision"].alias("precision"),
        macro["recall"].alias("recall"),
        (F.col("hit") / F.col("n")).alias("accuracy"),
        macro["f1_score"].alias("f1_score"),
        (F.col("loss") / F.col("n")).alias("log_loss"),
        F.lit(None).cast("double").alias("roc_auc"),
    )


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Exact area under the curve, ties counted half.

    Rows are first counted per distinct score, so a score that many rows share
    is one row. The scores are cut into ranges of some BIN_ROWS, as many as it
    takes and however close together they lie; only the totals of ranges are
    accumulated in one task, and each range adds up its own scores.
    """
    rows = df.select((F.col(score).cast("double") + 0.0).alias("s"), F.col(truth).cast("boolean").alias("y")).dropna()
    counts = staged(rows.groupBy("s").agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg")), "scores")
    ranges = 1 + counts.count() // BIN_ROWS
    binned = counts.withColumn("bin", F.lit(0))
    if ranges > 1:  # written, so that every later job sees the same ranges
        binned = staged(counts.repartitionByRange(ranges, "s").withColumn("bin", F.spark_partition_id()), "ranges")
    wins = F.col("pos") * (F.col("below") + F.col("neg") / 2.0)
    area = F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc")
    earlier = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    offsets = binned.groupBy("bin").agg(F.sum("neg").alias("neg"))
    offsets = offsets.select("bin", F.coalesce(F.sum("neg").over(earlier.partitionBy(F.lit(0))), F.lit(0)).alias("offset"))
    lower = W.partitionBy("bin").orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    ranked = binned.withColumn("inside", F.coalesce(F.sum("neg").over(lower), F.lit(0))).join(broadcast_if_small(offsets), "bin")
    return ranked.withColumn("below", F.col("offset") + F.col("inside")).agg(area)


def confusion_matrix(df: DataFrame, truth: str, predicted: str, labels: Sequence) -> DataFrame:
    """Truth in rows, one count column per predicted label."""
    text = df.select(F.col(truth).cast("string").alias("expected_label"), F.col(predicted).cast("string").alias("_p"))
    names = [str(v).lower() if isinstance(v, bool) else str(v) for v in labels]
    counts = text.groupBy("expected_label").agg(*[F.count_if(F.col("_p") == v).alias(f"predicted_{v}") for v in names])
    return counts


def mean_baseline(df: DataFrame, truth: str) -> DataFrame:
    """Always guessing the mean: its error is the spread, its R² is 0 by definition."""
    mean = df.agg(F.avg(truth)).scalar()
    return regression_metrics(df.select(F.col(truth).alias("y"), mean.alias("p")), "y", "p")


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """Always answering the commonest class: the accuracy to beat."""
    counts = df.groupBy(F.col(label).alias("majority")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.orderBy(F.desc("n"), F.col("majority").cast("string")).limit(1).select(
        "majority", "n", F.round(100.0 * F.col("n") / total, 1).alias("accuracy_pct")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``n / (k * n_class)``: every class weighs the same in total."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    t = one_row(counts.agg(F.sum("n").alias("n"), F.count("*").alias("k")))
    return counts.withColumn("weight", t["n"] / (t["k"] * F.col("n")))


def worst_predictions(df: DataFrame, truth: str, predicted: str, n: int, tie: Sequence[str]) -> DataFrame:
    """The largest absolute errors, over- and underestimates alike."""
    e = F.col(predicted) - F.col(truth)
    return df.withColumn("error", e).orderBy(F.abs("error").desc(), *tie).limit(n)


def confident_errors(df: DataFrame, truth: str, predicted: str, probs: str, n: int, tie: Sequence[str]) -> DataFrame:
    """Wrong answers by the probability the model gave them."""
    own = F.filter(probs, lambda p: p["label"].eqNullSafe(F.col(predicted)))
    wrong = df.where(~F.col(predicted).eqNullSafe(F.col(truth))).withColumn("confidence", F.get(own, F.lit(0))["prob"])
    return wrong.orderBy(F.desc("confidence"), *tie).limit(n)


def residual_outliers(df: DataFrame, truth: str, predicted: str, segment: str, limit: float = 3.5) -> DataFrame:
    """Rows whose residual is far from their segment's, by median and MAD.

    A model used as a detector of bad records: 0.6745·|r − median| / MAD > limit.
    """
    rows = staged(df.withColumn("residual", F.col(truth) - F.col(predicted)).where(F.col("residual").isNotNull()), "residuals")

    def beside(df: DataFrame, column: str, name: str) -> DataFrame:
        """The segment's median next to each row; rows without a segment are one of their own."""
        found = broadcast_if_small(quantiles.exact(df, column, {name: 0.5}, by=[segment]).withColumnRenamed(segment, "_segment"))
        return df.join(found, df[segment].eqNullSafe(found["_segment"])).drop("_segment")

    off = beside(rows, "residual", "_med").withColumn("_dev", F.abs(F.col("residual") - F.col("_med")))
    scored = beside(off, "_dev", "_mad").withColumn("robust_z", F.try_divide(0.6745 * F.col("_dev"), F.col("_mad")))
    return scored.where(F.col("robust_z") > limit).drop("_med", "_dev", "_mad")


def residual_causes(
    df: DataFrame, truth: str, predicted: str, segment: str, ident: str, keys: Mapping[str, Sequence[str]], limit: float = 3.5
) -> DataFrame:
    """The rows of ``residual_outliers`` with ``record_id`` and ``copies``: is the bad error a record entered twice?

    ``keys`` are natural keys by name, as in ``records.same_records``; all rows count as copies, also those without an answer.
    """
    flagged = staged(records.same_records(df, ident, keys), "records")
    return residual_outliers(flagged, truth, predicted, segment, limit)


def outliers_by_copies(df: DataFrame, odd: DataFrame, ident: str) -> DataFrame:
    """Rows and residual outliers among repeated and single records, with the share of outliers in each.

    ``df`` holds the flags of ``records.same_records``, ``odd`` is some of its rows; both are counted before they meet.
    """
    repeated = (F.col("copies") > 1).alias("repeated")
    rows = df.where(F.col(f"`{ident}`").isNotNull()).groupBy(repeated).agg(F.count("*").alias("rows"))
    bad = odd.where(F.col(f"`{ident}`").isNotNull()).groupBy(repeated).agg(F.count("*").alias("outliers"))
    both = rows.join(F.broadcast(bad), "repeated", "left")  # two rows each
    outliers = F.coalesce("outliers", F.lit(0))
    return both.select("repeated", "rows", outliers.alias("outliers"), (outliers / F.col("rows")).alias("share"))


def small_segments(df: DataFrame, segment: str, min_share: float = 0.02) -> DataFrame:
    """Rows per segment with an alarm on segments too small to draw conclusions from."""
    sizes = df.groupBy(segment).agg(F.count("*").alias("rows"))
    total = sizes.agg(F.sum("rows")).scalar()
    share = F.col("rows") / total
    return sizes.withColumn("pct", F.round(100 * share, 3)).withColumn("too_small", share < min_share)


def davies_bouldin(df: DataFrame, features: Sequence[str], cluster: str) -> float:
    """Davies–Bouldin index of an assignment (lower is better separated).

    Two aggregates: centroids, then mean distance to the own centroid. Only the
    k centroids meet on the driver.
    """
    centres = df.groupBy(cluster).agg(*[F.avg(f).alias(f"_c_{f}") for f in features])
    if centres.count() > 10_000:  # before anything is fetched
        raise ValueError("too many clusters to compare pairwise")
    rows = centres.orderBy(cluster).collect()
    if len(rows) < 2:
        return float("nan")
    fixed = F.broadcast(df.sparkSession.createDataFrame(rows, centres.schema))
    dist = F.sqrt(sum((F.col(f) - F.col(f"_c_{f}")) ** 2 for f in features))
    spread = {r[0]: r[1] for r in df.join(fixed, cluster).groupBy(cluster).agg(F.avg(dist)).collect()}
    c = np.array([[r[f"_c_{f}"] for f in features] for r in rows])
    s = np.array([spread[r[cluster]] for r in rows])
    worst = []
    for i in range(len(c)):  # one row of the comparison at a time
        apart = np.linalg.norm(c - c[i], axis=1)
        apart[i] = np.inf
        worst.append(((s + s[i]) / apart).max())
    return float(np.mean(worst))
