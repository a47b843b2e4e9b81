"""Search inside a model type: candidates compared on growing samples, most of them dropped early.

Rows are dealt once, by a hash, to folds and to nested samples: a row of a small sample is in every larger one. In each
round all candidates left are trained and scored fold by fold on the round's sample, several at a time as Spark jobs
of their own, on rows prepared once per fold; the best share of them goes on to a sample that is as many times larger. The last round uses all rows.

Defined cases: rows without a label are left out; equal scores are settled by the order of the grid; a grid of one
candidate is scored on all rows at once; a score that does not exist (one class in a fold) counts as the lowest.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .models import REGRESSORS, Model, train_each
from .split import split

# Rows that the smallest sample should have.
LEAST_ROWS = 10_000
PLACES = 1 << 30


@dataclass
class Trial:
    round: int
    candidate: dict
    share: float
    fits: int
    score: float
    kept: bool


def candidates(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the options' values, in the order given."""
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def schedule(n: int, rows: int, keep: int, least: int = LEAST_ROWS) -> list[tuple[int, float]]:
    """(candidates, share of the rows) per round: shares grow as candidates fall, and the last one is all rows."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // keep))
    shares = [max(keep ** -float(len(out) - 1 - i), min(1.0, least / max(1, rows))) for i in range(len(out))]
    # Rounds on all rows after the first such one would only repeat it.
    first = shares.index(1.0)
    return list(zip(out[: first + 1], shares[: first + 1], strict=True))


def _dealt(df: DataFrame, label: str, folds: int, seed: int) -> DataFrame:
    """The rows, written once, with their fold and their place in the nested samples."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    place = F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(PLACES))
    fold = F.pmod(F.xxhash64(F.lit(~seed), *columns), F.lit(folds))
    return staged(df.where(F.col(f"`{label}`").isNotNull()).withColumns({"_place": place, "_fold": fold}), "search")


def halving_search(
    df: DataFrame, label: str, kind: str, grid: Mapping[str, Sequence], metric: str | None = None, keep: int = 3, folds: int = 2,
    seed: int = 42, parallel: int = 4, least: int = LEAST_ROWS, full: bool = False,
) -> list[Trial]:
    """All trials, the winner last among those kept: of every round one in ``keep`` goes on. ``full`` tries all on all rows.

    ``metric`` is the one to raise, R² or the area under the curve by default, and accuracy for several classes.
    """
    spark, tried = df.sparkSession, candidates(grid)
    rows = _dealt(df, label, folds, seed)
    plan = [(len(tried), 1.0)] if full else schedule(len(tried), rows.count(), keep, least)
    trials: list[Trial] = []

    def scores(job: tuple[list[dict], float, int]) -> list[float]:
        """Of all candidates on one fold: they train on the same rows, which are prepared once."""
        tried, share, fold = job
        part = rows.where(F.col("_place") < int(share * PLACES)) if share < 1 else rows
        fit, held = split(part.withColumn("_held", F.col("_fold") == fold).drop("_place", "_fold"), "BY_COLUMN", column="_held")
        variants = [{"seed": seed, **c} for c in tried]
        found = train_each(fit, held, kind, label, variants, rows=part, split_method="BY_COLUMN", parallel=max(1, parallel // folds))
        return [_value(m, metric) for m in found]

    with ThreadPool(min(parallel, folds)) as pool:
        for i, (_, share) in enumerate(plan):
            found = pool.map(inheritable_thread_target(spark)(scores), [(tried, share, f) for f in range(folds)])
            means = [sum(of_one) / folds for of_one in zip(*found, strict=True)]
            order = sorted(range(len(tried)), key=lambda j: (-means[j], j))
            left = set(order[: plan[i + 1][0] if i + 1 < len(plan) else 1])
            trials += [Trial(i + 1, c, share, folds, means[j], j in left) for j, c in enumerate(tried)]
            tried = [tried[j] for j in sorted(left)]
    return trials


def _value(model: Model, metric: str | None) -> float:
    name = metric or ("r2_score" if model.kind in REGRESSORS else "roc_auc" if len(model.classes) == 2 else "accuracy")
    value = model.metrics[name]
    return -math.inf if value is None or math.isnan(value) else float(value)


def winner(trials: Sequence[Trial]) -> dict:
    """The candidate left after the last round."""
    last = max(t.round for t in trials)
    return next(t.candidate for t in trials if t.round == last and t.kept)


def report(spark, trials: Sequence[Trial]) -> DataFrame:
    """A row per trial: round, candidate as JSON, share of the rows, fits, score, kept."""
    rows = [(t.round, json.dumps(t.candidate, sort_keys=True), t.share, t.fits, t.score, t.kept) for t in trials]
    return spark.createDataFrame(rows, "round int, candidate string, share double, fits int, score double, kept boolean")
