"""Shapley values of tree ensembles, exact and row by row, from the fitted trees alone.

A tree says what its answer would be if only some columns were known: where a split asks for an unknown one, both
sides count by their shares of the training rows. A column's Shapley value is its mean change of that answer over all
orders in which columns become known. For one leaf only the columns on its path matter: with the share of training rows
that take the leaf's side at a column's splits, and whether the row at hand does, the mean over all orders follows
from the coefficients of a short polynomial. Values of a row sum up to its answer minus the ensemble's mean answer.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, OneVsRestModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns on a path up to which all patterns of a leaf are worked out ahead.
TABLE_COLUMNS = 10
# Bytes of values that a task keeps for rows to come.
KNOWN_BYTES = 32 * 1024 * 1024


@dataclass
class Split:
    slot: int
    threshold: float | None
    left: tuple[float, ...]  # categories that go left, where there is no threshold

    def goes_left(self, x: np.ndarray) -> np.ndarray:
        return x <= self.threshold if self.threshold is not None else np.isin(x, self.left)


@dataclass
class Leaf:
    players: list[int]
    shares: np.ndarray  # of training rows that stay on the path, per player
    steps: list[list[tuple[int, bool]]]  # per player: (split, whether the path goes left)
    value: np.ndarray  # per output


def patterns_to_values(present: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Shapley values of a game that pays the product of ``present`` (known) or ``shares`` (unknown) over its players.

    ``present`` is rows x players of 0 and 1.
    """
    n, d = present.shape
    out = np.zeros((n, d))
    weights = np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)])
    for i in range(d):
        known = np.zeros((n, d))  # coefficients by the number of known players
        known[:, 0] = 1.0
        for j in range(d):
            if j != i:
                known[:, 1:] = known[:, 1:] * shares[j] + known[:, :-1] * present[:, [j]]
                known[:, 0] *= shares[j]
        out[:, i] = (present[:, i] - shares[i]) * (known @ weights)
    return out


@dataclass
class Ensemble:
    """All paths of a model's trees, over the vector slots that their splits ask for."""

    players: list[str]
    outputs: int
    slots: list[int] = field(default_factory=list)
    splits: list[Split] = field(default_factory=list)
    leaves: list[Leaf] = field(default_factory=list)
    marks: list[np.ndarray] | None = field(default=None, repr=False, compare=False)  # per slot what its splits ask for
    listed: list[bool] = field(default_factory=list, repr=False, compare=False)
    known: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False, compare=False)  # cells and their values

    @property
    def baseline(self) -> np.ndarray:
        return sum((leaf.value * leaf.shares.prod() for leaf in self.leaves), np.zeros(self.outputs))

    def values(self, x: np.ndarray) -> np.ndarray:
        """rows x outputs x players, for rows of the used slots; rows that answer all splits alike share their values.

        Between its thresholds a slot's values answer alike. The places of a row in all slots make one number, its cell; the
        values of cells met before are kept, up to KNOWN_BYTES.
        """
        if not self.splits or not len(x):
            return np.zeros((len(x), self.outputs, len(self.players)))
        codes, lasting = self._cells(x)
        cells, first, at = np.unique(codes, return_index=True, return_inverse=True)
        if self.known is None or not lasting:
            self.known = cells, self._answers(x[first])
        elif len(new := np.flatnonzero(~np.isin(cells, self.known[0], assume_unique=True))):
            more, old = self._answers(x[first[new]]), self.known
            both = np.concatenate([old[0], cells[new]])
            order = np.argsort(both)
            self.known = both[order], np.concatenate([old[1], more])[order]
        found = self.known[1][np.searchsorted(self.known[0], cells)][at]
        if not lasting or self.known[1].nbytes > KNOWN_BYTES:
            self.known = None
        return found

    def _cells(self, x: np.ndarray) -> tuple[np.ndarray, bool]:
        """The number of each row's cell, and whether it means the same for other rows too."""
        if self.marks is None:
            of_slot = lambda s: [v for t in self.splits if t.slot == s for v in ([t.threshold] if t.threshold is not None else t.left)]
            self.marks = [np.unique(np.array(of_slot(s), dtype="float64")) for s in self.slots]
            self.listed = [any(t.slot == s and t.threshold is None for t in self.splits) for s in self.slots]
        code, size, lasting = np.zeros(len(x), np.int64), 1, True
        for i, (marks, listed) in enumerate(zip(self.marks, self.listed, strict=True)):
            place = np.searchsorted(marks, x[:, i])  # at a mark or below it, above the one before; undefined ones beyond all
            width = len(marks) + 1
            if listed:  # a category of a list is at its mark, any other is not
                there = marks[np.minimum(place, len(marks) - 1)] == x[:, i]
                place, width = 2 * place + there, 2 * width
            if size * width >= 1 << 62:  # too many cells for one number: go on from the ones that these rows are in
                several, code = np.unique(code, return_inverse=True)
                size, lasting = len(several), False
            code, size = code * width + place, size * width
        return code, lasting

    def _answers(self, x: np.ndarray) -> np.ndarray:
        place = {s: i for i, s in enumerate(self.slots)}
        return self._of_answers(np.array([s.goes_left(x[:, place[s.slot]]) for s in self.splits]))

    def _of_answers(self, left: np.ndarray) -> np.ndarray:
        """patterns x outputs x players, for patterns of splits x whether they go left."""
        n = left.shape[1]
        out = np.zeros((n, self.outputs, len(self.players)))
        for leaf in self.leaves:
            if not leaf.players:
                continue
            code = np.zeros(n, np.int64)
            for j, steps in enumerate(leaf.steps):
                stays = np.ones(n, bool)
                for split, goes_left in steps:
                    stays &= left[split] if goes_left else ~left[split]
                code |= stays.astype(np.int64) << j
            d = len(leaf.players)
            codes, at = (np.arange(1 << d), code) if d <= TABLE_COLUMNS else np.unique(code, return_inverse=True)
            part = patterns_to_values(((codes[:, None] >> np.arange(d)) & 1).astype(float), leaf.shares)[at]
            for o, v in enumerate(leaf.value):
                if v:
                    out[:, o, leaf.players] += v * part
        return out


def _add_tree(ensemble: Ensemble, root, owner: list[int], value_of) -> None:
    def walk(node, path: list[tuple[int, bool, float]]):
        if node.getClass().getSimpleName() == "LeafNode":
            by_player: dict[int, list] = {}
            for split, goes_left, share in path:
                by_player.setdefault(owner[ensemble.splits[split].slot], []).append((split, goes_left, share))
            players = sorted(by_player)
            shares = np.array([math.prod(s for _, _, s in by_player[p]) for p in players])
            ensemble.leaves.append(Leaf(players, shares, [[(s, g) for s, g, _ in by_player[p]] for p in players], value_of(node)))
            return
        split, held = node.split(), node.impurityStats().count()
        if "Categorical" in split.getClass().getSimpleName():
            mine = Split(split.featureIndex(), None, tuple(split.leftCategories()))
        else:
            mine = Split(split.featureIndex(), split.threshold(), ())
        ensemble.splits.append(mine)
        at = len(ensemble.splits) - 1
        for child, goes_left in ((node.leftChild(), True), (node.rightChild(), False)):
            walk(child, [*path, (at, goes_left, child.impurityStats().count() / held)])

    walk(root, [])


def ensembles(fitted, slots: list[tuple[str, int]]) -> Ensemble:
    """The paths of a fitted boosted or bagged ensemble.

    Regressors have one output, the answer. Forests have one per class, its probability; boosted classifiers one per
    class, the margin (half the log-odds) of that class, which for two classes is the second one's and its negative.
    """
    owner = [i for i, (_, width) in enumerate(slots) for _ in range(width)]
    players = [name for name, _ in slots]
    if isinstance(fitted, OneVsRestModel):
        out = Ensemble(players, len(fitted.models))
        for c, one in enumerate(fitted.models):
            _add(out, one, owner, lambda v, c=c: np.eye(out.outputs)[c] * v)
    elif isinstance(fitted, GBTClassificationModel):
        out = Ensemble(players, 2)
        _add(out, fitted, owner, lambda v: np.array([-v, v]))
    elif isinstance(fitted, RandomForestClassificationModel):
        out = Ensemble(players, fitted.numClasses)
        for tree in fitted.trees:

            def rates(node):
                stats = np.array(list(node.impurityStats().stats()))
                return stats / stats.sum() / len(fitted.trees)

            _add_tree(out, tree._call_java("rootNode"), owner, rates)
    else:
        out = Ensemble(players, 1)
        _add(out, fitted, owner, lambda v: np.array([v]))
    out.slots = sorted({s.slot for s in out.splits})
    return out


def _add(out: Ensemble, fitted, owner, spread) -> None:
    """Trees whose answers are summed by weight; a forest of regressors takes the mean."""
    boosted = "GBT" in type(fitted).__name__
    for tree, weight in zip(fitted.trees, fitted.treeWeights, strict=True):
        share = weight if boosted else 1.0 / len(fitted.trees)
        _add_tree(out, tree._call_java("rootNode"), owner, lambda node, share=share: spread(node.prediction() * share))


def _used(ensemble: Ensemble):
    """The used slots of a row's vector as columns."""
    cells = vector_to_array("_features")
    return [cells[s].alias(f"_used{i}") for i, s in enumerate(ensemble.slots)]


def _stacked(columns: list[pa.Array], rows: int) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns]) if columns else np.zeros((rows, 0))


def row_values(scored: DataFrame, ensemble: Ensemble, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``_values``: per output an array with a value per column of the model; map-only."""
    sent = scored.sparkSession.sparkContext.broadcast(ensemble)
    kept = len(keep)

    def run(batches):
        model = sent.value
        for batch in batches:
            found = model.values(_stacked(batch.columns[kept:], len(batch)))
            n, outputs, players = found.shape
            inner = pa.ListArray.from_arrays(pa.array(np.arange(n * outputs + 1, dtype=np.int32) * players), pa.array(found.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * outputs), inner)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], lists], [*batch.schema.names[:kept], "_values"])

    rows = scored.select(*[F.col(f"`{c}`") for c in keep], *_used(ensemble))
    schema = T.StructType([*rows.schema.fields[:kept], T.StructField("_values", T.ArrayType(T.ArrayType(T.DoubleType())))])
    return rows.mapInArrow(run, schema)


def mean_values(scored: DataFrame, ensemble: Ensemble) -> np.ndarray:
    """outputs x columns: mean absolute Shapley values. Tasks add up their batches; only those sums are shuffled."""
    sent = scored.sparkSession.sparkContext.broadcast(ensemble)

    def run(batches):
        model = sent.value
        total, n = np.zeros((model.outputs, len(model.players))), 0
        for batch in batches:
            total += np.abs(model.values(_stacked(batch.columns, len(batch)))).sum(axis=0)
            n += len(batch)
        places = np.indices(total.shape, dtype=np.int32).reshape(2, -1)
        columns = [places[0], places[1], total.ravel(), np.full(total.size, n, np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["o", "p", "total", "n"])

    rows = scored.select(*_used(ensemble))
    sums = rows.mapInArrow(run, "o int, p int, total double, n long").groupBy("o", "p").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = np.zeros((ensemble.outputs, len(ensemble.players)))
    for r in sums.collect():  # outputs x columns of the model
        out[r.o, r.p] = r.total / r.n if r.n else 0.0
    return out
