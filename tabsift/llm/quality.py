"""Document quality by a generalised additive model with pairwise interactions.

Each text becomes some twenty numbers (lengths, shares of signs, repetition). Boosting in cycles learns one table of
scores per feature, a little at a time by trees of at most three leaves, then one per chosen pair of features by trees
of four leaves. A document's score is the logistic of the sum of the table entries its bins point to, so scoring is a
handful of array look-ups. The model is fitted to a bounded, documented sample of ``SAMPLE`` labelled rows in hash
order; features are computed for all documents, once.

Defined cases: a null or empty text has its features (zeros) and a score like any other; without labels of both kinds
the score is the share of good labels (0.5 without any); repeated rows each get their result.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drawn, plain, stage

SAMPLE = 60_000
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 250, 120, 12
RATE = 0.08
THRESHOLD = 0.7

FEATURES = [
    "log_bytes", "log_words", "word_length", "longest_word", "distinct_share", "commonest_share", "run_share", "pair_repeats",
    "upper_share", "digit_share", "sign_share", "currency_share", "pipe_share", "bang_share", "end_share", "comma_share",
    "space_share", "beyond_ascii", "byte_entropy", "line_length", "line_repeats", "signed_words", "upper_words", "short_words",
]


def _share(n: float, of: float) -> float:
    return n / of if of else 0.0


def _group(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), np.uint8)


UPPER, DIGIT = _group("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _group("0123456789")
SIGN = _group("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
CURRENCY, PIPE, BANG, END, COMMA = _group("#$%&*@^~+="), _group("|"), _group("!"), _group(".!?"), _group(",;:")
SPACE = _group(" \t\n\r")
_SIGN_SET = set("!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~")


def features(text: str) -> list[float]:
    raw = text.encode()
    n = len(raw)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = text.split()
    w = len(words)
    lengths = np.fromiter(map(len, words), np.int64, w)
    counted = Counter(words)
    runs = sum(a == b for a, b in zip(words, words[1:]))  # noqa: B905
    pairs = len(set(zip(words, words[1:])))  # noqa: B905
    lines = [x for x in text.split("\n") if x]
    letters = max(1, n - int(hist[SIGN].sum()) - int(hist[SPACE].sum()) - int(hist[DIGIT].sum()))
    p = hist[hist > 0] / n if n else np.ones(1)
    return [
        np.log1p(n), np.log1p(w), float(lengths.mean()) if w else 0.0, float(lengths.max()) if w else 0.0,
        _share(len(counted), w), _share(max(counted.values(), default=0), w), _share(runs, w), 1 - _share(pairs, w - 1) if w > 1 else 0.0,
        _share(hist[UPPER].sum(), letters), _share(hist[DIGIT].sum(), n), _share(hist[SIGN].sum(), n), _share(hist[CURRENCY].sum(), n),
        _share(hist[PIPE].sum(), n), _share(hist[BANG].sum(), n), _share(hist[END].sum(), w), _share(hist[COMMA].sum(), w),
        _share(hist[SPACE].sum(), n), _share(hist[128:].sum(), n), float(-(p * np.log2(p)).sum()), np.log1p(_share(n, len(lines))),
        1 - _share(len(set(lines)), len(lines)) if lines else 0.0, _share(sum(x[-1] in _SIGN_SET for x in words), w),
        _share(sum(map(str.isupper, words)), w), _share(int((lengths <= 2).sum()), w),
    ]


def _features(batches):
    for pdf in batches:
        rows = np.array([features(t) for t in pdf["body"]], dtype=np.float64).reshape(len(pdf), len(FEATURES))
        yield pd.DataFrame({"key": pdf["key"].to_numpy(), **{f: rows[:, i] for i, f in enumerate(FEATURES)}})


def featured(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """(key, features...) of every document."""
    body = plain(docs, doc_id, text)
    schema = f"key {body.schema['key'].dataType.simpleString()}, " + ", ".join(f"{f} double" for f in FEATURES)
    return body.mapInPandas(_features, schema)


def _three_leaves(g: np.ndarray, h: np.ndarray, least: float = 1.0) -> np.ndarray:
    """Step per bin of the best tree with up to two cuts on one axis, from summed gradients and curvatures."""

    def best_cut(a: int, b: int) -> tuple[float, int]:
        G, H = np.cumsum(g[a:b]), np.cumsum(h[a:b])
        gain = G[:-1] ** 2 / (H[:-1] + least) + (G[-1] - G[:-1]) ** 2 / (H[-1] - H[:-1] + least) - G[-1] ** 2 / (H[-1] + least)
        if not len(gain):
            return 0.0, -1
        i = int(gain.argmax())
        return float(gain[i]), a + i + 1

    cuts, ends = [], [(0, len(g))]
    for _ in range(2):
        gains = [(*best_cut(a, b), (a, b)) for a, b in ends]
        gain, cut, (a, b) = max(gains, key=lambda x: x[0])
        if gain <= 1e-9:
            break
        cuts.append(cut)
        ends.remove((a, b))
        ends += [(a, cut), (cut, b)]
    step = np.zeros(len(g))
    for a, b in ends:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + least)
    return step


def _four_leaves(g: np.ndarray, h: np.ndarray, least: float = 1.0) -> tuple[np.ndarray, float]:
    """The same for a table: one cut on the first axis, one on the second on either side; also its gain."""
    G, H = g.cumsum(axis=1), h.cumsum(axis=1)  # along the second axis
    Gi, Hi = np.vstack([np.zeros(g.shape[1]), G.cumsum(axis=0)]), np.vstack([np.zeros(g.shape[1]), H.cumsum(axis=0)])

    def halves(lo: np.ndarray, hlo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, htotal = lo[:, -1:], hlo[:, -1:]
        gain = lo**2 / (hlo + least) + (total - lo) ** 2 / (htotal - hlo + least)
        at = gain[:, :-1].argmax(axis=1)
        return gain[np.arange(len(gain)), at], at

    up, at_up = halves(Gi[1:-1], Hi[1:-1])
    down, at_down = halves(Gi[-1] - Gi[1:-1], Hi[-1] - Hi[1:-1])
    i = int((up + down).argmax())
    gain = float(up[i] + down[i] - Gi[-1, -1] ** 2 / (Hi[-1, -1] + least))
    step = np.zeros_like(g)
    for rows, cut in ((slice(0, i + 1), at_up[i] + 1), (slice(i + 1, None), at_down[i] + 1)):
        for cols in (slice(0, cut), slice(cut, None)):
            step[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + least)
    return step, gain


class Model:
    """Bin edges, a table per feature and per pair, and the base."""

    def __init__(self, base: float):
        self.base, self.edges, self.pair_edges, self.tables, self.pairs = base, [], [], [], []

    @staticmethod
    def binned(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.tables:
            for bins, t in zip(self.binned(x, self.edges), self.tables, strict=True):
                total += t[bins]
            coarse = self.binned(x, self.pair_edges)
            for i, j, t in self.pairs:
                total += t[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray) -> Model:
        rate = (y.sum() + 0.5) / (len(y) + 1)
        model = Model(float(np.log(rate / (1 - rate))))
        if not len(y) or y.min() == y.max():
            return model

        def quantiles(k: int) -> list[np.ndarray]:
            return [np.unique(np.quantile(c, np.linspace(0, 1, k + 1)[1:-1])) for c in x.T]

        model.edges, model.pair_edges = quantiles(BINS), quantiles(PAIR_BINS)
        fine, coarse = model.binned(x, model.edges), model.binned(x, model.pair_edges)
        model.tables = [np.zeros(len(e) + 1) for e in model.edges]
        total = np.full(len(y), model.base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-total))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for bins, t in zip(fine, model.tables, strict=True):
                g, h = slopes()
                step = RATE * _three_leaves(np.bincount(bins, g, len(t)), np.bincount(bins, h, len(t)))
                t += step
                total += step[bins]
        sizes = [len(e) + 1 for e in model.pair_edges]
        flat = {(i, j): coarse[i] * sizes[j] + coarse[j] for i, j in combinations(range(len(sizes)), 2) if min(sizes[i], sizes[j]) > 1}

        def sums(ij: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
            g, h = slopes()
            shape = sizes[ij[0]], sizes[ij[1]]
            return tuple(np.bincount(flat[ij], v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

        chosen = sorted(flat, key=lambda ij: -_four_leaves(*sums(ij))[1])[:PAIRS]
        tables = {ij: np.zeros((sizes[ij[0]], sizes[ij[1]])) for ij in chosen}
        for _ in range(PAIR_ROUNDS):
            for ij in chosen:
                step = RATE * _four_leaves(*sums(ij))[0]
                tables[ij] += step
                total += step.ravel()[flat[ij]]
        model.pairs = [(i, j, t) for (i, j), t in tables.items()]
        return model


def train(numbers: DataFrame, labels: DataFrame, doc_id="doc_id", label="quality", sample: int = SAMPLE) -> Model:
    """Fit to at most ``sample`` of the labelled rows, drawn in hash order."""
    labelled = labels.select(F.col(f"`{doc_id}`").alias("key"), F.col(f"`{label}`").cast("double").alias("label")).filter("label is not null")
    rows = numbers.join(labelled, "key")
    some = drawn(rows, F.xxhash64("key"), sample, "label", *FEATURES).select("label", *FEATURES).toPandas()
    return Model.fit(some[FEATURES].to_numpy(np.float64), some["label"].to_numpy(np.float64))


def _scorer(shared):
    def run(batches):
        model = shared.value
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "score": model.score(pdf[FEATURES].to_numpy(np.float64))})

    return run


def score(numbers: DataFrame, model: Model) -> DataFrame:
    """(key, score) of every row of ``featured``."""
    shared = numbers.sparkSession.sparkContext.broadcast(model)
    return numbers.mapInPandas(_scorer(shared), f"key {numbers.schema['key'].dataType.simpleString()}, score double")


def numbers_of(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """The features of all documents, written once: fitting and scoring read only these numbers."""
    return stage(featured(docs, doc_id, text), "features")


