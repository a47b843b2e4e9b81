"""Language identification by the nearest of several centroids per language.

A text's letters, lower-cased, become counts of hashed three-byte sequences, weighted by log counts and the inverse
document frequency over all learning documents, and scaled to length one. Each language has a few centroids, found by
spherical k-means over a bounded, documented sample of ``PER_LANGUAGE`` learning documents in hash order; a text gets
the language of the centroid with the largest cosine. A text whose cosine stays below the learned floor is too far
from every centroid and is rejected.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and rejected; equal cosines go to the
first language by name; documents without a language teach nothing; without any learning document all are ``und``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain, ship, slices

SLOTS = 8192
PER_LANGUAGE = 1500
CENTROIDS = 4
# A text is rejected below this share of the cosine that all but one in a thousand sampled documents reach.
FLOOR_SHARE = 0.2
UNKNOWN = "und"

# Signs, digits and spaces part words; a-z and all bytes beyond ASCII stay.
_KEPT = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LETTER = regex.compile(r"\p{L}")


def counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed three-byte sequences of each text, as float32 rows."""
    out = np.zeros((len(texts), SLOTS), np.float32)
    for row, text in zip(out, texts, strict=True):
        raw = b" ".join(text.lower().encode().translate(_KEPT).split())
        if raw:
            x = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
            code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
            row[:] = np.bincount((code * np.uint32(2654435761)) >> np.uint32(19), minlength=SLOTS)
    return out


def weighted(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = np.log1p(n) * idf
    return w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)


def blocks(texts: list[str], rows: int = 256):
    for a, b in slices(texts):
        for at in range(a, b, rows):
            yield at, min(b, at + rows)


def has_letter(text: str) -> bool:
    return LETTER.search(text) is not None


def _document_frequency(batches):
    seen, docs = np.zeros(SLOTS, np.int64), 0
    for pdf in batches:
        texts = pdf["body"].tolist()
        for a, b in blocks(texts):
            seen += (counts(texts[a:b]) > 0).sum(axis=0)
            docs += b - a
    if docs:
        yield pd.DataFrame({"slot": np.arange(SLOTS + 1), "n": np.append(seen, docs)})


def _vectors(idf: np.ndarray):
    def run(batches):
        for pdf in batches:
            texts = pdf["body"].tolist()
            for a, b in blocks(texts):
                w = weighted(counts(texts[a:b]), idf)
                at = [np.flatnonzero(r).astype(np.int32) for r in w]
                yield pd.DataFrame({
                    "lang": pdf["lang"].iloc[a:b].to_numpy(),
                    "at": [x.tobytes() for x in at],
                    "weight": [r[x].tobytes() for r, x in zip(w, at, strict=True)],
                })

    return run


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """Unit centroids; starts are drawn far from those already drawn."""
    rng = np.random.default_rng(seed)
    centres = [rows[rng.integers(len(rows))]]
    while len(centres) < min(k, len(rows)):
        far = 1 - (rows @ np.array(centres).T).max(axis=1)
        far = np.maximum(far, 0) ** 2
        if far.sum() <= 1e-9:
            break
        centres.append(rows[rng.choice(len(rows), p=far / far.sum())])
    centres = np.array(centres)
    for _ in range(rounds):
        near = (rows @ centres.T).argmax(axis=1)
        centres = np.array([rows[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float32)


class Model:
    def __init__(self, languages: list[str], centroids: np.ndarray, owner: np.ndarray, idf: np.ndarray, floor: float):
        self.languages, self.centroids, self.owner, self.idf, self.floor = languages, centroids, owner, idf, floor

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine of the nearest centroid, and whether the text is rejected."""
        known = np.array([has_letter(t) for t in texts], bool)
        if not len(self.centroids):
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = weighted(counts(texts), self.idf) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.where(known, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0.0).astype(float)
        named = [self.languages[self.owner[b]] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return named, score, ~known | (score < self.floor)


def train(docs: DataFrame, doc_id="doc_id", text="text", lang="lang", per_language=PER_LANGUAGE, centroids=CENTROIDS) -> Model:
    """Learn from all rows given that have a language: idf over all of them, centroids from the bounded sample."""
    body = docs.filter(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{doc_id}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"), F.col(f"`{lang}`").alias("lang")
    )
    frequency = body.select("body").mapInPandas(_document_frequency, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    seen = np.zeros(SLOTS + 1)
    for r in frequency.collect():
        seen[r.slot] = r.n
    idf = (np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1).astype(np.float32)
    sizes = {r["lang"]: r["count"] for r in body.groupBy("lang").count().collect()}
    # Draw each language's share by hash first, so that few more rows than needed are ranked.
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, 2 * per_language / n))]) if sizes else None
    rows: dict[str, list] = {}
    if sizes:
        drawn = F.xxhash64("key", "body")
        some = body.withColumn("draw", drawn).filter(F.pmod("draw", F.lit(1_000_003)) < share[F.col("lang")] * 1_000_003)
        ranked = some.withColumn("rank", F.expr("row_number() over (partition by lang order by draw)")).filter(F.col("rank") <= per_language)
        for r in ranked.mapInPandas(_vectors(idf), "lang string, at binary, weight binary").toLocalIterator():
            if len(r["at"]):
                rows.setdefault(r["lang"], []).append((np.frombuffer(r["at"], np.int32), np.frombuffer(r["weight"], np.float32)))
    names, found, owner, own_best = sorted(rows), [], [], []
    for i, name in enumerate(names):
        dense = np.zeros((len(rows[name]), SLOTS), np.float32)
        for d, (at, w) in zip(dense, rows[name], strict=True):
            d[at] = w
        c = spherical_kmeans(dense, centroids)
        found.append(c)
        owner += [i] * len(c)
        own_best.append((dense @ c.T).max(axis=1))
    if not names:
        return Model([], np.zeros((0, SLOTS), np.float32), np.zeros(0, int), idf, 0.0)
    floor = FLOOR_SHARE * float(np.quantile(np.concatenate(own_best), 0.001))
    return Model(names, np.concatenate(found), np.array(owner), idf, floor)


def _predictor(shared):
    def run(batches):
        model = shared.value
        for pdf in batches:
            texts = pdf["body"].tolist()
            for a, b in blocks(texts):
                named, score, rejected = model.predict(texts[a:b])
                yield pd.DataFrame({"key": pdf["key"].iloc[a:b], "lang_pred": named, "score": score, "rejected": rejected})

    return run


def predict(docs: DataFrame, model: Model, doc_id="doc_id", text="text") -> DataFrame:
    """Per document its id, ``lang_pred``, ``score`` (cosine) and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = plain(docs, doc_id, text)
    schema = f"key {body.schema['key'].dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    return body.mapInPandas(_predictor(shared), schema).withColumnRenamed("key", doc_id)


def keep_known(docs: DataFrame, model: Model, text="text") -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        known = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            kept = [~known.predict(texts[a:b])[2] for a, b in blocks(texts)]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)


assert math.log2(SLOTS) == 32 - 19  # the hash keeps that many bits
