"""Ranked lexical search: documents grouped by the mask of a query's terms that they hold.

One pass cuts every whole text into terms and keeps, per document, its length and the query terms in it with their
numbers; these rows are written once. Statistics (documents, lengths, documents per query term) are sums over them.
Then every task works batch by batch: a bitmap of documents per term, put together to a mask per document, groups the
documents of a query; a mask's best conceivable score is the sum of its terms' best parts in the batch. Masks are
evaluated from the highest such score down, until none can reach the k-th score found so far. Each task passes on k
rows per query, and a window per query ranks those.

Score of a document for a query: the sum over the query's terms, repeats included, of
``w * ((10^9 * tf) div (1000 * tf + 12 * m))`` in whole numbers, where ``w`` is ``floor(1000 * ln((2N + 2) / (2df + 1)))``
and ``m`` is ``100 - 25 + (25 * n * N) div L``.

Defined cases: null and empty texts hold no term, count nowhere and are never found; a query without terms finds
nothing; every row of the queries' table is a query of its own, also under a repeated or missing id; documents without
an id come after those with one among equal scores; repeated rows are ranked each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import plain, ship, slices, stage

TOP = 20
# Bytes of query text answered in one pass over the documents; more queries take more passes.
BLOCK_BYTES = 4_000_000
# Documents of the masks that are evaluated first; every further step takes twice as many.
FIRST = 128
# The length norm is 100 for a text of average length, a quarter of which its length decides.
FIXED, BY_LENGTH = 75, 25

# Letters A-Z become small, all other ASCII that is neither letter nor digit parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Queries:
    """A block of queries: their ids, and their distinct terms as numbers with how often each occurs."""

    def __init__(self, items: list[tuple[object, bytes]]):
        self.ids = [i for i, _ in items]
        self.numbers: dict[bytes, int] = {}
        self.terms, self.repeats = [], []
        for _, text in items:
            found = Counter(terms_of(text or b""))
            self.terms.append(np.array([self.numbers.setdefault(t, len(self.numbers) + 1) for t in found], np.int64))
            self.repeats.append(np.array(list(found.values()), np.int64))


def _postings(shared):
    def run(batches):
        number = shared.value.get
        for batch in batches:
            keys, bodies = batch.column(0), batch.column(1).to_pylist()
            for a, b in slices(bodies):
                lengths, terms, tfs, ends = [], [], [], [0]
                for text in bodies[a:b]:
                    words = terms_of(text)
                    held = Counter(filter(None, map(number, words)))
                    lengths.append(len(words))
                    terms += held.keys()
                    tfs += held.values()
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (terms, tfs)]
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), pa.array(lengths, pa.int64()), *lists], ["key", "n", "terms", "tfs"])

    return run


def postings(docs: DataFrame, numbers: dict[bytes, int], doc_id="doc_id", text="text") -> DataFrame:
    """(key, n, terms, tfs): per document with a term its length, and the numbered terms in it with their counts."""
    body = plain(docs, doc_id, text).select("key", F.col("body").cast("binary").alias("body"))
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    key = body.schema["key"].dataType.simpleString()
    return body.mapInArrow(_postings(shared), f"key {key}, n long, terms array<int>, tfs array<int>").filter("n > 0")


class Batch:
    """Postings of a batch of documents by term: where each term is, and what it adds to a score there."""

    def __init__(self, lengths: np.ndarray, terms: np.ndarray, tfs: np.ndarray, per_doc: np.ndarray, documents: int, total: int):
        norm = FIXED + (BY_LENGTH * lengths * documents) // total
        doc = np.repeat(np.arange(len(lengths)), per_doc)
        part = (1_000_000_000 * tfs) // (1000 * tfs + 12 * norm[doc])
        by_term = np.argsort(terms, kind="stable")
        self.size, self.doc, self.part = len(lengths), doc[by_term], part[by_term]
        names, starts = np.unique(terms[by_term], return_index=True)
        ends = np.r_[starts, len(terms)][1:]
        self.span = dict(zip(names.tolist(), zip(starts.tolist(), ends.tolist(), strict=True), strict=True))
        best = np.maximum.reduceat(self.part, starts) if len(names) else []
        self.best = dict(zip(names.tolist(), (int(x) for x in best), strict=True))

    def masks(self, terms: list[int]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Which documents hold any of the terms, and the groups of equal masks: (present terms per group, documents)."""
        bits = np.zeros((self.size, (len(terms) + 63) // 64), np.uint64)
        for j, t in enumerate(terms):
            a, b = self.span[t]
            bits[self.doc[a:b], j >> 6] |= np.uint64(1 << (j & 63))
        rows = np.flatnonzero(bits.any(axis=1))
        group = None
        for column in bits[rows].T:  # 64 terms at a time
            _, word = np.unique(column, return_inverse=True)
            group = word if group is None else np.unique(group * (word.max() + 1) + word, return_inverse=True)[1]
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(group[order]) > 0])
        members = np.split(rows[order], starts[1:])
        masks = bits[rows[order][starts]]
        held = [(masks[:, j >> 6] >> np.uint64(j & 63)) & np.uint64(1) for j in range(len(terms))]
        return np.stack(held, axis=1).astype(bool), members

    def scores(self, chosen: np.ndarray, terms: list[int], weights: np.ndarray) -> np.ndarray:
        total = np.zeros(len(chosen), np.int64)
        for t, w in zip(terms, weights.tolist(), strict=True):
            a, b = self.span[t]
            holders = self.doc[a:b]
            at = np.minimum(np.searchsorted(holders, chosen), len(holders) - 1)
            total += np.where(holders[at] == chosen, w * self.part[a:b][at], 0)
        return total

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int):
        """Documents and scores of at least ``floor`` that may be among the first ``k``, masks in falling order of promise."""
        there = [j for j, t in enumerate(terms.tolist()) if t in self.span and weights[j] > 0]
        terms, weights = [int(terms[j]) for j in there], weights[there]
        if not terms:
            return
        present, members = self.masks(terms)
        promise = present @ (weights * np.array([self.best[t] for t in terms], np.int64))
        order = np.argsort(-promise, kind="stable")
        sizes = np.cumsum([len(members[g]) for g in order])
        top, at, step = np.zeros(0, np.int64), 0, FIRST
        while at < len(order) and promise[order[at]] >= floor:
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + step)))
            # Masks of this step that cannot reach the floor are left out, as are all after them.
            end = at + int(np.searchsorted(-promise[order[at:end]], -floor, side="right"))
            chosen = np.sort(np.concatenate([members[g] for g in order[at:end]]))
            scores = self.scores(chosen, terms, weights)
            good = scores >= floor
            yield chosen[good], scores[good]
            top = np.sort(np.r_[top, scores])[-k:]
            if len(top) == k:
                floor = max(floor, int(top[0]))
            at, step = end, 2 * step


def _flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64)


def _searcher(shared, k: int):
    def run(batches):
        ids, terms, weights, documents, total = shared.value
        # Per query its best so far: (falling score, no id, id).
        best: list[list[tuple]] = [[] for _ in ids]
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_pylist()
            per_doc = np.diff(batch.column("terms").offsets.to_numpy())
            found = Batch(batch.column("n").to_numpy(), _flat(batch.column("terms")), _flat(batch.column("tfs")), per_doc, documents, total)
            for q, mine in enumerate(best):
                floor = max(1, -mine[-1][0]) if len(mine) == k else 1
                for rows, scores in found.search(terms[q], weights[q], k, floor):
                    mine += [(-s, keys[r] is None, keys[r]) for r, s in zip(rows.tolist(), scores.tolist(), strict=True)]
                mine.sort(key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))
                del mine[k:]
        queries = [q for q, mine in enumerate(best) for _ in mine]
        flat = [x for mine in best for x in mine]
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries, pa.int32()), pa.array([x[2] for x in flat], shared.key_type), pa.array([-x[0] for x in flat], pa.int64())],
            ["query", "key", "score"],
        )

    return run


class _Shared:
    """A broadcast with the documents' id type beside it."""

    def __init__(self, sent, key_type: pa.DataType):
        self.sent, self.key_type = sent, key_type

    @property
    def value(self):
        return self.sent.value


def _blocks(queries: DataFrame, item_id: str, item_text: str, block_bytes: int):
    rows = queries.select(F.col(f"`{item_id}`").alias("item"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).cast("binary").alias("body"))
    held = rows.agg(F.sum(F.length("body") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(held / block_bytes))
    for b in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == b).collect() if held else []
        if part:
            yield Queries([(r.item, bytes(r.body)) for r in part])


def search(
    docs: DataFrame, queries: DataFrame, k: int = TOP, doc_id="doc_id", text="text", item_id="item_id", item_text="text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` highest-scoring documents of every query: item id, ``rank`` from 1, document id, ``score``.

    Equal scores are ranked by ascending document id. Queries go to the executors in blocks of about ``block_bytes``
    bytes; each block takes one pass over the documents.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    ship(spark)
    item_type, key_type = queries.schema[item_id].dataType, docs.schema[doc_id].dataType
    schema = f"item {item_type.simpleString()}, query int, key {key_type.simpleString()}, score long"
    results = []
    for block in _blocks(queries, item_id, item_text, block_bytes):
        held = stage(postings(docs, block.numbers, doc_id, text), "postings")
        documents, total = held.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        holding = dict(held.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weight_of = np.array([0] + [weight(documents, holding.get(t, 0)) for t in range(1, len(block.numbers) + 1)], np.int64)
        weights = [weight_of[t] * r for t, r in zip(block.terms, block.repeats, strict=True)]
        sent = spark.sparkContext.broadcast((block.ids, block.terms, weights, documents, total))
        found = held.mapInArrow(_searcher(_Shared(sent, to_arrow_type(key_type)), k), f"query int, key {key_type.simpleString()}, score long")
        ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))))
        names = spark.createDataFrame(list(enumerate(block.ids)), f"query int, item {item_type.simpleString()}")
        # Names of one block, bounded like the block itself.
        results.append(ranked.filter(F.col("rank") <= k).join(F.broadcast(names), "query"))
    if not results:
        out = spark.createDataFrame([], schema).withColumn("rank", F.lit(1))
    else:
        out = results[0]
        for more in results[1:]:
            out = out.unionByName(more)
    return out.select(F.col("item").alias(item_id), "rank", F.col("key").alias(doc_id), "score")
