"""Benchmark passages in documents, found by Wu-Manber multi-pattern search over words.

Words are runs of digits, a-z and everything beyond ASCII, after A-Z are lower-cased. Patterns are the windows of
``width`` consecutive words of every benchmark item; an item of fewer words is one shorter pattern. For each pattern
length a SHIFT table over blocks of two words says how far the search may jump; where it says 0, the bucket of the
block holds the candidate patterns and comparing all their words confirms an occurrence.

Defined cases: a null or empty text has no words and no hits; an item without words has no window; equal items all
count; items without an id mark words but are not listed; repeated document rows each get their result.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain, ship, slices

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WIDTH = 10
# Benchmark words searched for in one pass; more are searched in further blocks of items.
BLOCK_WORDS = 2_000_000


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


class Searcher:
    """Wu-Manber tables of one pattern length, over word numbers (0: a word that no pattern has)."""

    def __init__(self, length: int, patterns: dict[tuple[int, ...], set]):
        self.length, self.block = length, min(2, length)
        bits = max(10, math.ceil(math.log2(8 * length * len(patterns) + 1)))
        self.drop = np.uint64(64 - bits)
        self.far = min(255, length - self.block + 1)
        self.shift = np.full(1 << bits, self.far, np.uint8)
        self.buckets: dict[int, dict[bytes, set]] = {}
        rows = np.array(list(patterns), dtype=np.int32).reshape(len(patterns), length)
        hashed = self.hashes(rows)
        for at in range(hashed.shape[1]):
            np.minimum.at(self.shift, hashed[:, at], min(255, hashed.shape[1] - 1 - at))
        for row, end, items in zip(rows, hashed[:, -1], patterns.values(), strict=True):
            self.buckets.setdefault(int(end), {})[row.tobytes()] = items

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        x = ids.astype(np.uint64)
        with np.errstate(over="ignore"):
            x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            if self.block == 2:
                x = (x[..., :-1] ^ (x[..., :-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + x[..., 1:]
                x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return x >> self.drop

    def find(self, ids: np.ndarray):
        """(start, items) of every occurrence."""
        if len(ids) < self.length:
            return
        hashed, raw = self.hashes(ids), ids.tobytes()
        jumps, size, buckets = self.shift[hashed].tobytes(), 4 * self.length, self.buckets
        at, end, back = self.length - self.block, len(jumps), self.length - self.block
        while at < end:
            jump = jumps[at]
            if jump:
                at += jump
                continue
            start = at - back
            found = buckets.get(int(hashed[at]))
            if found is not None and (items := found.get(raw[4 * start : 4 * start + size])) is not None:
                yield start, items
            at += 1


class Patterns:
    """All windows of a bounded block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int = WIDTH):
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set]] = {}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text or "")]
            length = min(width, len(ids))
            if length:
                for i in range(len(ids) - length + 1):
                    found = by_length.setdefault(length, {}).setdefault(tuple(ids[i : i + length]), set())
                    if item is not None:
                        found.add(item)
        self.searchers = [Searcher(n, p) for n, p in sorted(by_length.items())]

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, the hit runs [start, end) of words, the items found."""
        get = self.numbers.get
        ids = np.array([get(w, 0) for w in words_of(text)], dtype=np.int32)
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for s in self.searchers:
            for start, found in s.find(ids):
                spans.append((start, start + s.length))
                items |= found
        merged: list[list[int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        return len(ids), [(a, b) for a, b in merged], sorted(items)


SCHEMA = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def _scanner(shared):
    def scan(batches):
        patterns = shared.value
        for pdf in batches:
            for a, b in slices(pdf["body"].tolist()):
                part = pdf.iloc[a:b]
                rows = [patterns.scan(t) for t in part["body"]]
                yield pd.DataFrame(
                    {
                        **{c: part[c] for c in pdf.columns if c != "body"},
                        "n_words": [r[0] for r in rows],
                        "spans": [[{"start": x, "end": y} for x, y in r[1]] for r in rows],
                        "items": [r[2] for r in rows],
                    }
                )

    return scan


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, width: int, block_words: int):
    """Broadcast patterns of one block of items after another; a word is taken to have five letters on average."""
    spark = benchmark.sparkSession
    bench = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("body"))
    total = bench.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(total / 5 / block_words))
    for b in range(blocks):
        part = bench.filter(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == b)
        yield spark.sparkContext.broadcast(Patterns([(r.item, r.body) for r in part.collect()], width))


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text="text", item_id="item_id", item_text="text", width: int = WIDTH, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows, with all their columns, whose text has no benchmark window: one pass, no shuffle, per block of items."""
    ship(docs.sparkSession)
    at = docs.columns.index(text)

    def clean(shared):
        def run(batches):
            patterns = shared.value
            for batch in batches:
                yield batch.filter(pa.array([not patterns.scan(t or "")[1] for t in batch.column(at).to_pylist()], pa.bool_()))

        return run

    for shared in _blocks(benchmark, item_id, item_text, width, block_words):
        docs = docs.mapInArrow(clean(shared), docs.schema)
    return docs


def occurrences(
    docs: DataFrame, benchmark: DataFrame, doc_id="doc_id", text="text", item_id="item_id", item_text="text",
    width: int = WIDTH, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: its id, ``n_words``, hit word runs ``spans`` [start, end) and the ``items`` found.

    Benchmark items are broadcast in blocks of about ``block_words`` words, so what a task holds is bounded whatever
    the benchmark's size; documents are scanned once per block and, with several blocks, merged per document.
    """
    body = plain(docs, doc_id, text)
    id_type = body.schema["key"].dataType.simpleString()
    blocks = list(_blocks(benchmark, item_id, item_text, width, block_words))

    if len(blocks) == 1:
        return body.mapInPandas(_scanner(blocks[0]), f"key {id_type}, {SCHEMA}").withColumnRenamed("key", doc_id)
    # Equal rows have equal results, so id and text digest are a key; repeated rows are counted and restored.
    marked = body.select("key", "body", F.sha2("body", 256).alias("digest"))
    scans = [marked.mapInPandas(_scanner(b), f"key {id_type}, digest string, {SCHEMA}") for b in blocks]
    found = reduce(DataFrame.union, scans)
    merged = found.groupBy("key", "digest").agg(
        (F.count("*") / len(blocks)).cast("int").alias("copies"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = F.expr("""aggregate(spans, cast(array() as array<struct<start:int,end:int>>), (done, s) ->
        if(size(done) > 0 and s.start <= element_at(done, -1).end,
           concat(slice(done, 1, size(done) - 1),
                  array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, s.end)))),
           concat(done, array(s))))""")
    return (
        merged.withColumn("spans", joined)
        .select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select(F.col("key").alias(doc_id), "n_words", "spans", "items")
    )
