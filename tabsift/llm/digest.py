"""Document fingerprints of improbable byte windows, kept in chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy level; how often each level occurs in the whole corpus ranks windows
by rarity. In each run of ``RUN`` neighbouring windows the rarest (then the leftmost) gains a point, and windows with
``POPULAR`` points are features. Features enter a chain of Bloom filters in text order, ``CAPACITY`` to a filter. Two
fingerprints are compared filter by filter: the common bits beyond those that chance explains, as a share of what
would be possible, each filter of the shorter chain with its best partner in the other.

Defined cases: a null or empty text has the empty fingerprint; a text shorter than a window is one feature; a text
whose windows all have little entropy has the rarest, then leftmost, of them; equal texts have equal fingerprints, equal
fingerprints likeness 1; an empty one is unlike every other (0). Ids are whole numbers; documents without one come
first, equal ids are ordered by text. The only document is its own successor.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import plain

WINDOW, RUN, POPULAR = 16, 24, 6
LEVELS = 512
LOWEST = LEVELS // 8  # windows of less entropy than this say too little to be features
FILTER_BITS, HASHES, CAPACITY = 2048, 5, 160
CHANCE = 0.2  # share of the possible overlap beyond the expected one that still counts as chance

_LOGS = np.array([0, *[round(c * np.log2(c) * (1 << 16)) for c in range(1, WINDOW + 1)]], np.int64)
_MOST = int(_LOGS[WINDOW])


def levels(raw: np.ndarray) -> np.ndarray:
    """The entropy level of every window, from 0 (one byte repeated) to LEVELS - 1 (all bytes differ)."""
    n = len(raw) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int16)
    ahead, behind = np.ones(len(raw), np.uint8), np.zeros(len(raw), np.uint8)
    for lag in range(1, WINDOW):
        same = raw[lag:] == raw[:-lag]
        ahead[:-lag] += same
        behind[lag:] += same
    # Moving on by one byte takes its first byte out and puts the next one in: two terms of the sum change.
    gone, come = ahead[: n - 1], behind[WINDOW:]
    first = int(_LOGS[np.bincount(raw[:WINDOW])].sum())
    sums = np.empty(n, np.int64)
    sums[0] = first
    sums[1:] = first + np.cumsum(_LOGS[gone - 1] - _LOGS[gone] + _LOGS[come + 1] - _LOGS[come])
    return ((_MOST - sums) * (LEVELS - 1) // _MOST).astype(np.int16)


def chosen(level: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Places of the windows that are rarest among their neighbours often enough, in text order."""
    m = len(level)
    key = np.full(m + 2 * (RUN - 1), np.iinfo(np.int64).max)
    key[RUN - 1 : RUN - 1 + m] = (rank[level].astype(np.int64) << 40) | np.arange(m)
    span = 1
    while span < RUN:  # the least of RUN neighbours, by doubling
        step = min(span, RUN - span)
        key = np.minimum(key[:-step], key[step:])
        span += step
    points = np.bincount(key & ((1 << 40) - 1), minlength=m)
    return np.flatnonzero((points >= POPULAR) & (level >= LOWEST))


def hashed(raw: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64 mixed bits of the windows at ``places``."""
    if len(raw) < WINDOW:
        return np.frombuffer(hashlib.blake2b(raw.tobytes(), digest_size=8).digest(), np.uint64)
    words = np.ascontiguousarray(sliding_window_view(raw, WINDOW)[places]).view(np.uint64)
    h = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(words.shape[1]):
            h = (h ^ words[:, i]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


def filters(features: np.ndarray) -> np.ndarray:
    """Chained Bloom filters (rows of bytes) of the distinct features, in order of first appearance."""
    _, first = np.unique(features, return_index=True)
    distinct = features[np.sort(first)]
    if not len(distinct):
        return np.zeros((0, FILTER_BITS // 8), np.uint8)
    bits = np.zeros((-(-len(distinct) // CAPACITY), FILTER_BITS), np.uint8)
    chain = np.arange(len(distinct)) // CAPACITY
    for i in range(HASHES):  # eleven bits of the hash for each place in the filter
        bits[chain, (distinct >> np.uint64(11 * i)) & np.uint64(FILTER_BITS - 1)] = 1
    return np.packbits(bits, axis=1)


def text_of(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def chain_of(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, FILTER_BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: how far the filters of two chains share more bits than chance would set."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if (len(b), b.tobytes()) < (len(a), a.tobytes()):
        a, b = b, a
    wide_a, wide_b = a.view(np.uint64), b.view(np.uint64)
    set_a, set_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (wide_a, wide_b))
    total = 0.0
    for row, held in zip(wide_a, set_a.tolist(), strict=True):
        common = np.bitwise_count(wide_b & row).sum(axis=1, dtype=np.int64)
        most = np.minimum(held, set_b)
        expected = held * set_b / FILTER_BITS
        floor = expected + CHANCE * (most - expected)
        total += held * float(np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1).max())
    return total / float(set_a.sum())


class Text:
    """A text with its bytes and levels; parts of it lend their levels to texts put together from them."""

    def __init__(self, text: str, level: np.ndarray | None = None):
        self.text, self.raw = text, np.frombuffer(text.encode(), np.uint8)
        self.level = levels(self.raw) if level is None else level

    def chain(self, rank: np.ndarray) -> np.ndarray:
        if not len(self.raw):
            return filters(np.zeros(0, np.uint64))
        places = chosen(self.level, rank) if len(self.level) else np.zeros(1, np.int64)
        if not len(places):  # nothing but windows of little entropy: the rarest of them
            places = np.array([int(rank[self.level].argmin())])
        return filters(hashed(self.raw, places))

    def edited(self, other: Text) -> Text:
        """Its last half, in code points, replaced by the first as many (or all) of another text."""
        half = len(self.text) // 2
        kept, put = self.text[: len(self.text) - half], other.text[:half]
        a, b = len(kept.encode()), len(put.encode())
        text = kept + put
        if a < WINDOW or b < WINDOW:
            return Text(text)
        seam = np.frombuffer(text.encode(), np.uint8)[a - WINDOW + 1 : a + WINDOW - 1]
        return Text(text, np.concatenate([self.level[: a - WINDOW + 1], levels(seam), other.level[: b - WINDOW + 1]]))


def _histogram(batches):
    seen = np.zeros(LEVELS, np.int64)
    for pdf in batches:
        for text in pdf["body"]:
            seen += np.bincount(levels(np.frombuffer(text.encode(), np.uint8)), minlength=LEVELS)
    if seen.any():
        yield pd.DataFrame({"level": np.arange(LEVELS), "n": seen})


def rarity(docs: DataFrame, doc_id="doc_id", text="text") -> np.ndarray:
    """Rank of every entropy level, rarest first, counted over all windows of all texts."""
    counted = plain(docs, doc_id, text).select("body").mapInPandas(_histogram, "level int, n long")
    seen = np.zeros(LEVELS, np.int64)
    for r in counted.groupBy("level").agg(F.sum("n").alias("n")).collect():
        seen[r.level] = r.n
    rank = np.empty(LEVELS, np.int64)
    rank[np.lexsort((np.arange(LEVELS), seen))] = np.arange(LEVELS)
    return rank


def _fingerprinter(rank: np.ndarray):
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "fingerprint": [text_of(Text(t).chain(rank)) for t in pdf["body"]]})

    return run


def fingerprints(docs: DataFrame, rank: np.ndarray, doc_id="doc_id", text="text") -> DataFrame:
    """Per document its id and ``fingerprint``."""
    body = plain(docs, doc_id, text)
    schema = f"key {body.schema['key'].dataType.simpleString()}, fingerprint string"
    return body.mapInPandas(_fingerprinter(rank), schema).withColumnRenamed("key", doc_id)


def with_successors(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """(bucket, guest, at, key, body) sorted so that each document is followed by the next one.

    Documents are dealt into buckets at quantiles of the id; each bucket is followed by a guest, the first document of
    the next bucket that has any (after the last: of the first). Texts are shuffled once, and no order of all rows in
    one task is asked for.
    """
    spark = docs.sparkSession
    body = plain(docs, doc_id, text).withColumn("at", F.coalesce(F.col("key").cast("long"), F.lit(-(2**63))))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = body.agg(F.percentile_approx("at", [i / buckets for i in range(1, buckets)], 20 * buckets).alias("q")).first().q
    bounds = np.unique(np.array(ids or [], np.int64))

    @F.pandas_udf(T.IntegerType())
    def bucket(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, at.to_numpy(np.int64), side="left").astype(np.int32))

    dealt = body.select(bucket("at").alias("bucket"), F.lit(False).alias("guest"), "at", F.xxhash64("body").alias("tie"), "key", "body")
    firsts = {r.bucket: r.least for r in body.select(bucket("at").alias("bucket"), "at").groupBy("bucket").agg(F.min("at").alias("least")).collect()}
    held = sorted(firsts)  # at most as many as there are buckets
    before = dict(zip(held, [held[-1], *held[:-1]], strict=True)) if held else {0: 0}
    first = dealt.filter(F.col("at").isin(list(firsts.values()))).withColumn("place", F.expr("row_number() over (partition by bucket order by at, tie, body)"))
    guest = first.filter("place = 1").select(
        F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("bucket")].alias("bucket"), F.lit(True).alias("guest"), "at", "tie", "key", "body"
    )
    return dealt.union(guest).repartition("bucket").sortWithinPartitions("bucket", "guest", "at", "tie", "body")


def _comparer(rank: np.ndarray):
    def run(batches):
        last = None  # the row before: (bucket, guest, key, Text, chain)
        for pdf in batches:
            rows = []
            for bucket, guest, key, body in zip(pdf["bucket"], pdf["guest"], pdf["key"], pdf["body"], strict=True):
                text = Text(body)
                chain = text.chain(rank)
                if last is not None and not last[1]:
                    edited = last[3].edited(text)
                    other = edited.chain(rank)
                    rows.append((
                        last[2], len(last[3].text), hashlib.sha256(edited.raw.tobytes()).hexdigest(),
                        text_of(last[4]), text_of(other), likeness(last[4], other), likeness(last[4], chain),
                    ))
                last = (bucket, guest, key, text, chain)
            if rows:
                yield pd.DataFrame(rows, columns=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return run


def compared(docs: DataFrame, rank: np.ndarray, doc_id="doc_id", text="text") -> DataFrame:
    """Per document its fingerprint, that of its edited text, and its likeness to both that and the next document."""
    rows = with_successors(docs, doc_id, text).select("bucket", "guest", "key", "body")
    schema = f"key {rows.schema['key'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInPandas(_comparer(rank), schema).withColumnRenamed("key", doc_id)
