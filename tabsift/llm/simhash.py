"""Near-duplicates by SimHash, exact pairs within a Hamming distance found by bands of bits and vantage-point trees.

A fingerprint takes the majority, bit by bit, of the 64-bit hashes of a text's word shingles. The bits are dealt to one
band more than the distance, so that two fingerprints within it agree on a whole band: each distinct fingerprint goes to
one shard per band, by the band's bits, and work grows with the rows. A shard beyond its size is cut into blocks that
meet pair by pair, so that no task grows with the table. Fingerprints of one band value find their links with a
vantage-point tree: a node parts points by their distance to its vantage point at a median, and by the triangle
inequality only points within ``distance`` of the border look on both sides. Each task passes on one edge per member of
a linked group, not all pairs. Groups that tasks share are joined by repeated minimum labels.

Defined cases: null and empty texts have no words and the fingerprint zero, linked like any other; texts of fewer
words than a shingle are one shingle; equal fingerprints are one node; documents without an id get no say in the
smallest id, and a group of only such has a null component; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drawn, plain, stage

SHINGLE = 4
DISTANCE = 4
SEED = 42  # of the shingle hash; part of the fingerprint's definition
# The sample that tells which bits part the fingerprints evenly, and how many of them a shard should hold.
SAMPLE = 16_384
SHARD = 65_536
# Rows that a task deals out at a time, and the odd factor whose product's upper bits number the blocks.
DEALT_ROWS = 200_000
SPREAD = np.uint64(0x9E3779B97F4A7C15)
LEAF = 192  # points compared with one another without a further split


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    digest = xxhash.xxh64_digest  # big-endian bytes
    raw = b"".join([digest(whole[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)])
    hashes = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255):  # counts of up to 255 rows fit a byte, so the sums stay narrow
        ones += np.add.reduce(np.unpackbits(hashes[at : at + 255], axis=1), axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:  # the id passes as it is: in pandas, whole numbers beside a missing one become doubles
            prints = np.array([fingerprint(t, shingle) for t in batch.column("body").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(prints)], ["key", "fp"])

    return run


def fingerprints(docs: DataFrame, doc_id="doc_id", text="text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): the document's id and its fingerprint as a signed long."""
    body = plain(docs, doc_id, text)
    return body.mapInArrow(_fingerprints(shingle), f"key {body.schema['key'].dataType.simpleString()}, fp long")


def distances(point, points: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(point))


class Bands:
    """The 64 bits dealt to ``distance`` + 1 bands, and every band's values to a power of two of shards."""

    def __init__(self, sample: np.ndarray, distance: int, shards: int):
        ones = np.array([np.count_nonzero(sample >> np.uint64(b) & np.uint64(1)) for b in range(64)])
        # Bits that the sample is parted by unevenly are shared out, so that no band is left with few values.
        order = np.argsort(np.abs(2 * ones - len(sample)), kind="stable")
        self.bands = [order[i :: distance + 1].tolist() for i in range(distance + 1)]
        self.low = min(math.ceil(math.log2(max(1, shards))), min(map(len, self.bands)))
        self.shards = len(self.bands) << self.low

    def values(self, points: np.ndarray, band: int) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        for j, bit in enumerate(self.bands[band]):
            out |= (points >> np.uint64(bit) & np.uint64(1)).astype(np.int64) << j
        return out

    def deal(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (place in ``points``, shard): one per band."""
        last = (1 << self.low) - 1
        shards = [(band << self.low) + (self.values(points, band) & last) for band in range(len(self.bands))]
        return np.tile(np.arange(len(points)), len(shards)), np.concatenate(shards)


class Groups:
    """Union of places, roots by path halving."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def shard_links(points: np.ndarray, home: np.ndarray, distance: int, among: bool = True, seed: int = 1) -> np.ndarray:
    """The group of each point of a shard: places linked through pairs of which one is at home.

    A tree over the points at home, walked node by node with all points that may touch it, prunes by the triangle
    bound. Without ``among``, only visitors look for partners.
    """
    groups, rng = Groups(len(points)), np.random.default_rng(seed)
    # A node: the points to be found (at home) and all that look for them (at home or visiting).
    todo = [(np.flatnonzero(home), np.arange(len(points)) if among else np.flatnonzero(~home))]
    while todo:
        held, looking = todo.pop()
        if not len(held) or not len(looking):
            continue
        if len(held) <= LEAF:
            for at in range(0, len(looking), 4096):
                some = looking[at : at + 4096]
                a, b = np.nonzero(np.bitwise_count(points[held][:, None] ^ points[some][None, :]) <= distance)
                for i, j in zip(held[a].tolist(), some[b].tolist(), strict=True):
                    if i != j:
                        groups.join(i, j)
            continue
        candidates = points[rng.choice(held, 6)]
        from_each = [distances(c, points[held]) for c in candidates]
        best = max(range(len(candidates)), key=lambda i: from_each[i].std())
        far = from_each[best].astype(np.int64)
        border = int(np.sort(far)[(len(far) - 1) // 2])
        if border >= far.max():
            border = int(far.min())
        if border >= far.max():  # all at one distance from every candidate: part them by halves, looking in both
            half = len(held) // 2
            todo += [(held[:half], looking), (held[half:], looking)]
            continue
        seen = distances(candidates[best], points[looking]).astype(np.int64)
        todo.append((held[far <= border], looking[seen <= border + distance]))
        todo.append((held[far > border], looking[seen > border - distance]))
    return np.array([groups.root(i) for i in range(len(points))], np.int64)


def block_pairs(points: np.ndarray, shard: np.ndarray, home: np.ndarray, at_home: np.ndarray, visiting: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows (place in ``points``, shard, block, part, at home) that deal a shard's points to tasks of bounded size.

    A shard has ``at_home`` blocks of points and ``visiting`` ones of visitors, both by a hash. Part p below
    ``visiting`` of a block holds its points and visitors p, and part 0 links the block's points among themselves too;
    part ``visiting + b`` holds the points of two blocks, those of block b as visitors.
    """
    number = ((points * SPREAD) >> np.uint64(32)).astype(np.int64)
    blocks, parts = at_home[shard], visiting[shard]
    times = np.where(home, parts + blocks - 1, blocks)
    row = np.repeat(np.arange(len(points)), times)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    number, blocks, parts, home, shard = number[row], blocks[row], parts[row], home[row], shard[row]
    own = number % blocks
    partner = turn - parts + (turn - parts >= own)  # of a point at home, beyond the parts with visitors
    meets = home & (turn >= parts)
    low, high = np.minimum(own, partner), np.maximum(own, partner)
    block = np.where(meets, low, np.where(home, own, turn))
    part = np.where(meets, parts + high, np.where(home, turn, number % parts))
    return row, shard, block, part, home & (~meets | (own < partner))


def _counter(shared):
    """How many points a task deals to every shard."""

    def run(batches):
        counts = np.zeros(shared.value.shards, np.int64)
        for pdf in batches:
            _, shard = shared.value.deal(pdf["fp"].to_numpy(np.int64).view(np.uint64))
            counts += np.bincount(shard, minlength=len(counts))
        yield pd.DataFrame({"shard": np.arange(len(counts)), "n": counts})

    return run


def _dealer(shared, blocks):
    def run(batches):
        bands, at_home = shared.value, blocks.value
        step, alone = max(1, DEALT_ROWS // int(at_home.max(initial=1))), np.ones(len(at_home), np.int64)
        for pdf in batches:
            points = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            rows, shard = bands.deal(points)
            for at in range(0, len(rows), step):
                some = points[rows[at : at + step]]
                row, *keys, held = block_pairs(some, shard[at : at + step], np.ones(len(some), bool), at_home, alone)
                yield pd.DataFrame({"fp": some[row].view(np.int64), **dict(zip(("shard", "block", "part"), keys, strict=True)), "home": held})

    return run


def _linker(shared, distance: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bands = shared.value
        values = bands.values(pdf["fp"].to_numpy(np.int64).view(np.uint64), key[0] >> bands.low)
        order = np.argsort(values, kind="stable")
        values, points, home = values[order], pdf["fp"].to_numpy(np.int64)[order], pdf["home"].to_numpy(bool)[order]
        root = np.arange(len(points))
        ends = np.append(np.flatnonzero(np.diff(values)) + 1, len(points))
        for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
            if b - a > 1:
                root[a:b] = a + shard_links(points[a:b].view(np.uint64), home[a:b], distance, among=key[2] == 0)
        linked = root != np.arange(len(points))
        return pd.DataFrame({"fp": points[linked], "to": points[root[linked]]})

    return run


def _bands(prints: DataFrame, distance: int, sample: int, shard: int):
    some = drawn(prints, F.xxhash64("fp"), sample).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    return prints.sparkSession.sparkContext.broadcast(Bands(some, distance, math.ceil(prints.count() / shard)))


def _tasks(prints: DataFrame, shared, shard: int) -> DataFrame:
    counted = prints.select("fp").mapInPandas(_counter(shared), "shard long, n long")
    sizes = counted.groupBy("shard").agg(F.sum("n").alias("n")).toPandas()
    at_home = np.ones(shared.value.shards, np.int64)
    at_home[sizes["shard"]] = np.maximum(1, -(-sizes["n"].to_numpy() // shard))
    blocks = prints.sparkSession.sparkContext.broadcast(at_home)
    return prints.select("fp").mapInPandas(_dealer(shared, blocks), "fp long, shard long, block long, part long, home boolean")


def dealt(prints: DataFrame, distance: int = DISTANCE, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """(fp, shard, block, part, home): the distinct fingerprints, once per band, in tasks of about ``shard`` points.

    A bounded sample tells which bits to share out. However many points a shard gets, they are cut into blocks of that
    size which meet pair by pair.
    """
    return _tasks(prints, _bands(prints, distance, sample, shard), shard)


def links(prints: DataFrame, distance: int = DISTANCE, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """Edges (fp, to) that connect distinct fingerprints exactly as all pairs within ``distance`` would."""
    shared = _bands(prints, distance, sample, shard)
    tasks = _tasks(prints, shared, shard).groupBy("shard", "block", "part")
    return tasks.applyInPandas(_linker(shared, distance), "fp long, to long")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(fp, label): the smallest fingerprint of each linked one's component, by minimum labels and pointer jumps."""
    both = stage(edges.union(edges.select("to", "fp")).toDF("a", "b").distinct(), "links")
    label = stage(both.groupBy(F.col("a").alias("fp")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        seen = both.join(label, both.b == label.fp).groupBy("a").agg(F.min("label").alias("other"))
        own = label.join(seen, label.fp == seen.a).select("fp", F.col("label").alias("was"), F.least("label", "other").alias("label"))
        jump = label.select(F.col("fp").alias("via"), F.col("label").alias("next"))
        new = own.join(jump, own.label == jump.via).select("fp", "was", F.least("label", "next").alias("label"))
        staged = stage(new, "labels")
        if not staged.filter("was <> label").limit(1).count():
            return staged.select("fp", "label")
        label = staged.select("fp", "label")


def near_duplicates(docs: DataFrame, doc_id="doc_id", text="text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per document its id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id linked to it."""
    spark = docs.sparkSession
    prints = stage(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    least = stage(prints.groupBy("fp").agg(F.min("key").alias("least")), "distinct-fingerprints")
    label = components(spark, links(least.select("fp"), distance))
    grouped = least.join(label, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    smallest = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    of_print = grouped.join(smallest, "label").select("fp", "component_id")
    return prints.join(of_print, "fp").select(F.col("key").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
