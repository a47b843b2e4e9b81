"""Texts whose sets of word shingles are alike by Jaccard, found through R-trees over count vectors.

A text's set are the 64-bit hashes of its distinct shingles. Hashed into ``GROUPS`` groups, they give a point of group
counts, and the sum of the coordinates' minima bounds the overlap of two sets from above. Equal sets are one node. The
nodes are dealt to shards by a rule that loses no pair: two sets alike by ``percent`` differ in at most ``D`` shingles,
``D`` following from their size, so of ``D + 1`` classes of hashes one at least has the same shingles in both; a set
has a signature per class, for its own band of sizes and for the next smaller one.

Among nodes that share a signature, links are found in two ways. Two rounds compare every node with one pivot per
signature, which joins the bulk of any large group of copies in linear work. What is left are signatures that still hold
several components: those of one smallest component are taken together where they fit, and their nodes go to shards,
each with an R-tree over the points at home, laid out by size and widest coordinate; a node of the tree is left aside
if the minima with its largest counts cannot reach the overlap wanted. Only pairs of different components come out. All
pairs found either way are verified on whole shingle sets. A signature with many nodes is split: chunks of points at
home, met by blocks of those outside its largest component.

Defined cases: null, empty and blank texts have an empty set, are linked with nothing and are their own component;
texts of fewer words than a shingle are one shingle; documents without an id get no say in the smallest id, and a
component of only such has a null id; an empty table gives an empty result. Sets are compared by their 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import plain, slices, stage
from .simhash import components

SHINGLE = 3
PERCENT = 90
GROUPS = 64  # coordinates of a point
SHARD = 2_048  # points at home in a shard, and visitors of a block
LEAF = 32  # points of a tree's leaf
ROUNDS = 2  # of comparisons with pivots
COUNT = np.dtype("<i4")


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    of_word = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    found = np.full(len(words) - width + 1, width, np.uint64)
    for j in range(width):
        found = mixed(found + of_word[j : len(words) - width + 1 + j] + np.uint64(0x9E3779B97F4A7C15))
    return np.unique(found)


def bands(percent: int, largest: int) -> list[int]:
    """The smallest size of each band; a set and one alike lie in the same band or in neighbouring ones."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(100 * edges[-1] // percent + 1)
    return edges


def signatures(found: np.ndarray, percent: int, edges: list[int]) -> np.ndarray:
    """A number per class of hashes, equal in two sets whose class is: for the set's own band and the one below."""
    if not len(found):
        return np.zeros(0, np.uint64)
    own = int(np.searchsorted(edges, len(found), side="right")) - 1
    sums, out = np.r_[np.uint64(0), np.cumsum(found)], []
    for band in (own - 1, own):
        # Sets of at most edges[band + 1] - 1 shingles, and larger ones alike, differ in at most so many.
        classes = (edges[band + 1] - 1) * (100 - percent) // percent + 1 if band >= 0 else 1
        if classes == 1:  # only equal sets, which are one node
            continue
        of = (found >> np.uint64(32)) * np.uint64(classes) >> np.uint64(32)
        cuts = np.searchsorted(of, np.arange(classes + 1, dtype=np.uint64))
        name = mixed(np.uint64(band << 32) + np.arange(classes, dtype=np.uint64))
        out.append(mixed(name + sums[cuts[1:]] - sums[cuts[:-1]]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def point(found: np.ndarray) -> bytes:
    return np.bincount((found & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS).astype(COUNT).tobytes()


def digest(found: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    if not len(found):
        return 0, 0
    pair = np.array([np.add.reduce(found), np.add.reduce(mixed(found ^ np.uint64(0xD6E8FEB86659FD93)))], np.uint64)
    return tuple(pair.view(np.int64).tolist())


def _pointer(width: int, percent: int):
    def run(batches):
        edges = bands(percent, 1)
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            for a, b in slices(bodies):
                sets = [shingles(t, width) for t in bodies[a:b]]
                most = max(map(len, sets))
                if most >= edges[-1]:
                    edges = bands(percent, 2 * most)
                marks = [signatures(s, percent, edges) for s in sets]
                ends = pa.array(np.r_[0, np.cumsum([len(m) for m in marks])], pa.int32())
                names = [digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([x for x, _ in names], pa.int64()),
                        pa.array([y for _, y in names], pa.int64()),
                        pa.array([point(s) for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(marks).view(np.int64))),
                    ],
                    ["key", "n", "a", "b", "counts", "marks"],
                )

    return run


def _hasher(width: int):
    def run(batches):
        for batch in batches:
            bodies = batch.column(0).to_pylist()
            for a, b in slices(bodies):
                sets = [shingles(t, width) for t in bodies[a:b]]
                names = [digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in names], pa.int64()), pa.array([y for _, y in names], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["a", "b", "hashes"],
                )

    return run


def enough(overlap, sizes, percent: int):
    """Is ``overlap`` the share ``percent`` of the union of two sets, given the sum of their sizes?"""
    return overlap * (100 + percent) >= percent * sizes


def _points(column: pa.Array | pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist() if isinstance(column, pa.Array) else column), COUNT).reshape(-1, GROUPS)


def _bounded(percent: int):
    def run(batches):
        for batch in batches:
            overlap = np.minimum(_points(batch.column("cx")), _points(batch.column("cy"))).sum(axis=1)
            sizes = batch.column("nx").to_numpy() + batch.column("ny").to_numpy()
            yield batch.select(["x", "y"]).filter(pa.array(enough(overlap, sizes, percent)))

    return run


def _exact(percent: int):
    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("hx"), batch.column("hy"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                good.append(enough(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y), percent))
            yield batch.select(["x", "y"]).filter(pa.array(good, pa.bool_()))

    return run


class Tree:
    """An R-tree over points of counts, laid out at once: by size first, then by the coordinate that spreads most.

    A node keeps the largest count per coordinate and the span of sizes; a leaf keeps its points.
    """

    def __init__(self, points: np.ndarray, rows: np.ndarray | None = None):
        rows = np.arange(len(points)) if rows is None else rows
        here, sizes = points[rows], points[rows].sum(axis=1)
        self.most, self.low, self.high = here.max(axis=0), int(sizes.min()), int(sizes.max())
        self.rows, self.children = rows, []
        if len(rows) > LEAF:
            # Sizes part the points until a node's largest is hardly larger than its smallest.
            by = sizes if self.high > 1.05 * self.low else here[:, int(here.std(axis=0).argmax())]
            order, half = np.argsort(by, kind="stable"), len(rows) // 2
            self.children = [Tree(points, rows[order[:half]]), Tree(points, rows[order[half:]])]

    def search(self, points: np.ndarray, asked: np.ndarray, percent: int):
        """Pairs (row of a query, row of a point) whose summed minima allow for enough overlap."""
        sizes = asked.sum(axis=1)
        todo = [(self, np.arange(len(asked)))]
        while todo:
            node, looking = todo.pop()
            n = sizes[looking]
            looking = looking[(n * percent <= 100 * node.high) & (100 * n >= percent * node.low)]
            bound = np.minimum(asked[looking], node.most).sum(axis=1)
            looking = looking[enough(bound, sizes[looking] + node.low, percent)]
            if not len(looking):
                continue
            if node.children:
                todo += [(c, looking) for c in node.children]
                continue
            own = points[node.rows]
            for at in range(0, len(looking), 512):
                some = looking[at : at + 512]
                overlap = np.minimum(asked[some][:, None, :], own[None, :, :]).sum(axis=2)
                q, p = np.nonzero(enough(overlap, sizes[some][:, None] + own.sum(axis=1)[None, :], percent))
                yield some[q], node.rows[p]


def _tree_pairs(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        home = pdf[pdf["home"]].drop_duplicates("node")
        away = pdf[pdf["away"]].drop_duplicates("node")
        out = []
        if len(home) and len(away):
            points = _points(home["counts"])
            nodes, labels = home["node"].to_numpy(), home["label"].to_numpy()
            own, own_labels = away["node"].to_numpy(), away["label"].to_numpy()
            for q, p in Tree(points).search(points, _points(away["counts"]), percent):
                apart = own_labels[q] != labels[p]
                x, y = own[q][apart], nodes[p][apart]
                out.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
        pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"x": pairs[:, 0], "y": pairs[:, 1]})

    return run


class Join:
    """The tables of one similarity join, each written once."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, width: int, percent: int, shard: int):
        self.spark, self.percent, self.shard = docs.sparkSession, percent, shard
        body = plain(docs, doc_id, text).select("key", F.col("body").cast("binary").alias("body"))
        self.key = body.schema["key"].dataType.simpleString()
        found = body.mapInArrow(_pointer(width, percent), f"key {self.key}, n long, a long, b long, counts binary, marks array<long>")
        self.points = stage(found.withColumn("row", F.monotonically_increasing_id()), "points")
        whole = self.points.filter("n > 0").groupBy("a", "b")
        self.nodes = stage(
            whole.agg(
                F.min("row").alias("node"), F.min_by("key", "row").alias("rep"), F.min("key").alias("least"),
                F.first("n").alias("n"), F.first("counts").alias("counts"), F.first("marks").alias("marks"),
            ),
            "nodes",
        )
        signed = self.nodes.select(F.explode("marks").alias("mark"), "node")
        shared = signed.groupBy("mark").agg(F.count("*").alias("_n")).filter("_n > 1").select("mark")
        self.members = stage(self.unrepeated(stage(signed.join(shared, "mark", "left_semi"), "shared")), "members")
        wanted = stage(self.members.select("node").distinct().join(self.nodes.select("node", "a", "b", "rep"), "node"), "wanted")
        reps = broadcast_if_small(wanted.select("rep").distinct())
        texts = body.join(reps, body["key"].eqNullSafe(reps["rep"]), "left_semi").select("body")
        hashed = texts.mapInArrow(_hasher(width), "a long, b long, hashes binary")
        self.sets = stage(hashed.join(wanted.select("node", "a", "b"), ["a", "b"]).select("node", "hashes").dropDuplicates(["node"]), "sets")
        self.cards = self.nodes.select("node", "n", "counts")

    @staticmethod
    def unrepeated(rows: DataFrame) -> DataFrame:
        """(mark, node) with one signature for each set of nodes: the others would only bring the same pairs again.

        Alike long sets share hundreds of signatures, nearly all of them with the same nodes. 128 bits name a set of nodes.
        """
        name = [F.bit_xor(F.xxhash64("node", F.lit(salt))).alias(f"_{salt}") for salt in (0, 1)]
        one = rows.groupBy("mark").agg(F.count("*").alias("_n"), *name).groupBy("_n", "_0", "_1").agg(F.min("mark").alias("mark"))
        return rows.join(one.select("mark"), "mark", "left_semi")

    def verified(self, pairs: DataFrame, bounded: bool = False) -> DataFrame:
        """Of distinct pairs (x, y) those that are linked."""
        if not bounded:
            x, y = (self.cards.toDF(c, f"n{c}", f"c{c}") for c in "xy")
            pairs = stage(pairs.join(x, "x").join(y, "y").mapInArrow(_bounded(self.percent), "x long, y long"), "bounded")
        x, y = self.sets.toDF("x", "hx"), self.sets.toDF("y", "hy")
        return stage(pairs.join(x, "x").join(y, "y").mapInArrow(_exact(self.percent), "x long, y long"), "linked")

    def labels(self, links: DataFrame | None) -> DataFrame:
        """(node, label) of the members: the component by the links so far."""
        nodes = self.members.select("node").distinct()
        if links is None:
            return nodes.withColumn("label", F.col("node"))
        found = components(self.spark, links.toDF("fp", "to")).toDF("node", "found")
        return nodes.join(found, "node", "left").select("node", F.coalesce("found", "node").alias("label"))

    def open(self, links: DataFrame | None) -> DataFrame:
        """(mark, node, label) of the signatures that hold more than one component."""
        if links is None:
            return self.members.withColumn("label", F.col("node"))
        rows = stage(self.members.join(self.labels(links), "node"), "labelled")
        several = rows.groupBy("mark").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_a < _b").select("mark")
        return stage(rows.join(several, "mark", "left_semi"), "open")

    def star(self, rows: DataFrame, turn: int) -> DataFrame:
        """Links of every node with a pivot per signature, the same for many signatures of a group."""
        chosen = F.min_by(F.struct("node", "label"), F.xxhash64("node", F.lit(turn)))
        pivots = rows.groupBy("mark").agg(chosen.alias("pivot"))
        pairs = rows.join(pivots, "mark").filter(F.col("label") != F.col("pivot.label"))
        x, y = F.least("node", "pivot.node").alias("x"), F.greatest("node", "pivot.node").alias("y")
        return self.verified(pairs.select(x, y).distinct())

    def cells(self, rows: DataFrame) -> DataFrame:
        """(cell, node, label): the signatures of one smallest component as one cell, if it fits a shard, else each its own.

        Two nodes share many signatures; in a cell they meet once, not once per signature.
        """
        rows = rows.join(rows.groupBy("mark").agg(F.min("label").alias("_least")), "mark")
        whole = rows.select("_least", "node").distinct().groupBy("_least").agg(F.count("*").alias("_n"))
        cell = F.when(F.col("_n") <= self.shard, F.col("_least")).otherwise(F.col("mark")).alias("cell")
        return stage(rows.join(whole, "_least").select(cell, "node", "label").distinct(), "cells")

    def rest(self, rows: DataFrame) -> DataFrame:
        """Links between the components that still meet in a signature, through R-trees."""
        rows = self.cells(rows)
        per_label = rows.groupBy("cell", "label").agg(F.count("*").alias("n"))
        sizes = per_label.groupBy("cell").agg(F.sum("n").alias("held"), F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("most"))
        sizes = stage(sizes, "sizes")
        total = sizes.agg(F.sum(F.when(F.col("held") <= self.shard, F.col("held")))).first()[0] or 0
        rows = rows.join(sizes, "cell").join(self.cards.select("node", "counts"), "node")
        fields = ["node", "label", "counts"]
        few = rows.filter(F.col("held") <= self.shard).select(
            F.pmod(F.xxhash64("cell"), F.lit(max(1, total // self.shard))).alias("s"), F.lit(-1).cast("long").alias("c"), F.lit(-1).cast("long").alias("v"),
            *fields, F.lit(True).alias("home"), F.lit(True).alias("away"),
        )
        many = rows.filter(F.col("held") > self.shard)
        chunks, blocks = F.ceil(F.col("held") / self.shard), F.ceil((F.col("held") - F.col("most")) / self.shard)
        dealt = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), n)
        place = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
        at_home = many.withColumn("c", dealt(chunks, 1)).withColumn("v", place(blocks))
        visits = many.filter(F.col("label") != F.col("main")).withColumn("v", dealt(blocks, 2)).withColumn("c", place(chunks))
        sides = [few]
        for side, home in ((at_home, True), (visits, False)):
            sides.append(side.select(F.col("cell").alias("s"), "c", "v", *fields, F.lit(home).alias("home"), F.lit(not home).alias("away")))
        dealt_out = sides[0].unionByName(sides[1]).unionByName(sides[2])
        pairs = dealt_out.groupBy("s", "c", "v").applyInPandas(_tree_pairs(self.percent), "x long, y long")
        return self.verified(stage(pairs, "pairs").distinct(), bounded=True)


def linked(docs: DataFrame, doc_id="doc_id", text="text", width: int = SHINGLE, percent: int = PERCENT, shard: int = SHARD) -> DataFrame:
    """Per document its id, ``n_shingles`` and ``component_id``: the smallest id that links lead to."""
    join = Join(docs, doc_id, text, width, percent, shard)
    links = join.star(join.open(None), 0)
    for turn in range(1, ROUNDS):
        links = links.union(join.star(join.open(links), turn))
    links = links.union(join.rest(join.open(links)))
    label = components(join.spark, links.toDF("fp", "to")).toDF("node", "found")
    named = join.nodes.select("a", "b", "node", "least").join(label, "node", "left").withColumn("label", F.coalesce("found", "node"))
    smallest = named.groupBy("label").agg(F.min("least").alias("component"))
    of_set = named.join(smallest, "label").select("a", "b", "component")
    rows = join.points.select("key", "n", "a", "b")
    own = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component"))
    return rows.join(of_set, ["a", "b"], "left").select(F.col("key").alias(doc_id), F.col("n").alias("n_shingles"), own.alias("component_id"))
