"""Merkle manifest of a dataset by exchanging cogrouped subtrees.

Every row is a leaf: the SHA-256 of its fields. The leaves of a group stand in the order of their ids, each run of
``FAN`` nodes becomes their hash until one is left, the group's subroot; subroots, in the order of the groups, give the
root in the same way. Leaves are digests computed in the JVM and written once; texts are never shuffled.

Rows get their places from one range shuffle: an increasing number within each written part and the sizes of the parts
before it. A superblock is ``FAN ** LEVELS`` neighbouring nodes. On the way up each superblock is reduced to one node,
and those nodes are the rows of the next round, a few thousand times fewer. On the way down, nodes and the outer nodes
that they need from above are cogrouped by superblock: each task finishes the local reduction, joins the siblings
inside with those outside to whole proofs, and folds the presented leaves up to the root. The same two steps serve
the groups' subroots. No task holds more than a superblock, whatever the sizes of groups, and the driver reads only
the size of the largest tree.

Defined cases: a null field is ``-``, so null and empty texts differ; rows without an id come first in their group;
equal ids are ordered by their leaves, and equal leaves are interchangeable; a null group is the first one; extra
columns play no part; an empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import planned_bytes
from .common import ship, stage

FAN = 8
LEVELS = 4  # of a superblock: 4,096 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Rows that one part of the range shuffle should hold.
PART_ROWS = 100_000


def digest_of(parts: Sequence[Column]) -> Column:
    """The leaf of a row: each field as its UTF-8 length, a colon and the value, ``-`` if it is null."""
    texts = [p.cast("string") for p in parts]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed), 256)


def leaves(
    docs: DataFrame, doc_id="doc_id", group="lang", fields: Sequence[str] = FIELDS, presented: Mapping[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """(key, tree, leaf, shown): ids, groups and leaves.

    ``shown`` is the leaf of the row as somebody presents it, with the fields of ``presented`` in place of its own in
    the rows that ``where`` selects; by default the leaf itself.
    """
    ship(docs.sparkSession)
    own = [F.col(f"`{f}`") for f in fields]
    leaf = digest_of(own)
    if presented:
        other = digest_of([presented.get(f, c) for f, c in zip(fields, own, strict=True)])
        shown = other if where is None else F.when(where, other)
    else:
        shown = F.lit(None).cast("string")
    # Groups as strings: nothing for the null group, which thus comes first, and a sign before all others.
    tree = F.coalesce(F.concat(F.lit("+"), F.col(f"`{group}`").cast("string")), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").alias("key"), tree.alias("tree"), leaf.alias("leaf"), shown.alias("shown")).withColumn(
        "shown", F.coalesce("shown", "leaf")
    )


def placed(rows: DataFrame, tree: str, order: Sequence[Column]) -> DataFrame:
    """The rows with ``at``, their place within ``tree`` from 0, and ``size``, the number of rows of the tree.

    Rows that tie in everything are told apart by a number given when they are written, so none crowd into one part.
    """
    first = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-rows")
    parts = max(1, math.ceil(first.count() / PART_ROWS))
    keys = [F.col(tree), *order, F.col("_row")]
    dealt = first.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    numbered = stage(dealt.withColumn("_number", F.monotonically_increasing_id()).drop("_row"), "merkle-ranges")
    numbered = numbered.withColumn("_part", F.shiftright("_number", 33))
    # A row per part and tree: at most one more per tree than there are parts.
    spans = numbered.groupBy("_part", tree).agg(F.min("_number").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(tree).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.select(
        "_part", F.col(tree).alias("_tree"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy(tree)).alias("size"),
    )
    joined = numbered.join(spans.withColumnRenamed("_part", "_p"), (F.col("_part") == F.col("_p")) & (F.col(tree) == F.col("_tree")))
    return joined.withColumn("at", F.col("_number") - F.col("_first") + F.col("_before")).drop("_part", "_p", "_tree", "_number", "_first", "_before")


def height(size: int, fan: int) -> int:
    """Levels above ``size`` nodes until one is left."""
    levels = 0
    while size > 1:
        size, levels = -(-size // fan), levels + 1
    return levels


def joint(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def reduction(nodes: Sequence[str], fan: int, levels: int) -> list[list[str]]:
    """The nodes and the levels above them, ``levels`` of them."""
    out = [list(nodes)]
    for _ in range(levels):
        below = out[-1]
        out.append([joint(below[i : i + fan]) for i in range(0, len(below), fan)])
    return out


def _up(fan: int, levels: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at", kind="stable")
        size, block = int(pdf["size"].iloc[0]), fan**levels
        top = reduction(pdf["node"], fan, min(levels, height(size, fan)))[-1]
        return pd.DataFrame({"tree": [pdf["tree"].iloc[0]], "at": [int(pdf["at"].iloc[0]) // block], "node": [top[0]], "size": [-(-size // block)]})

    return run


def _towers(rows: DataFrame, fan: int, levels: int) -> list[DataFrame]:
    """Rows (tree, at, node, size) of every round: the nodes of a round are the superblocks of the round before."""
    rounds, block = [rows], fan**levels
    while True:
        last = rounds[-1]
        up = last.groupBy("tree", F.floor(F.col("at") / block).alias("block")).applyInPandas(
            _up(fan, levels), f"tree {last.schema['tree'].dataType.simpleString()}, at long, node string, size long"
        )
        rounds.append(stage(up, "merkle-nodes"))
        if (rounds[-1].agg(F.max("size")).first()[0] or 0) <= 1:
            return rounds


def _paths(nodes: list[str], fan: int, levels: int) -> list[tuple[list[str], list[int], list[int]]]:
    """For each node its siblings, places and run lengths on the way up."""
    tower, out = reduction(nodes, fan, levels), []
    for i in range(len(nodes)):
        siblings, places, widths = [], [], []
        for level in tower[:-1]:
            a = i - i % fan
            run = level[a : a + fan]
            siblings += run[: i - a] + run[i - a + 1 :]
            places.append(i - a)
            widths.append(len(run))
            i //= fan
        out.append((siblings, places, widths))
    return out


def fold(leaf: str, siblings: Sequence[str], places: Sequence[int], widths: Sequence[int]) -> str:
    """The root that a leaf and its proof lead to."""
    at = 0
    for place, width in zip(places, widths, strict=True):
        run = list(siblings[at : at + width - 1])
        run.insert(place, leaf)
        leaf, at = joint(run), at + width - 1
    return leaf


def _down(fan: int, levels: int, extra: Sequence[str], final: bool, proofs: bool):
    def run(mine: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("at", ignore_index=True)
        outer = above.iloc[0]
        far, places, widths = list(outer["siblings"]), [int(x) for x in outer["places"]], [int(x) for x in outer["widths"]]
        nodes = mine["node"].tolist()
        inner = _paths(nodes, fan, min(levels, height(int(mine["size"].iloc[0]), fan)))
        whole = [(s + far, p + places, w + widths) for s, p, w in inner]
        out = {c: mine[c] for c in extra} | {"subroot": outer["subroot"], "root": outer["root"]}
        if not final or proofs:
            out |= {name: [w[i] for w in whole] for i, name in enumerate(("siblings", "places", "widths"))}
        if final:
            folded = [fold(s, *w) for s, w in zip(mine["shown"], whole, strict=True)]
            out |= {"leaf": nodes, "proof_sha256": [joint(w[0]) for w in whole], "folded_root": folded}
            out["verified"] = np.array(folded) == np.array([outer["root"]] * len(folded))
        return pd.DataFrame(out)

    return run


def _exchange(rows: DataFrame, outer: DataFrame, fan: int, levels: int, extra: Sequence[str], final: bool = False, proofs: bool = False) -> DataFrame:
    """Each superblock's rows meet the outer nodes that it needs."""
    block = F.floor(F.col("at") / fan**levels)
    kept = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in extra]
    schema = [*kept, "subroot string", "root string"]
    # A proof: the siblings on the way up, level by level, with the own place and the number of nodes in each run.
    schema += ["siblings array<string>", "places array<int>", "widths array<int>"] if not final or proofs else []
    schema += ["leaf string", "proof_sha256 string", "folded_root string", "verified boolean"] if final else []
    mine = rows.withColumn("_block", block).groupBy("tree", "_block")
    return mine.cogroup(outer.groupBy("tree", "at")).applyInPandas(_down(fan, levels, extra, final, proofs), ", ".join(schema))


def manifest(rows: DataFrame, fan: int = FAN, levels: int = LEVELS, proofs: bool = False) -> DataFrame:
    """Per leaf of ``leaves``: key, leaf, subroot, root, ``proof_sha256``, ``folded_root`` and ``verified``.

    The proof's digest is that of all its siblings from the bottom to the root; ``folded_root`` is what the shown leaf
    and the proof lead to. With ``proofs`` the siblings, and per level the own place and the length of the run, come along.
    """
    key_type = rows.schema["key"].dataType
    at = placed(rows, "tree", [F.asc_nulls_first("key"), F.col("leaf")]).withColumnRenamed("leaf", "node")
    # Ids travel as text: pandas would turn whole numbers beside missing ones into floats.
    at = stage(at.withColumn("key", F.col("key").cast("string")), "merkle-leaves")
    towers = _towers(at.select("tree", "at", "node", "size"), fan, levels)
    # The subroots are the rows of one more tree, in the order of their groups.
    tops = towers[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "node")
    groups = stage(placed(tops, "tree", [F.asc("name")]), "merkle-subroots")
    above = _towers(groups.select("tree", "at", "node", "size"), fan, levels)
    start = {"siblings": "array<string>", "places": "array<int>", "widths": "array<int>"}
    outer = above[-1].select("tree", "at", *[F.array().cast(t).alias(c) for c, t in start.items()], F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    for rows_of in above[1:-1][::-1]:
        outer = stage(_exchange(rows_of, outer, fan, levels, ["tree", "at"]), "merkle-outer")
    found = _exchange(groups, outer, fan, levels, ["name", "node"])
    outer = found.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("at"), "siblings", "places", "widths", F.col("node").alias("subroot"), "root")
    outer = stage(outer, "merkle-outer")
    for rows_of in towers[1:-1][::-1]:
        outer = stage(_exchange(rows_of, outer, fan, levels, ["tree", "at"]), "merkle-outer")
    return _exchange(at, outer, fan, levels, ["key"], final=True, proofs=proofs).withColumn("key", F.col("key").cast(key_type))
