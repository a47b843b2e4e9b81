"""The largest inner products of many vectors with many others, without trying all pairs.

No product exceeds the product of the two lengths. So items are tried in descending length, block by block, and a query
is finished once its k-th best product exceeds its own length times that of the longest item left. Items that do not fit
one slab are cut into slabs by length; after each slab, only queries that are still open go on to the next.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import union_all
from ..session import staged

# Bytes of items that every task holds at a time, and items between two looks at the bound.
SLAB_BYTES = 64 * 1024 * 1024
BLOCK_ITEMS = 64
# Queries that a task works on at a time.
QUERY_ROWS = 4_096
# The bound is widened by more than the rounding of a sum of products.
SLACK = 1 + 1e-9


def top_products(
    items: DataFrame, queries: DataFrame, k: int, ident: str, vector: str, query_ident: str, query_vector: str, slab_bytes: int = SLAB_BYTES
) -> DataFrame:
    """The exact ``k`` items of every query by inner product: query, neighbour, product, rank, scored.

    Equal products go by ascending item; ``scored`` is the number of items that the query was compared with. Missing
    vectors, and those with a missing or undefined part, match nothing. A slab of items, at most ``slab_bytes`` but for
    the unevenness of Spark's ranges, is all that passes the driver.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    asked, side = _side(queries, query_ident, query_vector), _side(items, ident, vector)
    widths = asked.select("v").unionAll(side.select("v")).agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if widths.least != widths.most:
        raise ValueError("vectors differ in length")
    schema = _schema(asked, side)
    laid, heads = _slabs(side, widths.most or 1, slab_bytes)
    kind = schema["ids"].dataType.simpleString()
    open_ = asked.select(F.col("id").alias("query"), "v", F.expr(f"cast(array() as {kind})").alias("ids"), F.expr("cast(array() as array<double>)").alias("products"), F.lit(0).cast("long").alias("scored"))
    done = []
    for i, (slab, _) in enumerate(heads):
        sent = _sent(laid.where(F.col("slab") == slab))
        following = heads[i + 1][1] if i + 1 < len(heads) else None
        out = open_.mapInPandas(_scan(sent, k, following), schema)
        if following is None:
            done.append(out)
            break
        out = staged(out, "products")
        done.append(out.where(~F.col("open")))
        open_ = out.where("open").drop("open")
        if open_.isEmpty():
            break
    if not done:
        done = [open_.withColumn("open", F.lit(False))]
    found = union_all(done).select("query", "scored", F.posexplode(F.arrays_zip("ids", "products")).alias("at", "r"))
    return found.select("query", F.col("r.ids").alias("neighbour"), F.col("r.products").alias("product"), (F.col("at") + 1).alias("rank"), "scored")


def _side(df: DataFrame, ident: str, vector: str) -> DataFrame:
    rows = df.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & sound)


def _schema(asked: DataFrame, side: DataFrame) -> T.StructType:
    doubles = T.ArrayType(T.DoubleType())
    kinds = {"query": asked.schema["id"].dataType, "v": doubles, "ids": T.ArrayType(side.schema["id"].dataType), "products": doubles}
    return T.StructType([T.StructField(c, t) for c, t in kinds.items()]).add("scored", "long").add("open", "boolean")


def _slabs(side: DataFrame, width: int, slab_bytes: int) -> tuple[DataFrame, list[tuple[int, float]]]:
    """The items with the number of their slab, and per slab its greatest length, descending."""
    sized = side.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    slabs = max(1, -(-sized.count() * width * 8 // slab_bytes))
    if slabs > 1:
        laid = staged(sized.repartitionByRange(slabs, F.desc("norm"), "id").withColumn("slab", F.spark_partition_id()), "slabs")
    else:
        laid = sized.withColumn("slab", F.lit(0))
    return laid, [(r.slab, r.norm) for r in laid.groupBy("slab").agg(F.max("norm").alias("norm")).orderBy("slab").collect()]


def _sent(slab: DataFrame):
    rows = slab.select("id", "v", "norm").toPandas().sort_values(["norm", "id"], ascending=[False, True])
    return slab.sparkSession.sparkContext.broadcast((rows["id"].to_numpy(), np.stack(list(rows["v"])), rows["norm"].to_numpy()))


def _scan(sent, k: int, following: float | None):
    def run(batches):
        ids, vectors, norms = sent.value
        for batch in batches:
            for at in range(0, len(batch), QUERY_ROWS):
                yield _advance(batch.iloc[at : at + QUERY_ROWS], ids, vectors, norms, k, following)

    return run


def _advance(pdf: pd.DataFrame, ids, vectors, norms, k: int, following: float | None) -> pd.DataFrame:
    """The queries of a frame after this slab, their best products so far in order."""
    asked, held = np.stack(list(pdf["v"])), [list(x) for x in pdf["ids"]]
    before = np.array([x for h in held for x in h], dtype=ids.dtype)
    names, place = np.unique(np.concatenate([ids, before]), return_inverse=True)  # ties go by the item
    place, earlier = place[: len(ids)], place[len(ids) :]
    best, items = np.full((len(pdf), k), -np.inf), np.full((len(pdf), k), len(names))
    start = 0
    for i, (h, p) in enumerate(zip(held, pdf["products"], strict=True)):
        best[i, : len(h)], items[i, : len(h)] = p, earlier[start : start + len(h)]
        start += len(h)
    length, scored = np.linalg.norm(asked, axis=1) * SLACK, pdf["scored"].to_numpy(copy=True)
    for at in range(0, len(ids), BLOCK_ITEMS):
        live = np.flatnonzero(best[:, -1] <= length * norms[at])
        if not len(live):
            break
        products = asked[live] @ vectors[at : at + BLOCK_ITEMS].T
        scored[live] += products.shape[1]
        better = (products >= best[live, -1:]).any(axis=1)
        live = live[better]
        both = np.concatenate([best[live], products[better]], axis=1)
        which = np.concatenate([items[live], np.broadcast_to(place[at : at + BLOCK_ITEMS], (len(live), products.shape[1]))], axis=1)
        order = np.lexsort((which, -both), axis=1)[:, :k]
        best[live], items[live] = np.take_along_axis(both, order, 1), np.take_along_axis(which, order, 1)
    found = [items[i][best[i] > -np.inf] for i in range(len(pdf))]
    return pd.DataFrame(
        {
            "query": pdf["query"].to_numpy(), "v": list(asked), "ids": [names[f].tolist() for f in found],
            "products": [best[i][: len(f)].tolist() for i, f in enumerate(found)], "scored": scored,
            "open": best[:, -1] <= length * following if following is not None else np.zeros(len(pdf), bool),
        }
    )
