"""Largest inner products: equal to all pairs, and cheaper."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsift.modelling import inner_product, recommend


def all_pairs(items, queries, k):
    """Per query its best items by product, then by id."""
    out = {}
    for q, u in queries:
        scored = sorted(((-float(np.dot(u, v)), i) for i, v in items))[:k]
        out[q] = [(i, -p) for p, i in scored]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query"], r["rank"])):
        out.setdefault(r["query"], []).append((r["neighbour"], r["product"]))
    return out


@pytest.mark.parametrize("slab_rows", [100, 10_000])
@pytest.mark.parametrize("ids", [int, "item {:03d}".format], ids=["numbers", "names"])
def test_products_equal_all_pairs(spark, slab_rows, ids, monkeypatch):
    """Whole numbers with many ties, repeated vectors, zero vectors and very unequal lengths."""
    monkeypatch.setattr(inner_product, "BLOCK_ITEMS", 16)
    rng = np.random.default_rng(1)
    items = [(ids(i), [float(x) for x in rng.integers(-2, 3, 6) * (1 + i % 5 * (i % 40 == 0))]) for i in range(300)]
    items += [(ids(300 + i), items[i][1]) for i in range(40)] + [(ids(400), [0.0] * 6)]
    queries = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(50)] + [(50, [0.0] * 6)]
    kind = "long" if ids is int else "string"
    a, b = spark.createDataFrame(items, f"i {kind}, v array<double>"), spark.createDataFrame(queries, "q long, v array<double>")
    got = inner_product.top_products(a, b, 4, "i", "v", "q", "v", slab_bytes=slab_rows * 6 * 8)
    assert found(got) == all_pairs(items, queries, 4)
    assert found(inner_product.top_products(a, b, 500, "i", "v", "q", "v", slab_bytes=slab_rows * 6 * 8)) == all_pairs(items, queries, 500)


def test_long_items_end_the_search(spark):
    rng = np.random.default_rng(2)
    near = rng.normal(size=(5000, 8))
    near /= np.linalg.norm(near, axis=1)[:, None]
    near[:50] *= 100
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(near)], "i long, v array<double>")
    got = inner_product.top_products(items, items, 3, "i", "v", "i", "v", slab_bytes=2000 * 8 * 8)
    scored = got.groupBy("query").agg(F.first("scored").alias("scored"), F.count("*").alias("n"))
    worst = scored.agg(F.max("scored").alias("most"), F.min("n").alias("least"), F.count("*").alias("queries")).first()
    assert worst.most <= inner_product.BLOCK_ITEMS and (worst.least, worst.queries) == (3, 5000)


def test_products_of_odd_rows(spark):
    items = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (None, [9.0, 9.0]), (5, [None, 1.0])], "i long, v array<double>")
    queries = spark.createDataFrame([(1, [1.0, 1.0], "x"), (2, None, "x"), (3, [float("inf"), 1.0], "x")], "q long, v array<double>, ids string")
    ask = lambda a, b: found(inner_product.top_products(a, b, 2, "i", "v", "q", "v"))
    assert ask(items, queries) == {1: [(1, 3.0)]}
    assert ask(items.limit(0), queries) == {} and ask(items, queries.limit(0)) == {}
    with pytest.raises(ValueError):
        ask(items, spark.createDataFrame([(1, [1.0])], "q long, v array<double>"))


def test_recommendations_by_length_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    seen = spark.createDataFrame([(f"u{a}", f"i{b}") for a, b in zip(rng.integers(0, 60, 1500).tolist(), (rng.zipf(1.4, 1500) % 90).tolist())], "u string, i string")
    model = recommend.factorize(seen, "u", "i", factors=4, iterations=3)
    full = {(r.u, r["rank"]): r.score for r in model.top(5).collect()}
    by_length = {(r.u, r["rank"]): r.score for r in model.top_by_length(5).collect()}
    assert full.keys() == by_length.keys()
    assert all(abs(full[x] - by_length[x]) < 1e-4 for x in full)
