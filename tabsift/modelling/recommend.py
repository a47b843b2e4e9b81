"""Matrix factorisation of who looked at what."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import staged
from . import inner_product

# Rows that one numbering bucket and one block of the factoriser should hold.
BUCKET_ROWS = 100_000
BLOCK_ROWS = 1_000_000


def dense_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """``(column, out)`` with out = 0, 1, 2, … for every distinct value.

    The factoriser takes 32-bit ids and keys may be anything. Values are numbered
    inside hash buckets; only bucket sizes are accumulated in one task.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    about = values.agg(F.approx_count_distinct(column)).first()[0]
    values = values.withColumn("_b", F.pmod(F.xxhash64(column), F.lit(max(1, about // BUCKET_ROWS))))
    sizes = values.groupBy("_b").agg(F.count("*").alias("_n"))
    before = W.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = W.partitionBy("_b").orderBy(column)
    numbered = values.withColumn("_r", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "_b")
    return numbered.select(column, (F.col("_o") + F.col("_r")).cast("int").alias(out))


@dataclass
class Recommender:
    model: ALSModel
    users: DataFrame
    items: DataFrame
    user: str
    item: str

    def top(self, k: int) -> DataFrame:
        """The ``k`` best items of every user, by the original identifiers."""
        recs = self.model.recommendForAllUsers(k).select("_u", F.posexplode("recommendations").alias("rank", "r"))
        recs = recs.select("_u", F.col("rank") + 1, F.col("r._i").alias("_i"), F.col("r.rating").alias("score"))
        named = recs.toDF("_u", "rank", "_i", "score").join(self.users, "_u").join(self.items, "_i")
        return named.select(self.user, self.item, "rank", "score")

    def top_by_length(self, k: int) -> DataFrame:
        """The same items for every user without scoring all pairs, and how many items each user was ``scored`` with.

        Longest factors are tried first, and a user is finished once no item left can reach the k-th score.
        """
        sides = self.model.itemFactors, self.model.userFactors
        found = inner_product.top_products(*sides, k, "id", "features", "id", "features")
        found = found.select(F.col("query").alias("_u"), "rank", F.col("neighbour").alias("_i"), F.col("product").alias("score"), "scored")
        return found.join(self.users, "_u").join(self.items, "_i").select(self.user, self.item, "rank", "score", "scored")


def factorize(df: DataFrame, user: str, item: str, weight: str | None = None, factors: int = 8, seed: int = 42, iterations: int = 8) -> Recommender:
    """Implicit-feedback factors from view counts (or a given weight per row)."""
    amount = F.sum(weight) if weight else F.count("*")
    seen = staged(df.groupBy(user, item).agg(amount.cast("float").alias("_w")), "seen")
    users, items = dense_index(seen, user, "_u"), dense_index(seen, item, "_i")
    ready = seen.join(users, user).join(items, item).select("_u", "_i", "_w")
    blocks = max(10, seen.count() // BLOCK_ROWS)
    als = ALS(numUserBlocks=blocks, numItemBlocks=blocks, rank=factors, maxIter=iterations, implicitPrefs=True, seed=seed, userCol="_u", itemCol="_i", ratingCol="_w")
    return Recommender(als.fit(ready), users, items, user, item)
