"""Rows that are the same record by any of several natural keys.

Two rows that agree on all columns of one key are the same record, and so are rows that a chain of such agreements
joins: a listing entered twice with another price, then once more without its owner. Keys with a missing part say
nothing. Every key ties its rows to its smallest id, so a key held by n rows gives n - 1 links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from .joins import lookup

FLOATS = (T.FloatType(), T.DoubleType())
TO_THE_MICROSECOND = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def key_links(df: DataFrame, ident: str, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(a, b)``: every row with a shared key, linked to the smallest id that holds the key. Digests are shuffled, not values."""
    digests = []
    for number, columns in enumerate(keys.values()):
        # Adding zero makes minus zero equal to zero.
        cells = [F.col(f"`{c}`") + 0.0 if df.schema[c].dataType in FLOATS else F.col(f"`{c}`") for c in columns]
        whole = F.to_json(F.struct(F.lit(number).alias("key"), *[c.alias(f"c{i}") for i, c in enumerate(cells)]), TO_THE_MICROSECOND)
        known = F.lit(True)
        for c in cells:
            known = known & c.isNotNull()
        digests.append(F.when(known, F.sha2(whole, 256)))
    held = df.where(F.col(f"`{ident}`").isNotNull()).select(F.col(f"`{ident}`").alias("b"), F.explode(F.array_compact(F.array(*digests))).alias("k"))
    held = staged(held, "keys")
    heads = held.groupBy("k").agg(F.min("b").alias("a"), F.max("b").alias("last")).where("a < last").select("k", "a")
    return lookup(held, "k", heads).where("a < b").select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, record_id, copies)`` for every id in the links ``(a, b)``: the smallest id reachable, and how many are.

    Every round draws a new random order of the ids and merges each with the first of its neighbours and itself, which
    leaves a constant share of them on average, so rounds grow with the logarithm of the input and not with the length
    of its chains. What a round merged is written, and read backwards at the end.
    """
    links = staged(links.select("a", "b").where("a != b"), "links")
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        turn = F.lit(len(rounds))
        near = links.select("a", "b").union(links.select("b", "a")).toDF("id", "to")
        first = near.groupBy("id").agg(F.min(F.struct(F.xxhash64(turn, "to").alias("at"), "to")).alias("near"))
        own = F.struct(F.xxhash64(turn, "id").alias("at"), F.col("id").alias("to"))
        merged = staged(first.select("id", F.when(F.col("near") < own, F.col("near.to")).otherwise(F.col("id")).alias("to")), "merged")
        rounds.append(merged)
        left = lookup(links, "a", merged.toDF("a", "to")).select(F.col("to").alias("a"), "b")
        both = lookup(staged(left, "left"), "b", merged.toDF("b", "to")).select("a", F.col("to").alias("b")).where("a != b")
        links = staged(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("id"), F.col("a").alias("record_id"), F.lit(0).cast("long").alias("copies"))
    found = rounds[-1]
    for merged in reversed(rounds[:-1]):
        onward = lookup(merged, "to", found.toDF("to", "root"), "left")
        found = staged(onward.select("id", F.coalesce("root", "to").alias("to")), "found")
    roots = found.groupBy("to").agg(F.min("id").alias("record_id"), F.count("*").alias("copies"))
    return lookup(found, "to", roots).select("id", "record_id", "copies")


def same_records(df: DataFrame, ident: str, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """All rows with ``record_id``, the smallest id of their record, and ``copies``, how many ids the record has.

    A row that shares no key is its own record; rows without an id have neither value; rows that repeat an id are one
    id. Columns named like the two results are refused.
    """
    if taken := {"record_id", "copies"} & set(df.columns):
        raise ValueError(f"the rows already have {sorted(taken)}")
    found = components(key_links(df, ident, keys))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{ident}`").alias("id"))
    alone = F.when(F.col("id").isNotNull(), F.lit(1).cast("long"))
    return rows.join(found, "id", "left").select(
        "row.*", F.coalesce("record_id", "id").alias("record_id"), F.coalesce("copies", alone).alias("copies")
    )
