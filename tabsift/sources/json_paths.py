"""Which paths does a JSON column hold, and how full is each?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import share
from ..session import one_row


def leaves(schema: T.DataType, at: tuple[str, ...] = ("$",), shown: str = "") -> list[tuple[str, tuple[str, ...], str]]:
    """``(shown path, lookup paths, type)`` for every leaf of a merged schema; each array starts a new lookup path."""
    if isinstance(schema, T.StructType) and schema.fields:
        out = []
        for f in schema.fields:
            quote = "'" if "'" not in f.name else '"'
            if quote in f.name:
                raise ValueError(f"a key with both kinds of quotes has no path: {f.name}")
            out += leaves(f.dataType, (*at[:-1], f"{at[-1]}[{quote}{f.name}{quote}]"), f"{shown}.{f.name}" if shown else f.name)
        return out
    if isinstance(schema, T.ArrayType):
        return leaves(schema.elementType, (*at, "$"), f"{shown}[]")
    return [(shown, at, schema.simpleString())]


def _values(doc: Column, at: tuple[str, ...]) -> Column:
    """All values of a leaf in a document, as texts: those of every element of the arrays on the way."""
    if len(at) == 1:
        value = F.try_variant_get(doc, at[0], "variant")
        text = F.try_variant_get(doc, at[0], "string")
        kept = value.isNotNull() & ~F.is_variant_null(value)
        return F.when(kept, F.array(F.coalesce(text, F.to_json(value)))).otherwise(F.array().cast("array<string>"))
    inner = F.transform(F.try_variant_get(doc, at[0], "array<variant>"), lambda v: _values(v, at[1:]))
    return F.coalesce(F.flatten(inner), F.array().cast("array<string>"))


def inventory(df: DataFrame, doc: str) -> DataFrame:
    """One row per path: filled rows, share, rough number of values, constant or not.

    A row is filled if any element of the arrays on the path is. A first pass
    merges the schema of all documents, a second one counts every path at once,
    a third the distinct values under arrays.
    """
    parsed = df.select(F.try_parse_json(doc).alias("_d"))
    merged = parsed.select(F.expr("schema_of_variant_agg(_d)")).first()[0]
    found = leaves(T.DataType.fromDDL(merged.replace("OBJECT<", "STRUCT<")))
    values = parsed.select(*[_values(F.col("_d"), at).alias(f"_v{i}") for i, (_, at, _) in enumerate(found)])
    aggs = [F.count("*").alias("_n")]
    for i, (_, at, _) in enumerate(found):
        v = F.col(f"_v{i}")
        aggs += [F.count_if(F.size(v) > 0).alias(f"_k{i}"), F.min(F.array_min(v)).eqNullSafe(F.max(F.array_max(v))).alias(f"_c{i}")]
        if len(at) == 1:
            aggs.append(F.approx_count_distinct(F.get(v, F.lit(0))).alias(f"_d{i}"))
    nested = [i for i, (_, at, _) in enumerate(found) if len(at) > 1]
    wide = values.agg(*aggs)
    if nested:
        numbered = lambda i: lambda x: F.struct(F.lit(i).alias("i"), x.alias("x"))
        pairs = F.concat(*[F.transform(f"_v{i}", numbered(i)) for i in nested])
        each = values.select(F.explode(pairs).alias("p")).select("p.*")
        several = each.agg(*[F.approx_count_distinct(F.when(F.col("i") == i, F.col("x"))).alias(f"_d{i}") for i in nested])
        wide = wide.withColumns({f"_d{i}": one_row(several)[f"_d{i}"] for i in nested})
    items = [
        F.struct(
            F.lit(shown).alias("path"),
            F.lit(kind).alias("type"),
            F.col(f"_k{i}").alias("filled"),
            F.col("_n").alias("rows"),
            share(F.col(f"_k{i}"), F.col("_n")).alias("pct"),
            F.col(f"_d{i}").alias("distinct_approx"),
            F.col(f"_c{i}").alias("is_constant"),
        )
        for i, (shown, _, kind) in enumerate(found)
    ]
    return wide.select(F.inline(F.array(*items)))
