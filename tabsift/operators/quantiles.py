"""Quantiles that are values of the column.

``sketch`` is one pass with a bounded error. ``exact`` finds the very value:
the sketch only brackets it, a second pass counts rows below the bracket and the
distinct values inside it, and the bracket is narrowed until it is small, so no
task ever sorts a whole column or a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import col
from ..session import BROADCAST_ROWS

SKETCH_ACCURACY = 10_000
MARGIN = 2.0 / SKETCH_ACCURACY  # twice the sketch's rank error
GRID_STEPS = 1_000
BRACKET_ROWS = 1_000_000


def sketch(x: Column | str, probs: float | Sequence[float], accuracy: int = SKETCH_ACCURACY) -> Column:
    """Approximate quantile: an existing value, rank error at most n/accuracy."""
    return F.percentile_approx(col(x), list(probs) if not isinstance(probs, float) else probs, accuracy)


def _grid(x: Column) -> Column:
    steps = [i / GRID_STEPS for i in range(GRID_STEPS + 1)]
    return F.percentile_approx(x, steps, SKETCH_ACCURACY)


def exact_columns(df: DataFrame, columns: dict[str, Column | str], prob: float, by: Sequence[str] = ()) -> DataFrame:
    """The same quantile of several columns, each in its own type, one row per group that has any value.

    Columns whose values fit one carrier without loss (whole numbers, dates and timestamps; floats; decimals of one
    type) share two scans however many they are: each row becomes one (name, value) per column, in the same pass.
    """
    by, carriers = list(by), {}
    for name, x in columns.items():
        dtype = df.select(col(x).alias("_x")).schema["_x"].dataType
        number, back = _numbered(dtype, col(x))
        held = df.select(number.alias("_x")).schema["_x"].dataType
        carrier = "bigint" if isinstance(held, T.IntegralType) else held.simpleString() if isinstance(held, T.DecimalType) else "double"
        carriers.setdefault(carrier, []).append((name, number, lambda c, back=back, held=held, dtype=dtype: back(c.cast(held)).cast(dtype)))
    parts = []
    for carrier, members in carriers.items():
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), x.cast(carrier).alias("value")) for n, x, _ in members])
        tall = df.select(*by, F.explode(pairs).alias("_p")).select(*by, F.col("_p.name").alias("_name"), F.col("_p.value").alias("_value"))
        found = exact(tall, "_value", {"_q": prob}, by=[*by, "_name"])
        parts.append(found.groupBy(*by).agg(*[back(F.max(F.when(F.col("_name") == n, F.col("_q")))).alias(n) for n, _, back in members]))
    if len(parts) == 1:
        return parts[0]
    # A group that has values of one kind only is in one part.
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.groupBy(*by).agg(*[F.max(n).alias(n) for n in columns])


def _numbered(dtype: T.DataType, x: Column):
    """The column as a number in the order of its values, and the way back."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(x), lambda c: F.date_from_unix_date(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(x), lambda c: F.timestamp_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(x.cast("timestamp")), lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    if isinstance(dtype, T.NumericType):
        return x, lambda c: c
    raise TypeError(f"quantiles need numbers, dates or timestamps, not {dtype.simpleString()}")


def _widened(edge: Column, dtype: T.DataType, up: bool) -> Column:
    """An edge moved outward past the sketch's own rounding to double; a double is exact as it is."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return edge
    d = edge.cast("double")
    by = F.abs(d) * 2.0**-50 + 1.0
    kind = dtype.simpleString()
    if isinstance(dtype, T.DecimalType):
        most = F.lit("9" * (dtype.precision - dtype.scale) + ("." + "9" * dtype.scale if dtype.scale else "")).cast(dtype)
        return F.coalesce((d + by if up else d - by).try_cast(kind), most if up else -most)
    ends = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}[kind]
    most = F.lit(2**ends - 1 if up else -(2**ends)).cast(kind)
    return F.coalesce((d + by if up else d - by).try_cast(kind), most)


def exact(df: DataFrame, x: Column | str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """One row per group with a column per named quantile (nulls ignored), for numbers, dates and timestamps.

    The q-quantile is the smallest value whose cumulative count reaches q·n, in
    the column's own type: the sketch's edges, which went through double, are
    widened by more than its rounding. ``df`` is scanned once per narrowing
    level plus once for the final count.
    """
    by = list(by)
    kind = df.select(col(x).alias("_x")).schema["_x"].dataType
    number, back = _numbered(kind, col(x))
    # A struct key keeps rows whose group value is NULL through the joins below.
    key = F.struct(*[F.col(b) for b in by]) if by else F.struct(F.lit(0).alias("all"))
    names = ["_by"]
    base = df.select(key.alias("_by"), number.alias("_x")).where(F.col("_x").isNotNull())
    kind = base.schema["_x"].dataType

    edges = [e for p in probs.values() for e in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))]
    marks = base.groupBy(*names).agg(F.count("*").alias("_n"), sketch(F.col("_x"), edges).alias("_g"))
    cols = [F.col(k) for k in names] + [F.col("_n")]
    for i, p in enumerate(probs.values()):
        cols += [
            F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("_n"))).alias(f"_r{i}"),
            _widened(F.col("_g")[2 * i], kind, up=False).alias(f"_lo{i}"),
            _widened(F.col("_g")[2 * i + 1], kind, up=True).alias(f"_hi{i}"),
        ]
    brackets, rows = _small(marks.select(*cols))
    largest = brackets.agg(F.max("_n")).first()[0] if rows is None else max((r["_n"] for r in rows), default=0)
    inside = 2 * MARGIN * largest
    while inside > BRACKET_ROWS:
        brackets, rows = _small(_narrow(_attach(base, brackets, rows, bool(by)), names, len(probs), kind))
        inside = 5 * inside / GRID_STEPS
    picked = _pick(_attach(base, brackets, rows, bool(by)), names, list(probs))
    return picked.select(*[F.col("_by")[b].alias(b) for b in by], *[back(F.col(p)).alias(p) for p in probs])


def _around(grid: Column, p: Column, i: int, kind: T.DataType) -> list[Column]:
    """Two grid steps either side of ``p`` hold the answer despite the sketch error."""
    at = F.floor(p * GRID_STEPS).cast("int")
    low = F.element_at(grid, F.greatest(F.lit(1), at - 1))
    high = F.element_at(grid, F.least(F.lit(GRID_STEPS + 1), at + 4))
    return [_widened(low, kind, up=False).alias(f"_lo{i}"), _widened(high, kind, up=True).alias(f"_hi{i}")]


def _small(brackets: DataFrame) -> tuple[DataFrame, list | None]:
    """Fix the few bracket rows so later passes do not repeat the sketch pass.

    With more groups than may be broadcast the brackets stay a distributed
    table, joined by shuffle.
    """
    rows = brackets.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) > BROADCAST_ROWS:
        return brackets, None
    return F.broadcast(brackets.sparkSession.createDataFrame(rows, brackets.schema)), rows


def _attach(base: DataFrame, brackets: DataFrame, rows: list | None, grouped: bool) -> DataFrame:
    """Every row with its group's bracket; without groups the bracket is literals."""
    if grouped or not rows:
        return base.join(brackets, "_by")
    return base.select("*", *[F.lit(rows[0][f.name]).cast(f.dataType).alias(f.name) for f in brackets.schema if f.name != "_by"])


def _narrow(joined: DataFrame, names: list[str], n: int, kind: T.DataType) -> DataFrame:
    """One more sketch, over the rows inside each bracket only."""
    aggs = [F.first("_n").alias("_n")]
    for i in range(n):
        held = F.col("_x").between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))
        aggs += [
            F.first(f"_r{i}").alias(f"_r{i}"),
            F.count_if(F.col("_x") < F.col(f"_lo{i}")).alias(f"_b{i}"),
            F.count_if(held).alias(f"_c{i}"),
            _grid(F.when(held, F.col("_x"))).alias(f"_g{i}"),
        ]
    level = joined.groupBy(*names).agg(*aggs)
    cols = [F.col(k) for k in names] + [F.col("_n")]
    for i in range(n):
        p = (F.col(f"_r{i}") - F.col(f"_b{i}")) / F.col(f"_c{i}")
        cols += [F.col(f"_r{i}"), *_around(F.col(f"_g{i}"), p, i, kind)]
    return level.select(*cols)


def _pick(joined: DataFrame, names: list[str], probs: list[str]) -> DataFrame:
    """Count values inside brackets one by one and everything between brackets in bulk."""
    n = len(probs)
    x = F.col("_x")
    inside = F.lit(False)
    kind = joined.schema["_x"].dataType.simpleString()
    floor = F.lit(None).cast(kind)
    for i in range(n):
        inside = inside | x.between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))
        floor = F.greatest(floor, F.when(F.col(f"_hi{i}") < x, F.col(f"_hi{i}")))
    ranks = [f"_r{i}" for i in range(n)]
    counts = (
        joined.select(*names, *ranks, F.when(inside, x).alias("_v"), F.when(~inside, F.struct(floor.alias("f"))).alias("_gap"))
        .groupBy(*names, *ranks, "_v", "_gap")
        .agg(F.count("*").alias("_k"))
        .withColumn("_o", F.coalesce(F.col("_v"), F.col("_gap.f")))
        .withColumn("_bulk", F.col("_v").isNull())
    )
    order = W.partitionBy(*names).orderBy(F.col("_o").asc_nulls_first(), F.col("_bulk"))
    ranked = counts.withColumn("_cum", F.sum("_k").over(order.rowsBetween(W.unboundedPreceding, 0)))
    reached = [F.when(~F.col("_bulk") & (F.col("_cum") >= F.col(r)), F.col("_v")) for r in ranks]
    return ranked.groupBy(*names).agg(*[F.min(v).alias(p) for v, p in zip(reached, probs)])
