"""What the text operators share: tables, staging, Arrow batches cut to a bounded size."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path

# Characters of text that a task holds in worked-out form (tokens, arrays) at a time.
SLICE_CHARS = 1_000_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package once per application, so that they need no installation of it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package, packed = Path(__file__).resolve().parents[1], io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(put_shared(spark, "package", packed.getvalue(), ".zip"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once into the shared folder and go on from the written table."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def commonest(counts: DataFrame, item: str, n: str, limit: int) -> list[tuple[str, int]]:
    """The items counted most, in falling order: as many of the highest counts, to three digits, as ``limit`` holds.

    A histogram of the counts finds the least count to take, so the driver gets at most ``limit`` rows, however many
    partitions there are.
    """
    unit = F.pow(F.lit(10.0), F.greatest(F.floor(F.log10(F.col(n).cast("double"))) - 2, F.lit(0)))
    level = (F.floor(F.col(n) / unit) * unit).cast("long")
    held, least = 0, None
    for r in sorted(counts.filter(F.col(n) > 0).groupBy(level.alias("level")).count().collect(), key=lambda r: -r.level):
        if held + r["count"] > limit:
            break
        held, least = held + r["count"], r.level
    if least is None:
        return []
    return sorted(((r[0], r[1]) for r in counts.filter(F.col(n) >= least).select(item, n).collect()), key=lambda r: (-r[1], r[0]))


def drawn(df: DataFrame, draw: Column, n: int, *ties) -> DataFrame:
    """``n`` rows in the order of a hash, a repeatable sample.

    Rows are thinned out by other bits of the hash first, to a few more than needed, so that no partition sends the
    driver ``n`` rows of its own.
    """
    share = min(1.0, (2 * n + 1000) / max(1, df.count()))
    some = df.filter(F.pmod(F.hash(draw), F.lit(1 << 30)) < int(share * (1 << 30)))
    return some.orderBy(draw, *ties).limit(n)


def slices(texts: list, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch that hold about ``limit`` characters each, one row at least."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def remainder(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id is never held out (-1)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod, F.lit(-1))


def plain(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Only the two columns an operator reads, under names no extra column can clash with."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{doc_id}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))


def renamed(df: DataFrame, doc_id: str) -> DataFrame:
    return df.withColumnRenamed("key", doc_id)


def put_shared(spark: SparkSession, label: str, payload: bytes, ending: str = "") -> str:
    """Write bytes to a new file of the shared folder, through the session's file system; its URI."""
    path = fresh_path(spark, label) + ending
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    try:
        out.write(payload)
    finally:
        out.close()
    return path
