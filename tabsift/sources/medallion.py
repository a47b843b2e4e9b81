"""Bronze keeps the raw row, silver types it, gold is rebuilt whole."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_bronze(raw: DataFrame, path: str, mode: str = "append") -> None:
    """Append the untouched rows with where and when they came from."""
    raw.select("*", F.input_file_name().alias("_source"), F.current_timestamp().alias("_ingested_at")).write.mode(mode).parquet(path)


def to_silver(bronze: DataFrame, doc: str, spec: Mapping[str, tuple[str, str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns out of a JSON column: ``{column: (path, type)}``.

    The document is parsed once per row whatever the number of columns. A value
    that does not fit its type is NULL. One-element lists are addressed as
    ``$.bedrooms[0]``; casting the list itself would lose the value.
    """
    parsed = bronze.select(*keep, F.try_parse_json(doc).alias("_doc"))
    typed = [F.try_variant_get("_doc", path, dtype).alias(name) for name, (path, dtype) in spec.items()]
    return parsed.select(*keep, *typed)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a table as the result of a query; running it again is harmless."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def query(spark: SparkSession, text: str, **bindings) -> DataFrame:
    """A SELECT as a DataFrame; ``{name}`` binds a DataFrame, ``:name`` a value."""
    frames = {k: v for k, v in bindings.items() if isinstance(v, DataFrame)}
    return spark.sql(text, args={k: v for k, v in bindings.items() if k not in frames} or None, **frames)


def statement(spark: SparkSession, text: str, **values) -> None:
    """A statement run for its effect."""
    spark.sql(text, args=values or None).collect()
