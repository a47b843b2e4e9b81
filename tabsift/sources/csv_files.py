"""Delimited text: detect the separator, decode tolerantly, keep embedded JSON whole."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Separators tried, in order, and the one assumed when none fits.
SEPARATORS = (",", ";", "\t", "|")
FALLBACK_SEPARATOR = ","
HEAD_BYTES = 64 * 1024
CORRUPT = "_corrupt_record"


def pick_separator(lines: list[str]) -> str:
    """The separator that cuts most lines into the same number (over one) of fields."""
    bare = [re.sub(r'"(?:[^"]|"")*"', "", line) for line in lines if line.strip()]
    best, best_score = FALLBACK_SEPARATOR, 0.0
    for sep in SEPARATORS:
        cuts = Counter(line.count(sep) for line in bare)
        if not cuts:
            continue
        n, lines_with = max(((k, v) for k, v in cuts.items() if k > 0), key=lambda kv: kv[1], default=(0, 0))
        score = n and lines_with / len(bare) + n / 1e6
        if score > best_score:
            best, best_score = sep, score
    return best


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """Look at the first lines of one file only; the rest is never read here."""
    head, size = [], 0
    for row in spark.read.text(path).limit(256).collect():
        head.append(row.value)
        size += len(row.value)
        if size > HEAD_BYTES:
            break
    return pick_separator(head)


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    schema: T.StructType | str | None = None,
    multiline: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """A header CSV, read where it lies.

    Bytes that are not UTF-8 become the replacement character and rows that do
    not fit the schema are kept, never fatal. ``multiline`` (a quoted cell with
    line breaks) makes a file one task: ingest such files to bronze at once.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if schema is not None and keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.option("header", True)
        .option("sep", sep or sniff_delimiter(spark, path))
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("multiLine", multiline)
    )
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').csv(path)
