"""Lists of items passed between steps: first item, count, shared configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import one_row


def first_item(df: DataFrame, order: str) -> DataFrame:
    """The item that comes first by ``order`` (a file has no row order to rely on)."""
    return df.orderBy(order).limit(1)


def count_items(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("items"))


def with_config(df: DataFrame, config: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Attach fields of a one-row configuration to every item."""
    row = one_row(config)
    return df.withColumns({out: row[c] for out, c in columns.items()})


def pair(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Pair items of two steps: by key, since position does not survive a shuffle."""
    return df.join(other, key)


def element(array: Column | str, offset: int) -> Column:
    """Zero-based element, NULL past the end."""
    return F.get(array, F.lit(offset))
