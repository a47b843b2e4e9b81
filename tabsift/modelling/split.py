"""The hold-out is a policy stored with the model, not a draw that changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICIES = ("AUTO", "NONE", "BY_COLUMN")
TEST_PERCENT = 20


def in_test(df: DataFrame, seed: int = 42, percent: int = TEST_PERCENT, key: str | None = None) -> Column:
    """True for the held-out share. Without a key the whole row is hashed, so

    exact duplicates always fall on the same side and cannot leak across.
    """
    columns = [F.col(f"`{c}`") for c in ([key] if key else sorted(df.columns))]
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(100)) < percent


def split(df: DataFrame, policy: str = "AUTO", seed: int = 42, column: str | None = None, key: str | None = None):
    """``(train, test)``; the test side equals the training side under NONE."""
    if policy == "NONE":
        return df, df
    if policy == "BY_COLUMN":
        held = F.coalesce(F.col(column), F.lit(False))
        return df.where(~held).drop(column), df.where(held).drop(column)
    if policy == "AUTO":
        held = in_test(df, seed, key=key)
        return df.where(~held), df.where(held)
    raise ValueError(f"split policy must be one of {POLICIES}, not {policy!r}")
