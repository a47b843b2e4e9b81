"""Monthly series per group and an autoregression with a yearly season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import col, month_of

# Fixed value: fewer months than this say nothing about a yearly season.
MIN_PERIODS = 24


def monthly(df: DataFrame, date: Column | str, value: Column | str, by: Sequence[str]) -> DataFrame:
    """Mean and rows per group and month; everything later works on these few rows."""
    return df.groupBy(*by, month_of(date).alias("month")).agg(F.avg(col(value)).alias("value"), F.count("*").alias("rows"))


def with_lags(series: DataFrame, by: Sequence[str], lags: Sequence[int] = (1, 12)) -> DataFrame:
    """Values of earlier months by the calendar; NULL where that month has no rows.

    A series has at most a few hundred months per task.
    """
    return series.withColumns({f"lag_{k}": _months_ago("value", k, by) for k in lags})


def _months_ago(column: str, k: int, by: Sequence[str]) -> Column:
    months = F.map_from_entries(F.collect_list(F.struct("month", column)).over(W.partitionBy(*by)))
    return F.try_element_at(months, F.add_months("month", -k))


def fit(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """Level, yearly season and first-order autoregression of each series.

    Series with fewer than two years are returned with ``usable`` false and no
    coefficients: a season cannot be told from a trend.
    """
    w = W.partitionBy(*by)
    season = W.partitionBy(*by, F.month("month"))
    centred = series.withColumn("level", F.avg("value").over(w)).withColumn("season", F.avg("value").over(season) - F.col("level"))
    rest = centred.withColumn("rest", F.col("value") - F.col("level") - F.col("season"))
    rest = rest.withColumn("before", _months_ago("rest", 1, by))
    enough = F.count("*") >= MIN_PERIODS
    return rest.groupBy(*by).agg(
        F.count("*").alias("periods"),
        enough.alias("usable"),
        F.max("month").alias("last_month"),
        F.when(enough, F.first("level")).alias("level"),
        F.when(enough, F.regr_slope("rest", "before")).alias("phi"),
        F.when(enough, F.max_by("rest", "month")).alias("last_rest"),
        F.map_from_entries(F.collect_set(F.struct(F.month("month"), "season"))).alias("season"),
    )


def forecast(fitted: DataFrame, by: Sequence[str], horizon: int) -> DataFrame:
    """The next ``horizon`` months of every usable series."""
    steps = fitted.where("usable").select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    month = F.add_months("last_month", F.col("step"))
    value = F.col("level") + F.coalesce(F.col("season")[F.month(month)], F.lit(0.0)) + F.col("last_rest") * F.pow("phi", "step")
    return steps.select(*by, "step", month.alias("month"), value.alias("forecast"))
