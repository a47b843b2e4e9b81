"""Several columns at once, each in its own type."""

import datetime as dt
import decimal

from pyspark.sql import functions as F

from tabsift.operators import audit, quantiles


def middle(values):
    """The smallest value whose cumulative count reaches half."""
    held = sorted(v for v in values if v is not None)
    return held[(len(held) + 1) // 2 - 1] if held else None


def test_columns_keep_their_types(spark):
    """Groups without values of one kind, a missing group, values that doubles would round."""
    big, day, price = 2**60, dt.date(2024, 1, 1), decimal.Decimal("12345678901234567890.01")
    rows = [(g, big + i, i, day + dt.timedelta(i), dt.datetime(2024, 1, 1, 0, 0, 0, i), price + i, i / 8) for i, g in enumerate([None, "a", "a", "b", None] * 20)]
    rows += [("only", None, None, day, None, None, None), ("none", *[None] * 6)]
    schema = "g string, big long, small short, day date, at timestamp, price decimal(30,2), f float"
    df = spark.createDataFrame(rows, schema)
    names = df.columns[1:]
    out = quantiles.exact_columns(df, {c: c for c in names}, 0.5, by=["g"])
    assert [f.dataType for f in out.select(*names).schema] == [f.dataType for f in df.select(*names).schema]
    got = {r.g: tuple(r[c] for c in names) for r in out.collect()}
    want = {g: tuple(middle(r[i + 1] for r in rows if r[0] == g) for i in range(6)) for g in {r[0] for r in rows} - {"none"}}
    assert got == want
    whole = quantiles.exact_columns(df, {c: c for c in names}, 0.5).first()
    assert tuple(whole) == tuple(middle(r[i + 1] for r in rows) for i in range(6))


def test_alarm_over_mixed_types(spark):
    df = spark.range(101).select("id", F.col("id").cast("decimal(20,2)").alias("d"), (F.col("id") / 2).alias("f"))
    assert [r["median"] for r in audit.tail_alarm(df, ["id", "d", "f"]).collect()] == [50.0, 50.0, 25.0]
