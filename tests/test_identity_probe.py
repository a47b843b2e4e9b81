import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsift.operators import profiler
from tabsift.session import small_methods


@pytest.mark.parametrize("tolerance", [0.0, 1e-3, 0.3])
def test_misses_equal_plain_comparisons(monkeypatch, tolerance):
    """Values looked up by bucket, some rows at a time: missing, undefined, huge, equal and opposite numbers among them."""
    monkeypatch.setattr(profiler, "CACHED_ROWS", 8)
    monkeypatch.setattr(profiler, "COMPARED", 50)
    rng = np.random.default_rng(3)
    t = rng.normal(size=(60, 5)) * 10.0 ** np.array([-3, 0, 1, 2, 8])
    t[:, 2] = t[:, 1] * (1 + 1e-3 * rng.normal(size=60))
    t[:, 3] = t[:, 0] + t[:, 1]
    for share, v in ((0.1, 0.0), (0.05, np.inf), (0.05, np.nan), (0.05, -1e300), (0.05, 1.0)):
        t[rng.random(t.shape) < share] = v
    there, formulas = rng.random(t.shape) > 0.1, profiler._formulas(5, True)
    shapes = {**profiler.OPERATIONS, **profiler.RATIOS}
    groups = [(s, np.array([f[1:] for f in formulas if f[0] == s])) for s in shapes]
    got = profiler._misses(t, there, groups, shapes, tolerance, np)
    with np.errstate(all="ignore"):
        for (shape, a, b), row in zip(formulas, got, strict=True):
            v = shapes[shape](t[:, a], t[:, b])
            ok = there[:, a] & (there[:, b] if "{b}" in shape else True)
            if "/" in shape:
                ok &= t[:, b if shape.startswith("{a}") else a] != 0
            for c in range(5):
                y = t[:, c]
                near = np.isfinite(v) & np.isfinite(y) & (np.abs(v - y) <= tolerance * np.maximum(np.maximum(np.abs(v), np.abs(y)), 1))
                assert row[c] == np.count_nonzero(ok & there[:, c] & ~near)


def test_the_limit_of_methods_is_put_back(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    d = spark.range(2_000).select((F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 89).cast("double").alias("b"))
    found = profiler.identity_search(d.withColumn("c", F.col("a") + F.col("b")), ["a", "b", "c"], probe_share=0.05).collect()
    assert ("c", "a + b") in {(r["target"], r["formula"]) for r in found}
    with small_methods(spark):
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
