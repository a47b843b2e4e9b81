"""Monthly forecasts on series with known answers, and label noise with planted flips."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsift.modelling import arima, label_noise
from tabsift.operators.leakage import Feature, LeakageError


def ar_series(rng, n, phi, level=50.0):
    y = [0.0]
    for _ in range(n + 50):
        y.append(phi * y[-1] + rng.normal())
    return level + np.array(y[51:])


def test_line_and_season_go_on_with_and_without_holes():
    t = np.arange(70)
    whole = 4.0 * t + np.array([0, 5, 9, 0, 0, -14, 0, 0, 0, 0, 0, 0])[(t + 3) % 12]
    holes = whole.copy()
    holes[[5, 17, 18, 19, 44]] = np.nan
    assert np.allclose(arima.filled(holes, 3), whole)
    trend, season = arima.decomposed(whole, 3)
    assert np.allclose(trend + season, whole) and np.allclose(np.diff(trend), 4) and abs(season[:12].sum()) < 1e-9
    found = arima.forecast_values(whole[:60], 3, 10)
    assert np.allclose(found.values, whole[60:]) and np.allclose(found.errors, 0) and found.differences == 1


def test_orders_and_differences_follow_the_series():
    rng = np.random.default_rng(2)
    steady = [arima.differences(ar_series(rng, 150, 0.5)) for _ in range(30)]
    walks = [arima.differences(np.cumsum(rng.normal(size=150))) for _ in range(30)]
    assert np.mean(np.array(steady) == 0) > 0.8 and np.mean(np.array(walks) >= 1) > 0.8
    models = [arima.fit_arma(ar_series(rng, 200, 0.8)) for _ in range(20)]
    assert np.mean([len(m.ar) + len(m.ma) > 0 for m in models]) == 1
    noise = [arima.fit_arma(rng.normal(size=200)) for _ in range(20)]
    assert np.mean([len(m.ar) + len(m.ma) for m in noise]) < np.mean([len(m.ar) + len(m.ma) for m in models])
    # The lowest AIC of all orders is that of the order taken.
    y = ar_series(rng, 120, 0.7)
    best = arima.fit_arma(y)
    for p, q in ((0, 0), (1, 0), (0, 1)):
        most = arima.MOST_AR, arima.MOST_MA
        arima.MOST_AR, arima.MOST_MA = p, q
        try:
            assert best.aic <= arima.fit_arma(y).aic + 1e-9 or (p, q) == (len(best.ar), len(best.ma)) or p + q < 2
        finally:
            arima.MOST_AR, arima.MOST_MA = most


def test_shock_weights_and_forecasts_by_hand():
    m = arima.Arma(2.0, np.array([0.5]), np.array([0.3]), 1.0, 0.0, np.array([0.0, 0.4]))
    assert m.ahead(np.array([1.0, 3.0]), 3).tolist() == pytest.approx([2 + 1.5 + 0.12, 2 + 0.5 * 3.62, 2 + 0.5 * 3.81])
    assert m.shock_weights(4, 0).tolist() == pytest.approx([1, 0.8, 0.4, 0.2])
    assert m.shock_weights(4, 1).tolist() == pytest.approx([1, 1.8, 2.2, 2.4])


def test_intervals_hold_what_they_say():
    rng, inside = np.random.default_rng(5), []
    for _ in range(150):
        y = ar_series(rng, 126, 0.6)
        found = arima.forecast_values(y[:120], 0, 6)
        inside += (np.abs(y[120:] - found.values) <= 1.645 * found.errors).tolist()
    assert 0.78 < np.mean(inside) < 0.97


def test_odd_series_and_groups(spark):
    month = lambda k: dt.date(2000 + k // 12, k % 12 + 1, 1)
    rows = [("a", 1, month(k), 5.0) for k in range(30)] + [("a", None, month(k), float(k)) for k in range(12) if k != 4]
    rows += [(None, 1, month(3), 2.0), ("short", 1, month(0), 1.0), ("short", 1, month(2), 3.0), ("empty", 1, month(0), None)]
    s = spark.createDataFrame(rows, "g string, n int, month date, value double")
    found = arima.forecast(s, ["g", "n"], 3).collect()
    assert {(r.g, r.n) for r in found} == {("a", 1), ("a", None)} and len(found) == 6
    assert all(r.low == r.forecast == r.high == 5.0 and r.months == 30 and r.filled == 0 for r in found if r.n == 1)
    line = sorted((r for r in found if r.n is None), key=lambda r: r.step)
    assert [r.forecast for r in line] == pytest.approx([12, 13, 14]) and line[0].filled == 1 and line[0].month == dt.date(2001, 1, 1)
    parts = arima.decompose(s, ["g", "n"])
    assert parts.where("g is null").count() == 1 and parts.where("g = 'short'").count() == 3 and parts.where("g = 'empty'").count() == 0
    assert arima.forecast(s.limit(0), ["g"], 3).count() == 0 and arima.decompose(s.limit(0), ["g"]).count() == 0


CATALOG = {"kind": Feature("kind", ("title",)), "a": Feature("a", ("area",)), "twin": Feature("twin", ("title",))}


@pytest.fixture(scope="module")
def flipped(spark):
    """Three classes told apart by two columns; one label in 25 is another class's."""
    x = F.col("id")
    d = spark.range(3000).select(x, F.pmod(F.xxhash64(x), F.lit(30)).cast("double").alias("a"), F.pmod(x * 7, F.lit(5)).cast("double").alias("b"))
    cls = F.floor(F.col("a") / 10).cast("int")
    off = F.when(F.pmod(x, F.lit(25)) == 3, 1).otherwise(0)
    names = F.array(F.lit("x"), F.lit("y"), F.lit("z"))
    d = d.withColumn("kind", F.when(x != 77, F.get(names, F.pmod(cls + off, F.lit(3))))).withColumn("off", off)
    return d.cache()


def test_planted_flips_are_found(flipped):
    found = label_noise.find(flipped, "kind", ["a", "b"], CATALOG, "RANDOM_FOREST_CLASSIFIER", num_trees=1, max_tree_depth=2, bootstrap=False).cache()
    assert found.columns == [*flipped.columns, "probs", "likely", "given_prob", "likely_prob", "doubt"]
    planted, hits = flipped.where("off = 1 and kind is not null").count(), found.where("off = 1").count()
    assert hits > 0.95 * planted and found.count() - hits < 0.1 * planted and found.where("kind is null").count() == 0


def test_labels_without_a_source_and_leaks_are_refused(flipped):
    with pytest.raises(label_noise.LabelSourceError):
        label_noise.out_of_fold(flipped, "kind", ["a"], {})
    with pytest.raises(label_noise.LabelSourceError):
        label_noise.out_of_fold(flipped, "kind", ["a"], {"kind": Feature("kind")})
    with pytest.raises(LeakageError):
        label_noise.out_of_fold(flipped, "kind", ["a", "twin"], CATALOG)


def test_likely_classes_by_hand(spark):
    rows = [("x", [("x", 0.9), ("y", 0.1)]), ("x", [("x", 0.2), ("y", 0.8)]), ("y", [("x", 0.3), ("y", 0.7)]), ("y", [("x", 0.5), ("y", 0.5)])]
    scored = spark.createDataFrame(rows, "l string, probs array<struct<label:string,prob:double>>")
    marked = label_noise.likely(scored, "l").collect()
    # Means: x 0.55, y 0.6.
    assert [r.likely for r in marked] == ["x", "y", "y", None]
    odd = label_noise.suspects(label_noise.likely(scored, "l"), "l").collect()
    assert [(r.l, r.likely, round(r.doubt, 6)) for r in odd] == [("x", "y", 0.6)]
    counts = {(r.given, r.likely): r.rows for r in label_noise.joint_counts(label_noise.likely(scored, "l"), "l").collect()}
    assert counts == {("x", "x"): 1, ("x", "y"): 1, ("y", "y"): 1, ("y", None): 1}
