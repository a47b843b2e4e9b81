"""Successive halving by its schedule and against the full grid; models that are replaced whole or not at all."""

import pytest
from pyspark.sql import functions as F

from tabsift.modelling import models, search
from tabsift.session import fresh_path


@pytest.fixture(scope="module")
def steps(spark):
    """A staircase of eight steps: trees need depth three to tell them apart."""
    x = F.col("id")
    d = spark.range(1600).select(F.pmod(F.xxhash64(x), F.lit(80)).cast("double").alias("a"), F.pmod(x * 3, F.lit(7)).cast("double").alias("noise"))
    return d.withColumn("y", F.get(F.array(*[F.lit(float(v)) for v in (5, 1, 7, 3, 8, 2, 6, 4)]), F.floor(F.col("a") / 10).cast("int"))).cache()


def test_schedule_grows_as_candidates_fall():
    assert search.schedule(9, 1_000_000, 3, 10_000) == [(9, 1 / 9), (3, 1 / 3), (1, 1.0)]
    assert search.schedule(27, 100_000, 3, 50_000) == [(27, 0.5), (9, 0.5), (3, 0.5), (1, 1.0)]
    assert search.schedule(4, 100, 2, 10_000) == [(4, 1.0)] and search.schedule(1, 10**9, 3) == [(1, 1.0)]
    assert search.candidates({"a": [1, 2], "b": [3]}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]


def test_samples_are_nested_and_folds_apart(steps):
    rows = search._dealt(steps.withColumn("y", F.when(F.col("noise") > 0, F.col("y"))), "y", 2, 7)
    assert rows.count() == steps.where("noise > 0").count() and {r[0] for r in rows.select("_fold").distinct().collect()} == {0, 1}
    small, large = (rows.where(F.col("_place") < int(s * search.PLACES)) for s in (0.2, 0.6))
    assert small.exceptAll(large).count() == 0 and 0.15 < small.count() / rows.count() < 0.25 < 0.5 < large.count() / rows.count()


def test_halving_finds_the_winner_of_the_grid_with_fewer_rows(spark, steps):
    grid = {"max_tree_depth": [1, 4, 2], "max_iterations": [1]}
    halved = search.halving_search(steps, "y", "BOOSTED_TREE_REGRESSOR", grid, least=300)
    whole = search.halving_search(steps, "y", "BOOSTED_TREE_REGRESSOR", grid, full=True)
    assert search.winner(halved) == search.winner(whole) == {"max_tree_depth": 4, "max_iterations": 1}
    assert sum(t.share * t.fits for t in halved) < sum(t.share * t.fits for t in whole)
    out = search.report(spark, halved).collect()
    assert [r["round"] for r in out] == [1, 1, 1, 2] and sum(r.kept for r in out) == 2


def test_a_writer_that_dies_leaves_the_old_model(spark, steps, monkeypatch):
    path = fresh_path(spark, "models")
    with pytest.raises(FileNotFoundError):
        models.Model.load(spark, path)
    first = models.train(steps, "LINEAR_REG", "y", l2_reg=0.5)
    first.save(spark, path)
    second = models.train(steps.drop("noise"), "LINEAR_REG", "y")
    with monkeypatch.context() as m:
        m.setattr(models, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            second.save(spark, path)
    assert models.Model.load(spark, path).features == first.features
    for _ in range(3):
        second.save(spark, path)
    assert models.Model.load(spark, path).features == second.features and len(models._commits(spark, path)) == 2
    with pytest.raises(Exception, match="exists"):  # two writers cannot make the same commit
        models._commit(spark, f"{path}/{models.COMMIT}{max(models._commits(spark, path)):010d}", "v")


def test_a_search_prepares_the_rows_of_a_fold_once(spark, steps, monkeypatch):
    """Not once per candidate, and nothing stays kept; the scores are those of models trained alone."""
    prepared, prepare, kept = [], models._prepare, len(spark.sparkContext._jsc.getPersistentRDDs())
    monkeypatch.setattr(models, "_prepare", lambda *a: (prepared.append(1), prepare(*a))[1])
    grid = {"l2_reg": [50.0, 0.0, 5.0]}
    found = search.halving_search(steps, "y", "LINEAR_REG", grid, full=True)
    assert len(prepared) == 2 and len(spark.sparkContext._jsc.getPersistentRDDs()) <= kept + 1  # the rows of the tests themselves
    rows = search._dealt(steps, "y", 2, 42)
    for t in found:
        alone = [
            models.train(rows.withColumn("held", F.col("_fold") == f).drop("_place", "_fold"), "LINEAR_REG", "y", split_method="BY_COLUMN", split_column="held", **t.candidate)
            for f in (0, 1)
        ]
        assert t.score == pytest.approx(sum(m.metrics["r2_score"] for m in alone) / 2, abs=1e-12)


def test_search_of_classes_and_of_preparations(spark, steps):
    """Candidates that prepare rows in their own way, and classifiers, are measured as when trained alone."""
    d = steps.select("a", F.when(F.col("noise") > 3, "x").otherwise("z").alias("mark"), (F.col("y") > 4).alias("big"))
    fit, held = d.where("a < 60"), d.where("a >= 40")
    variants = [{"num_trees": 2, "encoding": "hash"}, {"num_trees": 3}, {"num_trees": 2, "encoding": "hash", "seed": 5}]
    found = models.train_each(fit, held, "RANDOM_FOREST_CLASSIFIER", "big", variants, parallel=2)
    assert [m.options for m in found] == [{"seed": 42, **v, "split_method": "NONE"} for v in variants]
    for m, v in zip(found, variants):
        alone = models.train(fit, "RANDOM_FOREST_CLASSIFIER", "big", split_method="NONE", stage=False, **v)
        assert m.metrics == pytest.approx(models.evaluate(alone, held).first().asDict()) and m.slots == alone.slots
