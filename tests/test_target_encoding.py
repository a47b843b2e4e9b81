"""Categories as out-of-fold means of the answer, against plain loops and inside models."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabsift.modelling import explain, models, target_encoding


def plain(rows, folds, smoothing):
    """Means over all rows and without each fold, per value; ``rows`` are (value, fold, answer)."""

    def mean(kept, value):
        prior = sum(r[2] for r in kept) / len(kept)
        own = [r[2] for r in kept if r[0] == value]
        return (sum(own) + smoothing * prior) / (len(own) + smoothing)

    return {v: (mean(rows, v), [mean([r for r in rows if r[1] != f], v) for f in range(folds)]) for v in {r[0] for r in rows}}


def test_means_equal_plain_loops(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, "hot", "hot", *"abcdefgh"]), draw.randrange(3), draw.randrange(100) / 4) for _ in range(400)] + [("once", 1, 9.0)]
    df = spark.createDataFrame(rows, "c string, f int, y double")
    got = {r.value: r for r in target_encoding.target_means(df, "c", [F.col("y"), -F.col("y")], F.col("f"), 3, 4.0).collect()}
    want = plain([(c or target_encoding.MISSING, f, y) for c, f, y in rows], 3, 4.0)
    assert got.keys() == want.keys()
    for v, (whole, by_fold) in want.items():
        assert got[v].means == pytest.approx([whole, -whole])
        assert [x for x, _ in got[v].by_fold] == pytest.approx(by_fold)


@pytest.mark.parametrize("small", [True, False], ids=["broadcast", "shuffle"])
def test_rows_get_the_means_of_their_value(spark, small, monkeypatch):
    if not small:
        monkeypatch.setattr(target_encoding, "broadcast_if_small", lambda df, rows: df)
    rows = [(i, None if i % 5 == 0 else "hot" if i % 2 else f"v{i}", i % 4, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, c string, f int, y double")
    means = target_encoding.target_means(df, "c", [F.col("y")], F.col("f"), 4)
    out = target_encoding.encoded(df, "c", means, [1.0], F.col("f")).select("id", vector_to_array("_t_c")[0].alias("t")).collect()
    want = plain([(c or target_encoding.MISSING, f, y) for _, c, f, y in rows], 4, target_encoding.SMOOTHING)
    assert {r.id: r.t for r in out} == pytest.approx({i: want[c or target_encoding.MISSING][1][f] for i, c, f, _ in rows})
    new = spark.createDataFrame([("never seen",)], "c string")
    assert target_encoding.encoded(new, "c", means, [7.5]).first()["_t_c"].toArray().tolist() == [7.5]


def test_an_answer_never_reaches_its_own_row(spark):
    """Every row has a value of its own, so nothing can be learned: all training rows get the mean of the other folds."""
    df = spark.range(500).select(F.col("id").cast("string").alias("c"), (F.col("id") % 10).cast("double").alias("y"), F.pmod("id", F.lit(5)).alias("f"))
    means = target_encoding.target_means(df, "c", [F.col("y")], F.col("f"))
    out = target_encoding.encoded(df, "c", means, [0.0], F.col("f")).select("f", vector_to_array("_t_c")[0].alias("t"))
    assert all(r.low == pytest.approx(r.high) for r in out.groupBy("f").agg(F.min("t").alias("low"), F.max("t").alias("high")).collect())


def test_trees_over_a_hundred_thousand_categories(spark, tmp_path):
    """More values than bins: groups of three rows share a value, and the model saved and read answers alike."""
    df = spark.range(300_000).select(
        F.concat(F.lit("v"), F.floor(F.col("id") / 3)).alias("c"), F.pmod(F.floor(F.col("id") / 3), F.lit(2)).cast("double").alias("half"), (F.col("id") % 7).cast("double").alias("noise")
    )
    df = df.withColumn("y", F.col("half") * 10).drop("half")
    # One tree sees both columns at every node; several would draw one of the two.
    m = models.train(df, "RANDOM_FOREST_REGRESSOR", "y", split_method="NONE", encoding="target", num_trees=1, max_tree_depth=2, target_smoothing=0.5)
    assert m.pipeline.stages[-1].getOrDefault("maxBins") == 32
    assert dict(m.slots) == {"c": 1, "noise": 1}
    assert m.means["c"].count() == 100_000
    m.save(spark, str(tmp_path / "m"))
    back = models.Model.load(spark, str(tmp_path / "m"))
    few = spark.createDataFrame([("v0", 1.0), ("v1", 1.0), ("unknown", 1.0), (None, 1.0)], "c string, noise double")
    answers = [sorted(models.predict(k, few).collect(), key=str) for k in (m, back)]
    assert answers[0] == answers[1] and len(answers[0]) == 4
    by_value = {r.c: r.predicted_y for r in answers[0]}
    assert by_value["v0"] < 2 and by_value["v1"] > 8


def test_several_classes_and_refusals(spark):
    """A rate per class but the first; explanations count a column once; clusters and single folds are refused."""
    df = spark.range(900).select((F.col("id") % 90).cast("string").alias("c"), F.element_at(F.array(*map(F.lit, "pqr")), (F.col("id") % 3 + 1).cast("int")).alias("y"))
    m = models.train(df, "RANDOM_FOREST_CLASSIFIER", "y", split_method="NONE", encoding={"c": "target"}, num_trees=2)
    assert m.slots == [("c", 2)] and m.metrics["accuracy"] == 1.0
    assert [c for c, _ in explain.attributions(m, df)] == ["c"]
    with pytest.raises(ValueError):
        models.train(df, "KMEANS", encoding="target", num_clusters=2)
    with pytest.raises(ValueError):
        models.train(df, "RANDOM_FOREST_CLASSIFIER", "y", encoding="target", target_folds=1)
