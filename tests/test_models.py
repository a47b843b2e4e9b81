"""Models, searches and streams by their invariants."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsift import session
from tabsift.modelling import explain, models, recommend, scoreboard, series, trees, vectors
from tabsift.modelling.split import split
from tabsift.modelling.workbench import Workbench
from tabsift.operators import rules
from tabsift.operators.leakage import Feature, LeakageError, label_copies
from tabsift.session import fresh_path
from tabsift.streaming import messages


@pytest.fixture(scope="module")
def homes(spark):
    """A target made of an area, a district and a flag, with holes in a useless column."""
    x = F.col("id")
    d = spark.range(1200).select(
        (F.pmod(x * 37, F.lit(200)) + 20).alias("area"),
        F.concat(F.lit("d"), F.pmod(x, F.lit(5)).cast("string")).alias("district"),
        (F.pmod(x, F.lit(3)) == 0).alias("pool"),
        F.when(F.pmod(x, F.lit(4)) != 0, F.pmod(x * 13, F.lit(7)).cast("double")).alias("noise"),
        F.lit(1.0).alias("flat"),
    )
    price = 1000.0 * F.col("area") + 5000.0 * F.substring("district", 2, 1).cast("int") + F.when(F.col("pool"), 20000.0).otherwise(0.0)
    return d.withColumn("price", price).cache()


def test_linear_learns_imputes_and_explains(spark, homes):
    m = models.train(homes, "LINEAR_REG", "price", global_explain=True)
    assert m.metrics["r2_score"] > 0.999
    att = dict(m.attribution)
    assert att["flat"] == pytest.approx(0, abs=1e-6)
    assert max(att, key=att.get) == "area" and att["pool"] > att["noise"]
    out = models.predict(m, homes)
    assert out.count() == homes.count() and out.columns == [*homes.columns, "predicted_price"]


def test_redraws_follow_the_whole_column(spark):
    """Hundreds of categories, each as often as it occurs; missing values and the rarest numbers too."""
    x = F.col("id")
    d = spark.range(20_000).select(
        x,
        F.when(F.pmod(x, F.lit(2)) == 0, F.lit("common")).otherwise(F.concat(F.lit("c"), F.pmod(x, F.lit(1001)).cast("string"))).alias("kind"),
        F.when(F.pmod(x, F.lit(10)) != 0, F.when(F.pmod(x, F.lit(500)) == 1, 1e9).otherwise(F.pmod(x, F.lit(7)).cast("double"))).alias("tail"),
    )
    out = explain.redrawn(d, [None, "kind", "tail"], d.columns)
    assert out.count() == 20_000 and out.columns == ["id", "kind", "tail", "_d1", "_d2"]
    kinds = {r["_d1"]: r["count"] for r in out.groupBy("_d1").count().collect()}
    assert kinds["common"] == pytest.approx(10_000, rel=0.05) and len(kinds) > 950 and max(n for k, n in kinds.items() if k != "common") < 35
    row = out.agg(F.avg((F.col("_d2") == 1e9).cast("int")), F.avg(F.col("_d2").isNull().cast("int"))).first()
    assert row[0] * 0.9 == pytest.approx(0.002, rel=0.5) and row[1] == pytest.approx(0.1, rel=0.1)


def test_attribution_counts_the_tail(spark):
    """One row in 250 has a large number and another answer; a redraw moves rows out of the tail and into it."""
    x = F.col("id")
    d = spark.range(5000).select(x, F.when(F.pmod(x, F.lit(250)) == 0, 1e6).otherwise(F.pmod(x * 7, F.lit(11)).cast("double")).alias("x"))
    d = d.withColumn("y", F.when(F.col("x") == 1e6, 1000.0).otherwise(0.0)).cache()
    m = models.train(d, "BOOSTED_TREE_REGRESSOR", "y", max_iterations=3)
    gap = models.predict(m, d).groupBy(F.col("x") == 1e6).agg(F.avg("predicted_y")).collect()
    share = 20 / 5000
    got = dict(explain.attributions(m, d))["x"]
    assert got == pytest.approx(2 * share * (1 - share) * abs(gap[0][1] - gap[1][1]), rel=0.25)


def test_label_as_feature_is_perfect_and_detected(homes):
    leaky = homes.withColumn("copy", F.col("price") * 1.001)
    m = models.train(leaky, "LINEAR_REG", "price")
    assert m.metrics["r2_score"] > 0.9999
    flagged = {r["column"]: r["is_copy"] for r in label_copies(leaky, "price", ["copy", "area"]).collect()}
    assert flagged == {"copy": True, "area": False}
    with pytest.raises(LeakageError):
        models.train(leaky, "LINEAR_REG", "price", catalog={"copy": Feature("copy", derived_from=("price",))})


def test_split_is_stable_and_keeps_duplicates_together(homes):
    doubled = homes.unionByName(homes)
    train, test = split(doubled)
    assert train.count() + test.count() == doubled.count()
    assert train.intersect(test).count() == 0
    assert split(doubled.repartition(5))[1].count() == test.count()
    assert 0.1 < test.count() / doubled.count() < 0.3


def test_by_column_split(homes):
    train, test = split(homes.withColumn("held", F.col("pool")), "BY_COLUMN", column="held")
    assert test.count() == homes.where("pool").count() and "held" not in train.columns


def test_schema_contract(spark, homes):
    m = models.train(homes.select("price", "area", "district"), "LINEAR_REG", "price")
    item = spark.range(1).select(F.lit(180).cast("int").alias("area"), F.lit("unseen").alias("district"))
    assert models.predict(m, item).first()["predicted_price"] > 0
    with pytest.raises(models.SchemaError):
        models.predict(m, item.withColumn("area", F.lit(180.0)))
    with pytest.raises(models.SchemaError):
        models.predict(m, item.drop("district"))


def test_workbench_replaces_and_reloads(spark, homes):
    bench = Workbench(spark, fresh_path(spark, "models"))
    bench.create_model("m", homes.select("price", "noise"), "LINEAR_REG", "price")
    weak = bench.evaluate("m").first()["r2_score"]
    bench.create_model("m", homes, "LINEAR_REG", "price", global_explain=True)
    assert bench.evaluate("m").first()["r2_score"] > max(weak, 0.99)
    assert bench.evaluate("m", homes).first()["r2_score"] > 0.99
    assert bench.global_explain("m").first()["feature"] == "area"
    with pytest.raises(ValueError):
        bench.create_model("quiet", homes, "LINEAR_REG", "price")
        bench.global_explain("quiet")


@pytest.mark.parametrize("kind", ["BOOSTED_TREE_REGRESSOR", "RANDOM_FOREST_REGRESSOR"])
def test_tree_regressors(homes, kind):
    m = models.train(homes, kind, "price", global_explain=True, max_iterations=5, num_trees=5)
    att = dict(m.attribution)
    assert m.metrics["r2_score"] > 0.7 and max(att, key=att.get) == "area" and att["flat"] == 0


@pytest.mark.parametrize("kind", models.CLASSIFIERS)
def test_classifiers(homes, kind):
    d = homes.withColumn("dear", F.col("price") > 120000).drop("price")
    weights = {} if kind == "DNN_CLASSIFIER" else {"auto_class_weights": True}
    m = models.train(d, kind, "dear", max_iterations=20, num_trees=5, **weights)
    assert m.metrics["accuracy"] > 0.85 and m.metrics["roc_auc"] > 0.9 and m.classes == [False, True]
    out = models.predict(m, d)
    p = out.select(F.round(F.aggregate("predicted_dear_probs", F.lit(0.0), lambda a, e: a + e["prob"]), 6).alias("s")).distinct().collect()
    assert [r["s"] for r in p] == [1.0]
    low, high = (models.confusion(m, d, threshold=t) for t in (0.1, 0.9))
    assert low.agg(F.sum("predicted_true")).first()[0] >= high.agg(F.sum("predicted_true")).first()[0]


def test_multiclass_tree_votes(homes):
    m = models.train(homes.select("district", "price", "area", "pool"), "BOOSTED_TREE_CLASSIFIER", "district", max_iterations=2)
    assert m.metrics["log_loss"] is None and len(m.classes) == 5


def test_categories_are_hashed_only_by_name(spark):
    d = spark.range(600).select(F.concat(F.lit("k"), (F.col("id") % 200).cast("string")).alias("k"), (F.col("id") % 200).cast("double").alias("y"))
    m = models.train(d, "LINEAR_REG", "y", split_method="NONE", l2_reg=1e-6, encoding={"k": "hash"})
    assert m.slots == [("k", models.HASH_SLOTS)] and m.metrics["r2_score"] > 0.7
    listed = models.train(d, "LINEAR_REG", "y", split_method="NONE", l2_reg=1e-6)
    assert listed.slots[0][1] in (200, 201) and listed.metrics["r2_score"] > 0.99
    with pytest.raises(ValueError, match="encoding"):
        models.train(d, "LINEAR_REG", "y", encoding="guess")


def test_arrays_of_one_length_with_missing_ones(spark):
    rows = [([float(i), float(i % 7)], 2.0 * i) for i in range(100)] + [(None, 100.0)]
    d = spark.createDataFrame(rows, "v array<double>, y double")
    m = models.train(d, "LINEAR_REG", "y", split_method="NONE")
    assert m.slots == [("v", 2)] and models.predict(m, d).count() == 101
    with pytest.raises(ValueError, match="differ in length"):
        models.train(d.union(spark.createDataFrame([([1.0], 2.0)], d.schema)), "LINEAR_REG", "y", split_method="NONE")


def test_kmeans_is_repeatable_and_numbered_from_one(homes):
    d = homes.select("price", "area")
    sizes = []
    for _ in range(2):
        m = models.train(d, "KMEANS", num_clusters=3)
        sizes.append(sorted((r["CENTROID_ID"], r["count"]) for r in models.predict(m, d).groupBy("CENTROID_ID").count().collect()))
    assert sizes[0] == sizes[1] and {c for c, _ in sizes[0]} == {1, 2, 3}


def test_k_sweep_finds_the_obvious_number(spark):
    d = spark.range(900).select((F.col("id") % 3 * 100 + F.col("id") % 7 / 10).alias("x"), (F.col("id") % 3 * 50).cast("double").alias("y"))
    chosen = scoreboard.k_sweep(d, ks=(2, 3, 5)).where("chosen").first()
    assert chosen["num_clusters"] == 3
    assert models.train(d, "KMEANS").options["num_clusters"] == 3


def test_segment_may_not_be_built_with_the_label(homes):
    with pytest.raises(ValueError):
        scoreboard.segment_feature(homes, "price", ["price", "area"], "LINEAR_REG")


def test_ablation_names_the_useful_column(homes):
    board = scoreboard.ablate(homes, "price", "LINEAR_REG", {"area": ["area"], "noise": ["noise"]})
    r2 = {r["model"]: r["value"] for r in board.where("metric = 'r2_score'").collect()}
    assert r2["all"] > 0.99 and r2["without_noise"] > 0.99 and r2["without_area"] < 0.5 and abs(r2["baseline"]) < 1e-9


def test_rankings_side_by_side(spark, homes):
    pair = {k: models.train(homes.select("price", "area", "pool"), t, "price", global_explain=True, num_trees=3) for k, t in (("line", "LINEAR_REG"), ("wood", "RANDOM_FOREST_REGRESSOR"))}
    assert {r["feature"] for r in explain.compare_rankings(pair, spark).where("line_rank = 1 and wood_rank = 1").collect()} == {"area"}


def test_seeds_share_the_prepared_rows_and_the_hold_out(homes, monkeypatch):
    """Two seeds prepare the rows once, write one table of answers, and find what models trained alone find."""
    prepared, prepare, written, stage = [], models._prepare, [], models.staged
    monkeypatch.setattr(models, "_prepare", lambda *a: (prepared.append(1), prepare(*a))[1])
    monkeypatch.setattr(models, "staged", lambda df, label: (written.append(label), stage(df, label))[1])
    options = {"max_iterations": 2, "subsample": 0.5}
    cut = split(session.staged(homes, "compared"))
    monkeypatch.setattr(scoreboard, "split", lambda *a: cut)
    found = scoreboard.seed_spread(homes, "price", "BOOSTED_TREE_REGRESSOR", [1, 2], **options).collect()
    assert len(prepared) == 1 and written == ["scored"]
    fit, held = cut
    alone = [models.train(fit, "BOOSTED_TREE_REGRESSOR", "price", split_method="NONE", stage=False, seed=s, **options) for s in (1, 2)]
    metrics = [models.evaluate(m, held).first().asDict() for m in alone]
    assert metrics[0] != metrics[1] and {r["metric"] for r in found} == set(metrics[0])
    for r in found:
        values = [m[r["metric"]] for m in metrics]
        assert (r["runs"], r["low"], r["high"]) == (2, pytest.approx(min(values)), pytest.approx(max(values)))


def test_search_sorts_only_what_may_be_among_the_best(monkeypatch):
    """All pairs are compared, but only a few per query and part are ordered; ties go to the smaller identifier."""
    rng = np.random.default_rng(2)
    base, asked = rng.normal(size=(6_000, 8)), rng.normal(size=(50, 8))
    base[5_000:5_010] = base[3]
    base[7] = 0.0
    sizes, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, axis=-1: (sizes.append(np.size(keys[0])), lexsort(keys, axis=axis))[1])
    parts = ((np.arange(a, a + 1_000), base[a : a + 1_000]) for a in range(0, 6_000, 1_000))
    got = vectors._best(np.arange(50), asked, parts, 4, True)
    assert sum(sizes) < 50 * 6_000 / 20
    with np.errstate(all="ignore"):
        s = (asked / np.linalg.norm(asked, axis=1, keepdims=True)) @ (base / np.linalg.norm(base, axis=1, keepdims=True)).T
    for q in range(50):
        want = sorted((-s[q, i], i) for i in range(6_000) if i not in (q, 7))[:4]
        assert [i for _, i in want] == got[got["query"] == q]["neighbour"].tolist()


def test_values_are_worked_out_once_per_pattern(monkeypatch):
    """Rows that answer every split alike are one pattern, whatever their number."""
    leaf = lambda share, value, left: trees.Leaf([0], np.array([share]), [[(0, left)]], np.array([value]))
    model = trees.Ensemble(["a", "b"], 1, [0], [trees.Split(0, 0.5, ())], [leaf(0.25, 8.0, True), leaf(0.75, 4.0, False)])
    asked, of_answers = [], trees.Ensemble._of_answers
    monkeypatch.setattr(trees.Ensemble, "_of_answers", lambda self, left: (asked.append(left.shape), of_answers(self, left))[1])
    x = np.array([[0.0], [1.0]] * 500)
    assert model.values(x).tolist() == [[[3.0, 0.0]], [[-1.0, 0.0]]] * 500 and asked == [(1, 2)]
    assert model.values(x[:0]).shape == (0, 1, 2) and trees.Ensemble(["a"], 1).values(x).shape == (1000, 1, 1)


def test_no_task_holds_more_rows_than_a_staged_file(spark, monkeypatch):
    """Rows that compress to next to nothing, in one task: they are read back in parts of bounded size, none lost."""
    monkeypatch.setattr(session, "FILE_ROWS", 1_000)
    back = session.staged(spark.range(0, 40_000, 1, 8).coalesce(1).selectExpr("id % 3 as i", "id"), "rows")
    sizes = [r["count"] for r in back.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 2_000
    assert back.agg(F.count_distinct("id")).first()[0] == 40_000


def test_parts_of_word_vectors_follow_the_text(spark, monkeypatch):
    """A join is planned as the product of its sides; the parts are counted from the text itself."""
    monkeypatch.setattr(vectors, "TRAIN_BYTES", 20_000)
    d = spark.createDataFrame([(i, f"word{i % 7} other{i % 5} tail") for i in range(2_000)], "i long, text string")
    both = d.join(d.select("i", F.col("text").alias("copy")).hint("merge"), "i")
    parts = vectors.word_vectors(both, "text", dims=4).stages[-1].getOrDefault("numPartitions")
    assert parts == 2_000 * len("word0 other0 tail") // 20_000


def test_vector_search_in_blocks_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(120, 8))
    v[7] = 0  # no direction
    v[9] = v[11]  # a tie
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id bigint, v array<double>").repartition(5)
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 40 * 8 * 8)
    got = vectors.vector_search(df, df, 4, "id", "v", "id", "v", skip_self=True).collect()
    unit = v / np.where(np.linalg.norm(v, axis=1, keepdims=True) == 0, np.nan, np.linalg.norm(v, axis=1, keepdims=True))
    sim = unit @ unit.T
    for q in range(120):
        want = sorted((i for i in range(120) if i != q and np.isfinite(sim[q, i])), key=lambda i: (-round(sim[q, i], 12), i))[:4]
        mine = [r["neighbour"] for r in sorted((r for r in got if r["query"] == q), key=lambda r: r["rank"])]
        assert mine == want


def test_dense_index_is_dense(spark):
    d = spark.range(5000).select((F.col("id") * 10_000_000_019 % 4001).cast("string").alias("k"))
    n = [r["n"] for r in recommend.dense_index(d, "k", "n").collect()]
    assert sorted(n) == list(range(4001))


def test_short_series_are_refused(spark):
    d = spark.range(600).select(F.when(F.col("id") < 400, "long").otherwise("short").alias("s"), "id")
    d = d.select("s", F.add_months(F.lit("2020-01-01").cast("date"), F.when(F.col("s") == "long", F.col("id") % 40).otherwise(F.col("id") % 10).cast("int")).alias("day"), F.col("id").cast("double").alias("v"))
    fitted = series.fit(series.monthly(d, "day", "v", ["s"]), ["s"])
    assert {r["s"]: r["usable"] for r in fitted.collect()} == {"long": True, "short": False}
    assert {r["s"] for r in series.forecast(fitted, ["s"], 3).collect()} == {"long"}


def test_stream_restart_adds_only_new_files(spark):
    inbox, out, marks = (fresh_path(spark, n) for n in ("inbox", "out", "marks"))
    rows = spark.range(100).select(F.col("id").cast("double").alias("price"))
    rows.where("price < 50").write.parquet(inbox)
    checks = [rules.between("price", 10, 80)]
    messages.clean_stream(messages.open_stream(spark, inbox, rows.schema), checks, out, marks)
    rows.where("price >= 50").write.mode("append").parquet(inbox)
    messages.clean_stream(messages.open_stream(spark, inbox, rows.schema), checks, out, marks)
    got = {r["quarantined"]: r["count"] for r in messages.read_cleaned(spark, out).groupBy("quarantined").count().collect()}
    assert got == {False: 71, True: 29}


# -- Shapley values of trees


def plain_tree(node):
    """(rows, answer) of a leaf, (rows, slot, test, left, right) of a split."""
    stats = node.impurityStats()
    if node.getClass().getSimpleName() == "LeafNode":
        rates = np.array(list(stats.stats()))
        return stats.count(), rates / rates.sum() if "Gini" in stats.getClass().getSimpleName() else np.array([node.prediction()])
    split = node.split()
    where = set(split.leftCategories()) if "Categorical" in split.getClass().getSimpleName() else split.threshold()
    return stats.count(), split.featureIndex(), where, plain_tree(node.leftChild()), plain_tree(node.rightChild())


def tree_answer(node, x, known, owner):
    """A tree's answer where only ``known`` columns are read."""
    if len(node) == 2:
        return node[1]
    rows, slot, where, left, right = node
    if owner[slot] in known:
        return tree_answer(left if (x[slot] in where if isinstance(where, set) else x[slot] <= where) else right, x, known, owner)
    return (left[0] * tree_answer(left, x, known, owner) + right[0] * tree_answer(right, x, known, owner)) / rows


def slow_shapley(answer, n):
    """Mean change over all orders, by subsets."""
    out = []
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        value = 0
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - 1 - size) / math.factorial(n)
            value = value + sum(weight * (answer({*s, i}) - answer(set(s))) for s in combinations(rest, size))
        out.append(value)
    return np.array(out)


@pytest.mark.parametrize("kind", ["BOOSTED_TREE_REGRESSOR", "RANDOM_FOREST_REGRESSOR", "RANDOM_FOREST_CLASSIFIER", "BOOSTED_TREE_CLASSIFIER"])
def test_shapley_values_equal_brute_force(spark, kind):
    x = F.col("id")
    h = lambda s, n: F.pmod(F.xxhash64(x, F.lit(s)), F.lit(n)).cast("double")
    d = spark.range(600).select(
        h(1, 9).alias("a"), F.when(h(2, 7) > 0, h(2, 7)).alias("b"), h(3, 5).alias("c"),
        F.when(h(4, 4) > 0, F.concat(F.lit("k"), h(4, 4).cast("int").cast("string"))).alias("kind"), (h(5, 2) > 0).alias("flag"),
    )
    y = F.col("a") * F.coalesce("b", F.lit(3.0)) + F.when(F.col("kind") == "k2", 20).otherwise(F.col("c")) + F.when(F.col("flag"), F.col("c") * 3).otherwise(0)
    three = "CLASSIFIER" in kind
    d = d.withColumn("y", F.when(y > 45, "high").when(y > 20, "mid").otherwise("low") if three else y).cache()
    m = models.train(d, kind, "y", max_iterations=3, num_trees=3, max_tree_depth=4)
    fitted, owner = m.pipeline.stages[-1], [i for i, (_, w) in enumerate(m.slots) for _ in range(w)]
    groups = fitted.models if hasattr(fitted, "models") else [fitted]
    some = models._scored(m, explain.shapley(m, d.limit(12))).collect()
    forest = [(g.treeWeights if "GBT" in type(g).__name__ else [1 / len(g.trees)] * len(g.trees), [plain_tree(t._call_java("rootNode")) for t in g.trees]) for g in groups]
    assert [p["feature"] for p in some[0]["explained"][0]["parts"]] == [n for n, _ in m.slots]
    for r in some:
        got = np.array([[p["attribution"] for p in e["parts"]] for e in r["explained"]])
        want = []
        for weights, roots in forest:
            want.append(slow_shapley(lambda s: sum(w * tree_answer(t, r["_features"], s, owner) for w, t in zip(weights, roots, strict=True)), len(m.slots)))
        want = np.concatenate(want, axis=1).T
        assert np.allclose(got, want)
        if kind.endswith("REGRESSOR"):
            assert got.sum() + r["explained"][0]["baseline"] == pytest.approx(r["prediction"])
        if kind == "RANDOM_FOREST_CLASSIFIER":
            assert np.allclose(got.sum(axis=1) + [e["baseline"] for e in r["explained"]], r["probability"].toArray())
    assert [e["label"] for e in some[0]["explained"]] == ([str(c) for c in m.classes] or [None])


def test_explanations_of_every_class(homes, spark):
    d = homes.withColumn("size", F.when(F.col("area") > 100, "l").when(F.col("area") > 60, "m").otherwise("s")).select("size", "area", "flat", "pool")
    for kind in models.CLASSIFIERS:
        m = models.train(d, kind, "size", global_explain=True, max_iterations=2 if "BOOSTED" in kind else 10, num_trees=3)
        per_class = explain.global_explain(m, spark, class_level=True).collect()
        assert len(per_class) == 9 and {r["label"] for r in per_class} == {"l", "m", "s"}
        assert all(max((r for r in per_class if r["label"] == c), key=lambda r: r["attribution"])["feature"] == "area" for c in "lms")


# -- vector search in blocks and in buckets


def cloud(spark, n, seed, width=8, name="id"):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    v = centres[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, width))
    v[: n // 3] = v[0]  # a third of all rows have one vector
    rows = [(i, [float(x) for x in v[i]]) for i in range(n)] + [(n, None), (n + 1, [0.0] * width)]
    return spark.createDataFrame(rows, f"{name} long, v array<double>"), v


def test_blocks_that_meet_pairwise_find_the_same(spark, monkeypatch):
    base, b = cloud(spark, 150, 1)
    asked, q = cloud(spark, 70, 2, name="q")
    names = ("id", "v", "q", "v")
    small = {tuple(r) for r in vectors.vector_search(base, asked, 4, *names).collect()}
    monkeypatch.setattr(vectors, "PART_ROWS", 16)
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 16 * 8 * 32)  # 16 rows a block
    large = {tuple(r) for r in vectors.vector_search(base, asked, 4, *names).collect()}
    assert {(r[0], r[1], r[3]) for r in small} == {(r[0], r[1], r[3]) for r in large} and len(large) == 70 * 4
    sim = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    for query, _, s, rank in large:
        assert s == pytest.approx(np.sort(sim[query])[::-1][rank - 1])
    assert vectors.vector_search(base, asked.limit(0), 4, *names).count() == 0


def test_buckets_find_most_neighbours(spark, monkeypatch):
    base, _ = cloud(spark, 400, 3)
    names = ("id", "v", "id", "v")
    exact = vectors.vector_search(base, base, 5, *names, skip_self=True).where("similarity < 0.999999")
    whole = vectors.lsh_search(base, base, 5, *names, skip_self=True, planes=4, tables=12, probes=2).cache()
    assert vectors.recall(whole, exact).first()["recall"] > 0.95
    monkeypatch.setattr(vectors, "PART_ROWS", 16)
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 16 * 8 * 32)
    cut = vectors.lsh_search(base, base, 5, *names, skip_self=True, planes=4, tables=12, probes=2)
    key = lambda df: {(r["query"], r["neighbour"], r["rank"]) for r in df.collect()}
    assert key(cut) == key(whole)  # blocks of a bucket change nothing
    assert vectors.lsh_search(base.limit(0), base, 5, *names).count() == 0
