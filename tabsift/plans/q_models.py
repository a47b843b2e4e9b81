"""Trained models: every type, compared, explained, ablated.

With one yes/no feature a fitted model has a closed form (group means, group
rates), so SQL checks those. The rest are held to invariants, here and in tests.
"""

from pyspark.sql import functions as F

from ..modelling import explain, models, recommend, vectors
from ..modelling import scoreboard as sb
from ..modelling.workbench import Workbench
from ..operators import leakage
from ..operators.aggregates import profile_groups
from ..session import fresh_path
from .registry import register
from .views import table, view


def priced(spark, sf_dir):
    """Line items with a learnable target: what is left of the price after the discount."""
    return table(spark, sf_dir, "lineitem", heavy=True).select(
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        "l_extendedprice",
        F.when(F.col("l_tax") > 0.02, F.col("l_discount")).alias("l_discount"),
        "l_linenumber",
        "l_returnflag",
        (F.col("l_linestatus") == "O").alias("is_open"),
    )


def qualified(spark, sf_dir):
    """Documents with their quality label and facts about the text, not the text itself."""
    d = view(spark, sf_dir, "label_text", heavy=True)
    words = F.size(F.split("text", r"\s+"))
    return d.select(
        (F.col("quality") == 1).alias("good"),
        "lang",
        "n_chars",
        words.alias("words"),
        F.length(F.regexp_replace("text", r"[^0-9]", "")).alias("digits"),
        F.size(F.split("text", "\n")).alias("lines"),
    )


def _metrics(spark, model):
    rows = [(k, None if v is None else round(float(v), 4)) for k, v in model.metrics.items()]
    return spark.createDataFrame(rows, "metric string, value double").withColumn("model", F.lit(model.kind))


def _register_type(name, kind, label, source, **options):
    @register(name)
    def run(spark, sf_dir):
        return _metrics(spark, models.train(source(spark, sf_dir), kind, label, **options))

    return run


_register_type("train_logistic", "LOGISTIC_REG", "good", qualified, auto_class_weights=True)
_register_type("train_boosted_regressor", "BOOSTED_TREE_REGRESSOR", "net", priced, max_iterations=8)
_register_type("train_boosted_classifier", "BOOSTED_TREE_CLASSIFIER", "good", qualified, max_iterations=8)
_register_type("train_forest_regressor", "RANDOM_FOREST_REGRESSOR", "net", priced, num_trees=10)
_register_type("train_forest_classifier", "RANDOM_FOREST_CLASSIFIER", "good", qualified, num_trees=10)
_register_type("train_dnn_classifier", "DNN_CLASSIFIER", "good", qualified, max_iterations=30)
_register_type("train_multiclass", "LOGISTIC_REG", "lang", lambda s, d: qualified(s, d).drop("good"))


@register("predict_probs")
def predict_probs(spark, sf_dir):
    d = qualified(spark, sf_dir)
    m = models.train(d, "LOGISTIC_REG", "good")
    out = models.predict(m, d, threshold=0.3)
    return out.select(
        "good", "predicted_good", F.transform("predicted_good_probs", lambda p: F.round(p["prob"], 4)).alias("probs")
    )


@register("model_confusion")
def model_confusion(spark, sf_dir):
    d = qualified(spark, sf_dir)
    return models.confusion(models.train(d, "LOGISTIC_REG", "good"), d)


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Saved twice under one name, loaded, and asked for metrics and attributions."""
    d, bench = priced(spark, sf_dir), Workbench(spark, fresh_path(spark, "models"))
    bench.create_model("price", d.drop("is_open"), "LINEAR_REG", "net")
    bench.create_model("price", d, "LINEAR_REG", "net", global_explain=True)
    facts = bench.evaluate("price").select(*[F.round(c, 3).alias(c) for c in ("mean_absolute_error", "r2_score")])
    top = bench.global_explain("price").limit(1).select(F.col("feature").alias("strongest"))
    return facts.withColumn("strongest", top.scalar())


@register("kmeans_cards")
def kmeans_cards(spark, sf_dir):
    d = priced(spark, sf_dir)
    m = models.train(d.select("net", "l_extendedprice", "l_linenumber"), "KMEANS", num_clusters=4)
    return profile_groups(models.predict(m, d), "CENTROID_ID", {"median_net": "net"}, {"mean_line": "l_linenumber"}, {"pct_open": "is_open"})


@register("k_sweep")
def k_sweep(spark, sf_dir):
    return sb.k_sweep(priced(spark, sf_dir).select("net", "l_linenumber"), ks=(3, 4, 5)).withColumn(
        "davies_bouldin_index", F.round("davies_bouldin_index", 4)
    )


@register("model_search")
def model_search(spark, sf_dir):
    kinds = ["LINEAR_REG", "BOOSTED_TREE_REGRESSOR", "RANDOM_FOREST_REGRESSOR"]
    small = {"BOOSTED_TREE_REGRESSOR": {"max_iterations": 5}, "RANDOM_FOREST_REGRESSOR": {"num_trees": 5}}
    return sb.model_search(priced(spark, sf_dir), "net", kinds, **small).withColumn("value", F.round("value", 3))


@register("ablation")
def ablation(spark, sf_dir):
    groups = {"price": ["l_extendedprice"], "flags": ["is_open", "l_returnflag"]}
    return sb.ablate(priced(spark, sf_dir), "net", "LINEAR_REG", groups).withColumn("value", F.round("value", 3))


@register("seed_spread")
def seed_spread(spark, sf_dir):
    spread = sb.seed_spread(priced(spark, sf_dir), "net", "BOOSTED_TREE_REGRESSOR", [1, 2], max_iterations=4, subsample=0.5)
    return spread.select("metric", "runs", F.round("low", 3).alias("low"), F.round("high", 3).alias("high"))


@register("segment_feature")
def segment_feature(spark, sf_dir):
    found = sb.segment_feature(priced(spark, sf_dir), "net", ["l_extendedprice", "l_linenumber"], "LINEAR_REG", k=3)
    return found.withColumn("value", F.round("value", 3))


@register("explain_compare")
def explain_compare(spark, sf_dir):
    """The same rows, two models, two rankings of the same columns."""
    d = priced(spark, sf_dir)
    pair = {
        "linear": models.train(d, "LINEAR_REG", "net", global_explain=True),
        "tree": models.train(d, "BOOSTED_TREE_REGRESSOR", "net", global_explain=True, max_iterations=4),
    }
    wide = explain.compare_rankings(pair, spark)
    return wide.select("feature", "linear_rank", "tree_rank", *[F.round(f"{m}_attribution", 2).alias(f"{m}_attribution") for m in pair])


@register("text_vectors")
def text_vectors(spark, sf_dir):
    """Quality learned from hashed words of the whole text instead of hand-made patterns."""
    d = view(spark, sf_dir, "label_text").select((F.col("quality") == 1).alias("good"), "text")
    fitted = vectors.hashed_text(d, "text", dims=128)
    return _metrics(spark, models.train(vectors.text_features(fitted, d).drop("text"), "LOGISTIC_REG", "good", l2_reg=0.01))


@register("word_vectors")
def word_vectors(spark, sf_dir):
    d = view(spark, sf_dir, "label_text").select((F.col("toxic") == 1).alias("toxic"), "text")
    fitted = vectors.word_vectors(d, "text", dims=16)
    return _metrics(spark, models.train(vectors.text_features(fitted, d).drop("text"), "LOGISTIC_REG", "toxic", l2_reg=0.01))


@register("embedding_classifier")
def embedding_classifier(spark, sf_dir):
    return _metrics(spark, models.train(table(spark, sf_dir, "embeddings").select("label", "embedding"), "LOGISTIC_REG", "label", max_iterations=20))


# --- fits with a closed form, and invariants SQL can state --------------------


def _cheap(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem", heavy=True)
    return d.select((F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), (F.col("l_discount") > 0.05).alias("cheap"))


MEANS_SQL = """
select l_discount > 0.05 as cheap, count(*) as rows, round(avg(l_extendedprice * (1 - l_discount)), 2) as predicted from lineitem group by 1"""


def _per_group(scored, group, value, digits):
    return scored.groupBy(group).agg(F.count("*").alias("rows"), F.round(F.avg(value), digits).alias("predicted"))


@register("boosted_stump_means", MEANS_SQL)
def boosted_stump_means(spark, sf_dir):
    d = _cheap(spark, sf_dir)
    m = models.train(d, "BOOSTED_TREE_REGRESSOR", "net", split_method="NONE", max_iterations=1, max_tree_depth=1, subsample=1.0)
    return _per_group(models.predict(m, d), "cheap", "predicted_net", 2)


@register("forest_stump_means", MEANS_SQL)
def forest_stump_means(spark, sf_dir):
    d = _cheap(spark, sf_dir)
    m = models.train(d, "RANDOM_FOREST_REGRESSOR", "net", split_method="NONE", num_trees=1, max_tree_depth=1, bootstrap=False)
    return _per_group(models.predict(m, d), "cheap", "predicted_net", 2)


RATES_SQL = """
select l_discount > 0.05 as cheap, count(*) as rows, round(avg(cast(l_extendedprice * (1 - l_discount) > 60000 as int)), 3) as predicted
from lineitem group by 1"""


def _dear(spark, sf_dir):
    return _cheap(spark, sf_dir).select("cheap", (F.col("net") > 60000).alias("dear"))


def _rate(scored):
    return _per_group(scored, "cheap", F.col("predicted_dear_probs")[1]["prob"], 3)


@register("logistic_rates", RATES_SQL)
def logistic_rates(spark, sf_dir):
    d = _dear(spark, sf_dir)
    return _rate(models.predict(models.train(d, "LOGISTIC_REG", "dear", split_method="NONE"), d))


@register(
    "forest_stump_rates",
    """
select l_discount > 0.05 as cheap, count(*) as rows, round(avg(cast(l_discount > 0.04 as int)), 3) as predicted from lineitem group by 1""",
)
def forest_stump_rates(spark, sf_dir):
    """The two leaves vote differently here: leaves with one vote are merged, with their rates."""
    d = table(spark, sf_dir, "lineitem", heavy=True)
    d = d.select((F.col("l_discount") > 0.05).alias("cheap"), (F.col("l_discount") > 0.04).alias("dear"))
    m = models.train(d, "RANDOM_FOREST_CLASSIFIER", "dear", split_method="NONE", num_trees=1, max_tree_depth=1, bootstrap=False)
    return _rate(models.predict(m, d))


@register(
    "multiclass_rates",
    """
select lang = 'en' as english, round(avg(cast(source = 'src0' as int)), 2) as p_src0, count(*) as rows from documents group by 1""",
)
def multiclass_rates(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", (F.col("lang") == "en").alias("english"))
    m = models.train(d, "LOGISTIC_REG", "source", split_method="NONE", max_iterations=200)
    first = F.filter("predicted_source_probs", lambda p: p["label"] == "src0")[0]["prob"]
    return models.predict(m, d).groupBy("english").agg(F.round(F.avg(first), 2).alias("p_src0"), F.count("*").alias("rows"))


@register("kmeans_assignment", "select count(*) as rows, 3 as segments, 0::bigint as misplaced from lineitem")
def kmeans_assignment(spark, sf_dir):
    """Every row belongs to the nearest centre of the trained segments."""
    d = table(spark, sf_dir, "lineitem", heavy=True).select("l_quantity", "l_extendedprice")
    m = models.train(d, "KMEANS", num_clusters=3, standardize_features=False)
    centres = m.pipeline.stages[-1].clusterCenters()
    far = [sum((F.col(c) - float(v)) ** 2 for c, v in zip(d.columns, centre)) for centre in centres]
    mine = F.get(F.array(*far), F.col("CENTROID_ID") - 1)
    out = models.predict(m, d)
    return out.agg(
        F.count("*").alias("rows"), F.count_distinct("CENTROID_ID").cast("int").alias("segments"), F.count_if(mine > F.least(*far) + 1e-3).alias("misplaced")
    )


@register(
    "recommend_whole",
    """
select user_id, 3::bigint as recommended, count(distinct event_type) as seen from events group by 1""",
)
def recommend_whole(spark, sf_dir):
    """Every user gets as many distinct items as asked for."""
    ev = table(spark, sf_dir, "events")
    top = recommend.factorize(ev, "user_id", "event_type", "value", factors=4, iterations=3).top(3)
    given = top.groupBy("user_id").agg(F.count_distinct("event_type").alias("recommended"))
    return given.join(ev.groupBy("user_id").agg(F.count_distinct("event_type").alias("seen")), "user_id")


@register(
    "roundtrip_same_predictions",
    "select count(*) as rows, 0::bigint as differing, count(distinct l_returnflag) as flags from lineitem",
)
def roundtrip_same_predictions(spark, sf_dir):
    """A saved and loaded model answers every row as the fitted one did."""
    d, bench = priced(spark, sf_dir), Workbench(spark, fresh_path(spark, "models"))
    m = bench.create_model("price", d, "LINEAR_REG", "net", split_method="NONE")
    once = models.predict(m, d).withColumnRenamed("predicted_net", "first")
    both = bench.predict("price", once)
    return both.agg(
        F.count("*").alias("rows"), F.count_if(~F.col("first").eqNullSafe(F.col("predicted_net"))).alias("differing"), F.count_distinct("l_returnflag").alias("flags")
    )


@register(
    "label_as_feature",
    "select 'l_extendedprice' as label, count(*) as rows, true as perfect, true as flagged, true as refused from lineitem",
)
def label_as_feature(spark, sf_dir):
    """The label copied into a feature: a perfect metric, an alarm, and a refusal by lineage."""
    d = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", (F.col("l_extendedprice") * 1.001).alias("copy"))
    m = models.train(d, "LINEAR_REG", "l_extendedprice")
    alarm = leakage.label_copies(d, "l_extendedprice", ["copy"]).select("is_copy").scalar()
    refused = bool(leakage.lineage_verdicts(["copy"], "l_extendedprice", {"copy": leakage.Feature("copy", ("l_extendedprice",))}))
    return d.agg(F.count("*").alias("rows")).select(
        F.lit("l_extendedprice").alias("label"), "rows", F.lit(m.metrics["r2_score"] > 0.9999).alias("perfect"), alarm.alias("flagged"), F.lit(refused).alias("refused")
    )


# --- Shapley values of trees -------------------------------------------------


@register("shapley_sums", "select 'regressor' as model, count(*) as rows, 0::bigint as off from lineitem union all select 'classes', 3 * count(*), 0 from lineitem")
def shapley_sums(spark, sf_dir):
    """Every row's values and the mean answer sum up to its answer: of a boosted regressor, and per class of a forest."""
    d = priced(spark, sf_dir)
    boosted = models.train(d, "BOOSTED_TREE_REGRESSOR", "net", max_iterations=4)
    forest = models.train(d.drop("net"), "RANDOM_FOREST_CLASSIFIER", "l_returnflag", num_trees=3)
    total = lambda e: F.aggregate(e["parts"], e["baseline"], lambda a, p: a + p["attribution"])

    def off(name, m, answer, near):
        rows = explain.shapley(m, models.predict(m, d)).withColumn("e", F.explode("explained"))
        apart = F.abs(total(F.col("e")) - answer) > near
        return rows.agg(F.count("*").alias("rows"), F.count_if(apart).alias("off")).withColumn("model", F.lit(name))

    of_class = F.filter("predicted_l_returnflag_probs", lambda p: p["label"] == F.col("e.label"))[0]["prob"]
    return off("regressor", boosted, F.col("predicted_net"), 1e-4).unionByName(off("classes", forest, of_class, 1e-9))


@register(
    "shapley_stump",
    """
with g as (select l_discount > 0.05 as cheap, l_extendedprice * (1 - l_discount) as net from lineitem)
select cheap, count(*) as rows, round(avg(net) - (select avg(net) from g), 2) as attribution from g group by 1""",
)
def shapley_stump(spark, sf_dir):
    """With one yes/no feature the value is the group's mean less the mean of all."""
    d = _cheap(spark, sf_dir)
    m = models.train(d, "BOOSTED_TREE_REGRESSOR", "net", split_method="NONE", max_iterations=1, max_tree_depth=1, subsample=1.0)
    found = explain.shapley(m, d).withColumn("v", F.col("explained")[0]["parts"][0]["attribution"])
    return found.groupBy("cheap").agg(F.count("*").alias("rows"), F.round(F.avg("v"), 2).alias("attribution"))


@register(
    "class_level_explain",
    """
with f as (select l_discount > 0.05 as cheap, case when l_discount > 0.07 then 'high' when l_discount > 0.01 then 'mid' else 'low' end as flag from lineitem),
g as (select cheap, count(*) / sum(count(*)) over () as share, avg(cast(flag = 'low' as int)) as low, avg(cast(flag = 'mid' as int)) as mid,
 avg(cast(flag = 'high' as int)) as high from f group by 1),
u as (select 'low' as label, share, low as rate from g union all select 'mid', share, mid from g union all select 'high', share, high from g),
t as (select *, sum(share * rate) over (partition by label) as mean from u)
select label, 'cheap' as feature, round(sum(share * abs(rate - mean)), 6) as attribution from t group by 1""",
)
def class_level_explain(spark, sf_dir):
    """A tree of one split, whose sides vote differently, has the group rates as answers; each class has its own attribution."""
    size = F.when(F.col("l_discount") > 0.07, "high").when(F.col("l_discount") > 0.01, "mid").otherwise("low")
    d = table(spark, sf_dir, "lineitem", heavy=True).select(size.alias("size"), (F.col("l_discount") > 0.05).alias("cheap"))
    m = models.train(
        d, "RANDOM_FOREST_CLASSIFIER", "size", split_method="NONE", global_explain=True, num_trees=1, max_tree_depth=1, bootstrap=False
    )
    return explain.global_explain(m, spark, class_level=True).withColumn("attribution", F.round("attribution", 6))
