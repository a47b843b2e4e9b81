"""Metrics, errors, segments, neighbours and series, on closed-form models SQL can repeat."""


from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.text_patterns import COMMERCIAL
from ..modelling import evaluate as ev
from ..modelling import inner_product, models, recommend, series, vectors
from ..operators import records
from ..operators.aggregates import profile_groups, union_all
from ..session import one_row, spread, staged
from .q_rules_audit import GOLD_SQL, gold
from .registry import register
from .views import table, view, with_views

METRICS = {"mean_absolute_error": 2, "mean_squared_error": 2, "median_absolute_error": 2, "r2_score": 6, "explained_variance": 6}


def rounded(metrics, digits):
    """Adding zero turns a rounded minus zero into zero."""
    return metrics.select(*[(F.round(c, d) + F.lit(0.0)).alias(c) for c, d in digits.items()])


def line_predictions(spark, sf_dir):
    """Every line item with the least-squares price for its quantity."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice")
    line = one_row(li.agg(F.regr_slope("l_extendedprice", "l_quantity").alias("b"), F.regr_intercept("l_extendedprice", "l_quantity").alias("a")))
    return li.withColumn("predicted", line["a"] + line["b"] * F.col("l_quantity"))


LINE_SQL = """
with line as (select regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a from lineitem),
p as (select l.*, a + b * l_quantity as predicted from lineitem l, line),
mu as (select *, avg(l_extendedprice) over () as guess from p)
"""


def _metrics_sql(pred, source="mu"):
    e = f"(l_extendedprice - {pred})"
    return f"""round(avg(abs{e}), 2) + 0.0 as mean_absolute_error, round(avg({e} * {e}), 2) + 0.0 as mean_squared_error,
 round(quantile_disc(abs{e}, 0.5), 2) + 0.0 as median_absolute_error,
 round(1 - avg({e} * {e}) / var_pop(l_extendedprice), 6) + 0.0 as r2_score,
 round(1 - var_pop({e}) / var_pop(l_extendedprice), 6) + 0.0 as explained_variance from {source}"""


@register("eval_regression", LINE_SQL + "select " + _metrics_sql("predicted"))
def eval_regression(spark, sf_dir):
    return rounded(ev.regression_metrics(line_predictions(spark, sf_dir), "l_extendedprice", "predicted"), METRICS)


@register("mean_baseline", LINE_SQL + "select " + _metrics_sql("guess"))
def mean_baseline(spark, sf_dir):
    return rounded(ev.mean_baseline(table(spark, sf_dir, "lineitem"), "l_extendedprice"), METRICS)


@register(
    "scoreboard_union",
    LINE_SQL + "select 'mean' as model, " + _metrics_sql("guess") + " union all select 'line', " + _metrics_sql("predicted"),
)
def scoreboard_union(spark, sf_dir):
    p = line_predictions(spark, sf_dir)
    return union_all(
        [
            rounded(ev.mean_baseline(p, "l_extendedprice"), METRICS).withColumn("model", F.lit("mean")),
            rounded(ev.regression_metrics(p, "l_extendedprice", "predicted"), METRICS).withColumn("model", F.lit("line")),
        ]
    )


@register(
    "worst_predictions",
    LINE_SQL
    + """select l_orderkey, l_linenumber, l_partkey, round(l_extendedprice) as truth, round(predicted) as predicted,
 round(predicted - l_extendedprice) as error from p
order by abs(p.predicted - l_extendedprice) desc, l_orderkey, l_linenumber, l_partkey limit 20""",
)
def worst_predictions(spark, sf_dir):
    worst = ev.worst_predictions(line_predictions(spark, sf_dir), "l_extendedprice", "predicted", 20, ["l_orderkey", "l_linenumber", "l_partkey"])
    return worst.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice").alias("truth"), F.round("predicted").alias("predicted"), F.round("error").alias("error")
    )


@register(
    "residual_outliers",
    with_views(
        "lineitem_dirty",
        f"""
with line as (select regr_slope(price, area_util) as b, regr_intercept(price, area_util) as a from lineitem_dirty where {GOLD_SQL}),
r as (select l_returnflag, price - (a + b * area_total) as residual from lineitem_dirty, line where price is not null),
m as (select l_returnflag, quantile_disc(residual, 0.5) as med from r group by 1),
d as (select l_returnflag, residual, abs(residual - med) as dev from r join m using (l_returnflag)),
s as (select l_returnflag, quantile_disc(dev, 0.5) as mad from d group by 1)
select l_returnflag, count(*) as rows, round(min(0.6745 * dev / mad), 4) as mildest, round(max(residual), 2) as worst
from d join s using (l_returnflag) where 0.6745 * dev / mad > 3.5 group by 1""",
    ),
)
def residual_outliers(spark, sf_dir):
    line = one_row(gold(spark, sf_dir).agg(F.regr_slope("price", "area_util").alias("b"), F.regr_intercept("price", "area_util").alias("a")))
    d = view(spark, sf_dir, "lineitem_dirty").select("l_returnflag", "price", (line["a"] + line["b"] * F.col("area_total")).alias("predicted"))
    odd = ev.residual_outliers(d, "price", "predicted", "l_returnflag")
    return odd.groupBy("l_returnflag").agg(
        F.count("*").alias("rows"), F.round(F.min("robust_z"), 4).alias("mildest"), F.round(F.max("residual"), 2).alias("worst")
    )


# --- odd rows that are records entered twice -------------------------------------

RECORD_KEYS = {"buyer and day": ["buyer", "day"], "price and day": ["price", "day"]}
RECORD_SQL = with_views(
    "orders_copied",
    """
with p as (select x.id as a, y.id as b from orders_copied x join orders_copied y on x.buyer = y.buyer and x.day = y.day
 union select x.id, y.id from orders_copied x join orders_copied y on x.price = y.price and x.day = y.day),
reach as (select id, id as other from orders_copied union select r.id, p.b from reach r join p on r.other = p.a),
flagged as (select o.*, f.record_id, f.copies from orders_copied o
 join (select id, min(other) as record_id, count(*) as copies from reach group by 1) f using (id)),
""",
).replace("with ", "with recursive ", 1)
ODD_SQL = """m as (select priority, avg(price) as predicted from flagged group by 1),
r as (select f.*, price - predicted as residual from flagged f join m using (priority)),
c as (select priority, quantile_disc(residual, 0.5) as med from r group by 1),
d as (select r.*, abs(residual - med) as dev from r join c using (priority)),
s as (select priority, quantile_disc(dev, 0.5) as mad from d group by 1),
odd as (select d.*, 0.6745 * dev / mad as z from d join s using (priority) where 0.6745 * dev / mad > 3.5)
"""


def _priced(spark, sf_dir):
    """Every order and its planted copies, with the mean price of its priority as the answer."""
    rows = view(spark, sf_dir, "orders_copied", heavy=True)
    means = rows.groupBy("priority").agg(F.avg("price").alias("predicted"))
    return rows.join(means, "priority")


@register("same_records", RECORD_SQL.rstrip().rstrip(",") + "\nselect id, record_id, copies from flagged")
def same_records(spark, sf_dir):
    return records.same_records(view(spark, sf_dir, "orders_copied", heavy=True), "id", RECORD_KEYS).select("id", "record_id", "copies")


@register("residual_causes", RECORD_SQL + ODD_SQL + "select id, record_id, copies, round(z, 3) as z from odd")
def residual_causes(spark, sf_dir):
    odd = ev.residual_causes(_priced(spark, sf_dir), "price", "predicted", "priority", "id", RECORD_KEYS)
    return odd.select("id", "record_id", "copies", F.round("robust_z", 3).alias("z"))


@register(
    "outliers_by_copies",
    RECORD_SQL
    + ODD_SQL
    + """, n as (select copies > 1 as repeated, count(*) as rows from flagged group by 1),
k as (select copies > 1 as repeated, count(*) as outliers from odd group by 1)
select repeated, rows, coalesce(outliers, 0) as outliers, round(coalesce(outliers, 0) / rows, 6) as share from n left join k using (repeated)""",
)
def outliers_by_copies(spark, sf_dir):
    flagged = staged(records.same_records(_priced(spark, sf_dir), "id", RECORD_KEYS), "records")
    odd = ev.residual_outliers(flagged, "price", "predicted", "priority")
    return ev.outliers_by_copies(flagged, odd, "id").withColumn("share", F.round("share", 6))


# --- classification ----------------------------------------------------------


def rule_scores(spark, sf_dir):
    """A rule for text quality: longer texts are likelier to be good."""
    d = view(spark, sf_dir, "label_text").select("doc_id", "lang", (F.col("quality") == 1).alias("truth"), "n_chars")
    score = F.col("n_chars") / (F.col("n_chars") + 400.0)
    d = d.withColumn("score", score).withColumn("predicted", F.col("score") >= 0.5)
    probs = F.array(
        F.struct(F.lit(False).alias("label"), (1 - F.col("score")).alias("prob")), F.struct(F.lit(True).alias("label"), F.col("score").alias("prob"))
    )
    return d.withColumn("predicted_probs", probs)


RULE_SQL = """
with s as (select doc_id, lang, quality = 1 as truth, n_chars, n_chars / (n_chars + 400.0) as score,
 n_chars / (n_chars + 400.0) >= 0.5 as predicted from label_text),
c as (select *, least(greatest(score, 1e-15), 1 - 1e-15) as q from s),
k as (select score, count(*) filter (where truth) as pos, count(*) filter (where not truth) as neg from s group by 1),
b as (select pos, neg, coalesce(sum(neg) over (order by score rows between unbounded preceding and 1 preceding), 0) as below from k),
auc as (select sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) as roc_auc from b)
"""


@register(
    "rule_classifier_metrics",
    with_views(
        "label_text",
        RULE_SQL
        + """
select round(count(*) filter (where truth and predicted) / count(*) filter (where predicted), 6) as "precision",
 round(count(*) filter (where truth and predicted) / count(*) filter (where truth), 6) as recall,
 round(count(*) filter (where truth = predicted) / count(*), 6) as accuracy,
 round(2.0 * count(*) filter (where truth and predicted) / (count(*) filter (where truth) + count(*) filter (where predicted)), 6) as f1_score,
 round(-avg(case when truth then ln(q) else ln(1 - q) end), 6) as log_loss, round(max(roc_auc), 6) as roc_auc from c, auc""",
    ),
)
def rule_classifier_metrics(spark, sf_dir):
    m = ev.classification_metrics(rule_scores(spark, sf_dir), F.col("truth"), F.col("predicted"), F.col("score"))
    return rounded(m, dict.fromkeys(ev.CLASSIFICATION, 6))


@register(
    "confusion_matrix",
    with_views(
        "label_text",
        RULE_SQL
        + """select cast(truth as varchar) as expected_label, count(*) filter (where not predicted) as predicted_false,
 count(*) filter (where predicted) as predicted_true from s group by 1""",
    ),
)
def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(rule_scores(spark, sf_dir), "truth", "predicted", [False, True])


@register(
    "threshold_override",
    with_views(
        "label_text",
        RULE_SQL
        + """select cast(truth as varchar) as expected_label, count(*) filter (where score < 0.3) as predicted_false,
 count(*) filter (where score >= 0.3) as predicted_true from s group by 1""",
    ),
)
def threshold_override(spark, sf_dir):
    lower = rule_scores(spark, sf_dir).withColumn("predicted", F.col("predicted_probs")[1]["prob"] >= 0.3)
    return ev.confusion_matrix(lower, "truth", "predicted", [False, True])


@register(
    "majority_baseline",
    """
select quality as majority, count(*) as n, round(100.0 * count(*) / (select count(*) from labels), 1) as accuracy_pct
from labels group by 1 order by n desc limit 1""",
)
def majority_baseline(spark, sf_dir):
    return ev.majority_baseline(table(spark, sf_dir, "labels"), "quality")


@register(
    "confident_errors",
    with_views(
        "label_text",
        RULE_SQL
        + """select doc_id, lang, truth, predicted, round(case when predicted then score else 1 - score end, 4) as confidence from s
where truth <> predicted order by case when predicted then score else 1 - score end desc, doc_id limit 15""",
    ),
)
def confident_errors(spark, sf_dir):
    wrong = ev.confident_errors(rule_scores(spark, sf_dir), "truth", "predicted", "predicted_probs", 15, ["doc_id"])
    return wrong.select("doc_id", "lang", "truth", "predicted", F.round("confidence", 4).alias("confidence"))


@register(
    "label_noise",
    with_views(
        "part_titles",
        f"""
with d as (select p_partkey, p_brand, title, regexp_matches(lower(title), '{COMMERCIAL}') as truth from part_titles),
g as (select p_brand, avg(cast(truth as int)) as rate from d group by 1),
s as (select *, rate >= 0.5 as predicted, greatest(rate, 1 - rate) as confidence from d join g using (p_brand))
select p_partkey, title, truth, round(confidence, 4) as confidence from s where truth <> predicted
order by s.confidence desc, p_partkey limit 25""",
    ),
)
def label_noise(spark, sf_dir):
    """Labels a rule made from the title, doubted by a model that never saw the title."""
    d = view(spark, sf_dir, "part_titles").withColumn("truth", scalars.contains("title", COMMERCIAL))
    rates = d.groupBy("p_brand").agg(F.avg(F.col("truth").cast("int")).alias("rate"))
    scored = d.join(rates, "p_brand").withColumn("predicted", F.col("rate") >= 0.5)
    probs = F.array(F.struct(F.lit(False).alias("label"), (1 - F.col("rate")).alias("prob")), F.struct(F.lit(True).alias("label"), F.col("rate").alias("prob")))
    found = ev.confident_errors(scored.withColumn("probs", probs), "truth", "predicted", "probs", 25, ["p_partkey"])
    return found.select("p_partkey", "title", "truth", F.round("confidence", 4).alias("confidence"))


@register(
    "class_weights",
    """
select quality, count(*) as n, (select count(*) from labels) / ((select count(distinct quality) from labels) * count(*)) as weight
from labels group by 1""",
)
def class_weights(spark, sf_dir):
    return ev.class_weights(table(spark, sf_dir, "labels"), "quality")


# --- segments ----------------------------------------------------------------

# Fixed centroids on (quantity / 50, price / 100000), so that SQL can assign too.
CENTROIDS = {1: (0.2, 0.25), 2: (0.8, 0.25), 3: (0.2, 0.8), 4: (0.8, 0.8), 5: (1.6, 1.6)}


def assigned(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") / 50).alias("q"), (F.col("l_extendedprice") / 100000).alias("p"), "l_quantity", "l_extendedprice", "l_returnflag"
    )
    near = F.array_min(
        F.array(*[F.struct(((F.col("q") - x) * (F.col("q") - x) + (F.col("p") - y) * (F.col("p") - y)).alias("d"), F.lit(i).alias("i")) for i, (x, y) in CENTROIDS.items()])
    )
    return li.withColumn("CENTROID_ID", near["i"])


def _assigned_sql():
    d = {i: f"(q - {x}) * (q - {x}) + (p - {y}) * (p - {y})" for i, (x, y) in CENTROIDS.items()}
    least = f"least({', '.join(d.values())})"
    pick = " ".join(f"when {v} = {least} then {i}" for i, v in d.items())
    return f"""
with n as (select l_quantity / 50 as q, l_extendedprice / 100000 as p, l_quantity, l_extendedprice, l_returnflag from lineitem),
s as (select *, case {pick} end as "CENTROID_ID" from n)
"""


@register(
    "segment_cards",
    _assigned_sql()
    + """
select "CENTROID_ID", count(*) as rows, quantile_disc(l_extendedprice, 0.5) as median_price, round(avg(l_quantity), 4) as mean_quantity,
 round(100 * avg(cast(l_returnflag = 'R' as int)), 4) as pct_returned from s group by 1""",
)
def segment_cards(spark, sf_dir):
    d = assigned(spark, sf_dir).withColumn("returned", F.col("l_returnflag") == "R")
    return profile_groups(d, "CENTROID_ID", {"median_price": "l_extendedprice"}, {"mean_quantity": "l_quantity"}, {"pct_returned": "returned"})


@register(
    "davies_bouldin_fixed",
    _assigned_sql()
    + """,
c as (select "CENTROID_ID" as k, avg(q) as cq, avg(p) as cp from s group by 1),
w as (select k, any_value(cq) as cq, any_value(cp) as cp, avg(sqrt((q - cq) ** 2 + (p - cp) ** 2)) as spread from s join c on k = "CENTROID_ID" group by 1),
r as (select a.k, max((a.spread + b.spread) / sqrt((a.cq - b.cq) ** 2 + (a.cp - b.cp) ** 2)) as worst from w a join w b on a.k <> b.k group by 1)
select round(avg(worst), 6) as davies_bouldin_index from r""",
)
def davies_bouldin_fixed(spark, sf_dir):
    index = ev.davies_bouldin(assigned(spark, sf_dir), ["q", "p"], "CENTROID_ID")
    return spark.createDataFrame([(round(index, 6),)], "davies_bouldin_index double")


@register(
    "small_segment",
    _assigned_sql()
    + """
select "CENTROID_ID", count(*) as rows, round(100 * (count(*) / sum(count(*)) over ()), 3) as pct,
 count(*) / sum(count(*)) over () < 0.25 as too_small from s group by 1""",
)
def small_segment(spark, sf_dir):
    return ev.small_segments(assigned(spark, sf_dir), "CENTROID_ID", 0.25)


# --- neighbours, series, recommendation --------------------------------------


@register(
    "vector_topk",
    """
select * from (select a.vec_id as query, b.vec_id as neighbour,
 round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) as similarity,
 row_number() over (partition by a.vec_id order by list_cosine_similarity(a.embedding::double[], b.embedding::double[]) desc, b.vec_id) as rank
 from embeddings a join embeddings b on a.vec_id <> b.vec_id) where rank <= 5""",
)
def vector_topk(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    found = vectors.vector_search(spread(e), e, 5, "vec_id", "embedding", "vec_id", "embedding", skip_self=True, broadcast_bytes=0)
    return found.withColumn("similarity", F.round("similarity", 6))


@register("vector_lsh", "select 5 * count(*) as neighbours, true as enough, 0::bigint as differing from embeddings")
def vector_lsh(spark, sf_dir):
    """Neighbours from locality-sensitive buckets: nine tenths of the exact ones at least, with their exact similarities."""
    e = table(spark, sf_dir, "embeddings")
    names = ("vec_id", "embedding", "vec_id", "embedding")
    exact = staged(vectors.vector_search(e, e, 5, *names, skip_self=True, broadcast_bytes=0), "exact")
    found = staged(vectors.lsh_search(e, e, 5, *names, skip_self=True, tables=16, planes=5, probes=3), "found")
    both = exact.join(found.select("query", "neighbour", F.col("similarity").alias("s")), ["query", "neighbour"])
    differing = both.agg(F.count_if(F.abs(F.col("s") - F.col("similarity")) > 1e-9)).scalar()
    return vectors.recall(found, exact).select("neighbours", (F.col("recall") >= 0.9).alias("enough"), differing.alias("differing"))


# Whole numbers, so that products are exact; lengths differ, so that the bound stops early.
SIZED_SQL = "select vec_id, [round(1000 * x::double) * (1 + vec_id % 7) ** 3 for x in embedding] as v from embeddings"


def _sized(spark, sf_dir):
    size = F.pow(1 + F.col("vec_id") % 7, F.lit(3))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.round(1000 * x.cast("double")) * size).alias("v"))


@register(
    "inner_product_topk",
    f"""
with s as ({SIZED_SQL}), p as (select a.vec_id as query, b.vec_id as neighbour, list_inner_product(a.v, b.v)::bigint as product from s a, s b),
r as (select *, row_number() over (partition by query order by product desc, neighbour) as rank from p)
select query, neighbour, product, rank from r where rank <= 5""",
)
def inner_product_topk(spark, sf_dir):
    """The five largest inner products of every vector, in four slabs by length."""
    e = staged(_sized(spark, sf_dir), "sized")
    quarter = max(1, e.count() * 64 * 8 // 4)
    found = inner_product.top_products(e, spread(e), 5, "vec_id", "v", "vec_id", "v", slab_bytes=quarter)
    return found.select("query", "neighbour", F.col("product").cast("long").alias("product"), "rank")


@register("inner_product_cost", "select count(*) as queries, count(*) * count(*) as pairs, true as fewer from embeddings")
def inner_product_cost(spark, sf_dir):
    """How many of all pairs the bound leaves to score: fewer than nine tenths."""
    e = staged(_sized(spark, sf_dir), "sized")
    found = inner_product.top_products(e, spread(e), 5, "vec_id", "v", "vec_id", "v")
    each = found.where("rank = 1").agg(F.count("*").alias("queries"), F.sum("scored").alias("scored"))
    pairs = F.col("queries") * F.col("queries")
    return each.select("queries", pairs.alias("pairs"), (F.col("scored") < 0.9 * pairs).alias("fewer"))


@register(
    "monthly_series",
    """
select o_orderpriority, cast(date_trunc('month', o_orderdate) as date) as month, round(avg(o_totalprice), 4) as value, count(*) as rows
from orders group by 1, 2""",
)
def monthly_series(spark, sf_dir):
    m = series.monthly(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", ["o_orderpriority"])
    return m.withColumn("value", F.round("value", 4))


SERIES_SQL = """
with m as (select o_orderpriority, cast(date_trunc('month', o_orderdate) as date) as month, avg(o_totalprice) as value from orders group by 1, 2)
"""


@register(
    "ar_lag_features",
    SERIES_SQL
    + """select m.o_orderpriority, m.month, round(m.value, 4) as value, round(a.value, 4) as lag_1, round(b.value, 4) as lag_12 from m
 left join m a on a.o_orderpriority = m.o_orderpriority and a.month + interval 1 month = m.month
 left join m b on b.o_orderpriority = m.o_orderpriority and b.month + interval 12 month = m.month""",
)
def ar_lag_features(spark, sf_dir):
    m = series.with_lags(series.monthly(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", ["o_orderpriority"]), ["o_orderpriority"])
    return m.select("o_orderpriority", "month", *[F.round(c, 4).alias(c) for c in ("value", "lag_1", "lag_12")])


@register(
    "ar_forecast",
    SERIES_SQL
    + """,
c as (select *, avg(value) over (partition by o_orderpriority) as level,
 avg(value) over (partition by o_orderpriority, extract(month from month)) - avg(value) over (partition by o_orderpriority) as season from m),
r as (select *, value - level - season as rest from c),
b as (select r.*, p.rest as before from r left join r p on p.o_orderpriority = r.o_orderpriority and p.month + interval 1 month = r.month),
f as (select o_orderpriority, count(*) as n, max(month) as last_month, max(level) as level, regr_slope(rest, before) as phi,
 arg_max(rest, month) as last_rest from b group by 1 having count(*) >= 24),
h as (select f.*, step, cast(last_month + to_months(cast(step as int)) as date) as next from f, range(1, 7) t(step)),
s as (select o_orderpriority, extract(month from month) as moy, max(season) as season from c group by 1, 2)
select h.o_orderpriority, cast(step as int) as step, next as month, round(level + coalesce(season, 0) + last_rest * pow(phi, step), 3) as forecast
from h left join s on s.o_orderpriority = h.o_orderpriority and s.moy = extract(month from next)""",
)
def ar_forecast(spark, sf_dir):
    m = series.monthly(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", ["o_orderpriority"])
    f = series.forecast(series.fit(m, ["o_orderpriority"]), ["o_orderpriority"], 6)
    return f.withColumn("forecast", F.round("forecast", 3))


@register("recommend_als")
def recommend_als(spark, sf_dir):
    found = recommend.factorize(table(spark, sf_dir, "events"), "user_id", "event_type", "value")
    return found.top(3).withColumn("score", F.round("score", 3))


@register(
    "dense_index",
    """
select count(distinct user_id) as users, 0::int as lowest, cast(count(distinct user_id) - 1 as int) as highest,
 count(distinct user_id) as numbers from events""",
)
def dense_index(spark, sf_dir):
    i = recommend.dense_index(table(spark, sf_dir, "events"), "user_id", "n")
    return i.agg(F.count("*").alias("users"), F.min("n").alias("lowest"), F.max("n").alias("highest"), F.count_distinct("n").alias("numbers"))


# --- trained models that SQL can repeat --------------------------------------


def _pairs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity")


@register(
    "train_linear",
    """
with l as (select regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a from lineitem),
x as (select avg(l_quantity) as mx from lineitem)
select round(any_value(b), 4) as slope, round(any_value(a), 4) as intercept, round(avg(abs(l_extendedprice - (a + b * l_quantity))), 3) as mae,
 round(1 - avg((l_extendedprice - (a + b * l_quantity)) ** 2) / var_pop(l_extendedprice), 6) as r2,
 round(any_value(abs(b)) * avg(abs(l_quantity - mx)), 3) as attribution from lineitem, l, x""",
)
def train_linear(spark, sf_dir):
    m = models.train(_pairs(spark, sf_dir), "LINEAR_REG", "l_extendedprice", split_method="NONE", global_explain=True)
    fitted = m.pipeline.stages[-1]
    row = (
        round(float(fitted.coefficients[0]), 4),
        round(float(fitted.intercept), 4),
        round(m.metrics["mean_absolute_error"], 3),
        round(m.metrics["r2_score"], 6),
        round(dict(m.attribution)["l_quantity"], 3),
    )
    return spark.createDataFrame([row], "slope double, intercept double, mae double, r2 double, attribution double")


@register(
    "predict_linear",
    LINE_SQL + "select l_orderkey, l_linenumber, l_partkey, l_quantity, round(predicted, 2) as predicted_l_extendedprice from p",
)
def predict_linear(spark, sf_dir):
    m = models.train(_pairs(spark, sf_dir), "LINEAR_REG", "l_extendedprice", split_method="NONE")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return models.predict(m, rows).withColumn("predicted_l_extendedprice", F.round("predicted_l_extendedprice", 2))


@register(
    "score_invented_item",
    """
select 30.0::double as l_quantity, round(regr_intercept(l_extendedprice, l_quantity) + 30 * regr_slope(l_extendedprice, l_quantity), 2) as estimate
from lineitem""",
)
def score_invented_item(spark, sf_dir):
    m = models.train(_pairs(spark, sf_dir), "LINEAR_REG", "l_extendedprice", split_method="NONE")
    item = spark.range(1).select(F.lit(30.0).alias("l_quantity"))
    return models.predict(m, item).select("l_quantity", F.round("predicted_l_extendedprice", 2).alias("estimate"))


@register(
    "segment_only_run",
    """
select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) as slope, count(*) as rows from lineitem where l_returnflag = 'R' group by 1""",
)
def segment_only_run(spark, sf_dir):
    only = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    m = models.train(only.select("l_extendedprice", "l_quantity"), "LINEAR_REG", "l_extendedprice", split_method="NONE")
    slope = round(float(m.pipeline.stages[-1].coefficients[0]), 4)
    return only.groupBy("l_returnflag").agg(F.lit(slope).alias("slope"), F.count("*").alias("rows"))


@register("pca")
def pca(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    m = models.train(e.select("embedding"), "PCA", num_components=3)
    return models.predict(m, e).select("vec_id", F.transform("principal_components", lambda v: F.round(v, 4)).alias("principal_components"))


