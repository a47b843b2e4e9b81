"""What SQL can say exactly about models, splits and odd rows: closed forms and statements about every row.

Linear fits have sums of squares, one yes/no feature has group means and rates, and
components of two columns follow from their covariance.
"""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..modelling import evaluate as ev
from ..modelling import arima, label_noise, models, search, series, target_encoding, vectors
from ..modelling import scoreboard as sb
from ..modelling.split import in_test
from ..operators import audit, quantiles, rules
from ..operators.leakage import Feature
from ..session import one_row, staged
from ..sources import json_paths
from .registry import register
from .views import decimal_round, table

# --- linear models over two columns -------------------------------------------

TWO = "(select l_extendedprice as y, l_quantity as a, l_tax * 100 + l_quantity / 10 as b from lineitem)"
R2_BOTH = """(power(corr(y, a), 2) + power(corr(y, b), 2) - 2 * corr(y, a) * corr(y, b) * corr(a, b)) / (1 - power(corr(a, b), 2))"""


def _two(spark, sf_dir):
    return table(spark, sf_dir, "lineitem", heavy=True).select(
        F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("a"), (F.col("l_tax") * 100 + F.col("l_quantity") / 10).alias("b")
    )


def _r2(board):
    return board.where("metric = 'r2_score'").select("model", F.round("value", 6).alias("r2"))


@register(
    "ablation_closed_form",
    f"""
select 'baseline' as model, 0.0::double as r2 from {TWO} having count(*) > 0
union all select 'all', round({R2_BOTH}, 6) from {TWO}
union all select 'without_a', round(regr_r2(y, b), 6) from {TWO}
union all select 'without_b', round(regr_r2(y, a), 6) from {TWO}""",
)
def ablation_closed_form(spark, sf_dir):
    return _r2(sb.ablate(_two(spark, sf_dir), "y", "LINEAR_REG", {"a": ["a"], "b": ["b"]}, split_method="NONE"))


@register(
    "seed_spread_closed_form",
    f"select 'r2_score' as metric, 2::bigint as runs, round({R2_BOTH}, 6) as low, round({R2_BOTH}, 6) as high from {TWO}",
)
def seed_spread_closed_form(spark, sf_dir):
    """A fit without chance has no spread, and its figure is known."""
    found = sb.seed_spread(_two(spark, sf_dir), "y", "LINEAR_REG", [1, 2], split_method="NONE")
    return found.where("metric = 'r2_score'").select("metric", "runs", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


GROUPED = "(select l_extendedprice * (1 - l_discount) as net, l_discount > 0.05 as cheap from lineitem)"


@register(
    "model_search_closed_form",
    f"""
with m as (select avg(net) as mean, var_pop(net) as total from {GROUPED}),
g as (select cheap, count(*) as n, avg(net) as mean from {GROUPED} group by 1),
r as (select sum(g.n * power(g.mean - m.mean, 2)) / sum(g.n) / any_value(m.total) as r2 from g, m)
select model, round(case when model = 'baseline' then 0 else r2 end, 6) as r2
from r, (values ('baseline'), ('LINEAR_REG'), ('BOOSTED_TREE_REGRESSOR'), ('RANDOM_FOREST_REGRESSOR')) v(model)""",
)
def model_search_closed_form(spark, sf_dir):
    """With one yes/no feature every type can only learn the two group means."""
    d = table(spark, sf_dir, "lineitem", heavy=True)
    d = d.select((F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), (F.col("l_discount") > 0.05).alias("cheap"))
    stump = {"max_tree_depth": 1}
    options = {
        "BOOSTED_TREE_REGRESSOR": {**stump, "max_iterations": 1, "subsample": 1.0},
        "RANDOM_FOREST_REGRESSOR": {**stump, "num_trees": 1, "bootstrap": False},
    }
    return _r2(sb.model_search(d, "net", ["LINEAR_REG", *options], split_method="NONE", **options))


# --- preprocessing --------------------------------------------------------------


@register(
    "category_means",
    """
with d as (select case when l_linenumber = 3 then null else l_returnflag end as flag, l_quantity from lineitem)
select flag, count(*) as rows, round(avg(l_quantity), 3) as predicted from d group by 1""",
)
def category_means(spark, sf_dir):
    """One slot per category, missing ones their own: a linear fit answers with the mean of each."""
    d = table(spark, sf_dir, "lineitem", heavy=True)
    d = d.select(F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("flag"), "l_quantity")
    m = models.train(d, "LINEAR_REG", "l_quantity", split_method="NONE")
    out = models.predict(m, d).groupBy("flag")
    return out.agg(F.count("*").alias("rows"), F.round(F.avg("predicted_l_quantity"), 3).alias("predicted"))


IMPUTED = """(select l_extendedprice as y, coalesce(x, (select avg(case when l_orderkey % 7 <> 0 then l_quantity end) from lineitem)) as x
 from (select l_extendedprice, case when l_orderkey % 7 <> 0 then l_quantity end as x from lineitem))"""


@register("missing_numbers_mean", f"select round(regr_slope(y, x), 3) as slope, round(regr_intercept(y, x), 1) as intercept, count(*) as rows from {IMPUTED}")
def missing_numbers_mean(spark, sf_dir):
    """Missing numbers count as the column's mean."""
    d = table(spark, sf_dir, "lineitem", heavy=True)
    d = d.select("l_extendedprice", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("x"))
    fitted = models.train(d, "LINEAR_REG", "l_extendedprice", split_method="NONE").pipeline.stages[-1]
    figures = [F.lit(round(float(fitted.coefficients[0]), 3)).alias("slope"), F.lit(round(float(fitted.intercept), 1)).alias("intercept")]
    return d.agg(*[F.first(f).alias(n) for f, n in zip(figures, ("slope", "intercept"))], F.count("*").alias("rows"))


@register(
    "wide_category_hashed",
    """
select 'l_partkey' as feature, 1024 as slots, count(*) as rows, count(distinct l_partkey) > 1000 as wide from lineitem""",
)
def wide_category_hashed(spark, sf_dir):
    """A column of many categories is hashed because it was named, not because of their number."""
    d = table(spark, sf_dir, "lineitem", heavy=True).select(F.col("l_partkey").cast("string").alias("l_partkey"), "l_quantity")
    m = models.train(d, "LINEAR_REG", "l_quantity", split_method="NONE", encoding={"l_partkey": "hash"}, l2_reg=0.1)
    name, slots = m.slots[0]
    wide = (F.count_distinct("l_partkey") > 1000).alias("wide")
    return d.agg(F.first(F.lit(name)).alias("feature"), F.first(F.lit(slots)).alias("slots"), F.count("*").alias("rows"), wide)


@register(
    "medians_in_own_types",
    """
select l_returnflag as flag, quantile_disc(l_orderkey * 1000003 + 9007199254740993, 0.5) as wide, quantile_disc(cast(l_shipdate as date), 0.5) as day,
 quantile_disc(cast(l_extendedprice as decimal(30, 2)), 0.5) as price, quantile_disc(l_quantity, 0.5) as quantity
from lineitem group by 1""",
)
def medians_in_own_types(spark, sf_dir):
    """Whole numbers that doubles cannot hold, dates, decimals and doubles, together."""
    d = table(spark, sf_dir, "lineitem", heavy=True).select(
        F.col("l_returnflag").alias("flag"), (F.col("l_orderkey") * 1000003 + 9007199254740993).alias("wide"), F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_extendedprice").cast("decimal(30,2)").alias("price"), F.col("l_quantity").alias("quantity"),
    )
    return quantiles.exact_columns(d, {c: c for c in ("wide", "day", "price", "quantity")}, 0.5, by=["flag"])


FOLD_SQL = """
with d as (select cast(l_partkey as varchar) as value, l_orderkey % 5 as f, l_quantity as y from lineitem),
g as (select f.f, avg(d.y) as m from (select distinct f from d) f join d on d.f <> f.f group by 1),
c as (select value, f, count(*) as n, sum(y) as s from d group by 1, 2),
t as (select value, sum(n) as n, sum(s) as s from c group by 1),
e as (select c.value, c.f, (t.s - c.s + 10 * m) / (t.n - c.n + 10) as mean from c join t using (value) join g using (f))
"""


@register(
    "target_means_by_fold",
    FOLD_SQL + "select d.value, d.f as fold, count(*) as rows, round(avg(e.mean), 6) as mean, round(sum(d.y), 2) as total from d join e using (value, f) group by 1, 2",
)
def target_means_by_fold(spark, sf_dir):
    """What every training row of a wide category is given: the mean over the other folds."""
    d = table(spark, sf_dir, "lineitem", heavy=True).select("l_partkey", "l_quantity", (F.col("l_orderkey") % 5).alias("fold"))
    means = staged(target_encoding.target_means(d, "l_partkey", [F.col("l_quantity")], F.col("fold"), 5, 10.0), "means")
    rows = target_encoding.encoded(d, "l_partkey", means, [0.0], F.col("fold"))
    out = rows.groupBy(F.col("l_partkey").cast("string").alias("value"), "fold")
    mean = F.round(F.avg(vector_to_array("_t_l_partkey")[0]), 6)
    return out.agg(F.count("*").alias("rows"), mean.alias("mean"), F.round(F.sum("l_quantity"), 2).alias("total"))


WIDE_SQL = """
with d as (select l_orderkey // 3 as k, l_returnflag = 'R' as y from lineitem), g as (select avg(cast(y as int)) as m from d),
v as (select k, (sum(cast(y as int)) + 10 * m) / (count(*) + 10) as mean, count(*) as n from d, g group by k, m)
select cast(k as varchar) as value, n as rows, round(mean, 6) as mean from v
"""


@register("target_means_of_model", WIDE_SQL)
def target_means_of_model(spark, sf_dir):
    """A boosted classifier over a category with more values than any tree could have bins; the means it predicts with."""
    d = table(spark, sf_dir, "lineitem", heavy=True)
    d = d.select(F.floor(F.col("l_orderkey") / 3).cast("string").alias("k"), (F.col("l_returnflag") == "R").alias("y"))
    m = models.train(d, "BOOSTED_TREE_CLASSIFIER", "y", split_method="NONE", encoding={"k": "target"}, max_iterations=2, max_tree_depth=2)
    return m.means["k"].select("value", "rows", F.round(F.get("means", F.lit(0)), 6).alias("mean"))


# --- classifiers with one yes/no feature ------------------------------------------

RATE = """
with d as (select l_discount > 0.05 as cheap, l_extendedprice * (1 - l_discount) > 30000 as dear from lineitem),
g as (select cheap, avg(cast(dear as int)) as rate from d group by 1),
s as (select d.dear, g.rate from d join g on g.cheap = d.cheap)
"""


def _dear(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem", heavy=True)
    return d.select((F.col("l_discount") > 0.05).alias("cheap"), (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 30000).alias("dear"))


@register(
    "confusion_closed_form",
    RATE
    + """select cast(dear as varchar) as expected_label, count(*) filter (where rate < 0.5) as predicted_false,
 count(*) filter (where rate >= 0.5) as predicted_true from s group by 1""",
)
def confusion_closed_form(spark, sf_dir):
    d = _dear(spark, sf_dir)
    return models.confusion(models.train(d, "LOGISTIC_REG", "dear", split_method="NONE"), d)


@register(
    "threshold_predict",
    RATE
    + """, t as (select (max(rate) + min(rate)) / 2 as cut from g)
select rate >= cut as predicted_dear, count(*) as rows, count(*) filter (where dear) as dear from s, t group by 1""",
)
def threshold_predict(spark, sf_dir):
    """A cut between the two groups' probabilities, moved by ``predict`` itself."""
    d = _dear(spark, sf_dir)
    m = models.train(d, "LOGISTIC_REG", "dear", split_method="NONE")
    rates = [r.rate for r in d.groupBy("cheap").agg(F.avg(F.col("dear").cast("int")).alias("rate")).collect()]
    out = models.predict(m, d, threshold=(max(rates) + min(rates)) / 2)
    return out.groupBy("predicted_dear").agg(F.count("*").alias("rows"), F.count_if("dear").alias("dear"))


@register(
    "probabilities_per_row",
    RATE + "select round(rate, 3) as yes, round(1 - rate, 3) as no, count(*) as rows from s group by rate",
)
def probabilities_per_row(spark, sf_dir):
    """Both probabilities of every row add up to one and are the rates of its group."""
    d = _dear(spark, sf_dir)
    probs = models.predict(models.train(d, "LOGISTIC_REG", "dear", split_method="NONE"), d).select("predicted_dear_probs")
    of = lambda v: F.round(F.filter("predicted_dear_probs", lambda p: p["label"] == F.lit(v))[0]["prob"], 3)
    return probs.groupBy(of(True).alias("yes"), of(False).alias("no")).agg(F.count("*").alias("rows"))


# --- components ---------------------------------------------------------------------


@register(
    "pca_plane",
    """
with d as (select l_quantity / 50 as a, l_quantity / 100 + l_extendedprice / 100000 as b from lineitem),
c as (select var_samp(a) as aa, var_samp(b) as bb, covar_samp(a, b) as ab from d)
select round((aa + bb) / 2 + sqrt(power((aa - bb) / 2, 2) + ab * ab), 6) as first,
 round((aa + bb) / 2 - sqrt(power((aa - bb) / 2, 2) + ab * ab), 6) as second, 0.0::double as together from c""",
)
def pca_plane(spark, sf_dir):
    """Variances along the two components are the eigenvalues of the covariance, and they do not vary together."""
    d = table(spark, sf_dir, "lineitem", heavy=True)
    d = d.select((F.col("l_quantity") / 50).alias("a"), (F.col("l_quantity") / 100 + F.col("l_extendedprice") / 100000).alias("b"))
    m = models.train(d, "PCA", num_components=2)
    c = models.predict(m, d).select(*[F.col("principal_components")[i].alias(f"c{i}") for i in range(2)])
    return c.agg(
        F.round(F.var_samp("c0"), 6).alias("first"), F.round(F.var_samp("c1"), 6).alias("second"),
        F.abs(F.round(F.covar_samp("c0", "c1"), 6)).alias("together"),
    )


# --- the split that training uses ---------------------------------------------------


@register(
    "split_training",
    """
with k as (select l_orderkey, l_linenumber, l_partkey, count(*) as n from (select l_orderkey % 50 as l_orderkey, l_linenumber, l_partkey % 20 as l_partkey
 from lineitem) group by all)
select sum(n)::bigint as rows, count(*) as different_rows, 0::bigint as torn, true as near_a_fifth from k""",
)
def split_training(spark, sf_dir):
    """Equal rows fall on one side of the cut that ``train`` makes, and about a fifth of them is held out."""
    d = table(spark, sf_dir, "lineitem", heavy=True)
    d = d.select((F.col("l_orderkey") % 50).alias("l_orderkey"), "l_linenumber", (F.col("l_partkey") % 20).alias("l_partkey"))
    sides = d.withColumn("held", in_test(d)).groupBy(*d.columns).agg(F.count("*").alias("n"), F.count_if("held").alias("held"))
    return sides.agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("different_rows"),
        F.count_if((F.col("held") > 0) & (F.col("held") < F.col("n"))).alias("torn"),
        F.avg((F.col("held") > 0).cast("int")).between(0.17, 0.23).alias("near_a_fifth"),
    )


@register(
    "columns_left_out",
    """
select 'city' as "column", 'one value' as reason, count(*) as rows, 14 as columns_kept from lineitem
union all select 'l_comment_key', 'names the row', count(*), 14 from lineitem""",
)
def columns_left_out(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem")
    kept = len(d.columns)
    d = d.withColumns({"city": F.lit("A"), "l_comment_key": F.col("l_orderkey"), **{f"x{i}": F.lit(i) for i in range(14 - kept)}})
    left, report = rules.drop_columns(d, {"city": "one value", "l_comment_key": "names the row"})
    rows = one_row(left.agg(F.count("*").alias("n")))["n"]
    return report.withColumns({"rows": rows, "columns_kept": F.lit(len(left.columns))})


# --- odd types and missing values -----------------------------------------------------


@register(
    "quantile_types",
    """
with d as (select case when l_returnflag = 'A' then null else l_returnflag end as flag, 1152921504606846976 + l_orderkey * 7 + l_linenumber as big,
 cast(l_extendedprice as decimal(20, 4)) * 1000000007 as exact, cast(l_shipdate as date) as day from lineitem)
select flag, quantile_disc(big, 0.5) as big, cast(quantile_disc(exact, 0.5) as varchar) as exact, quantile_disc(day, 0.5) as day from d group by 1""",
)
def quantile_types(spark, sf_dir):
    """Medians of integers beyond 2^53, of decimals and of days, also of the rows without a group."""
    d = table(spark, sf_dir, "lineitem", heavy=True)
    d = d.select(
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("flag"),
        (F.lit(1152921504606846976) + F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("big"),
        (F.col("l_extendedprice").cast("decimal(20,4)") * F.lit(1000000007)).cast("decimal(38,4)").alias("exact"),
        F.col("l_shipdate").cast("date").alias("day"),
    )
    found = None
    for c in ("big", "exact", "day"):
        m = quantiles.exact(d, c, {c: 0.5}, by=["flag"])
        found = m if found is None else found.join(m.withColumnRenamed("flag", "_f"), F.col("flag").eqNullSafe(F.col("_f"))).drop("_f")
    return found.withColumn("exact", F.col("exact").cast("string"))


@register(
    "scale_suspects_missing_segment",
    """
with d as (select l_orderkey, case when l_returnflag = 'A' then null else l_returnflag end as flag,
 case when l_orderkey % 997 = 3 then l_extendedprice * 1000 else l_extendedprice end as price from lineitem),
e as (select flag, quantile_disc(price, 0.01) as low, quantile_disc(price, 0.99) as high from d group by 1),
o as (select d.flag, price, low, high from d join e on d.flag is not distinct from e.flag where not price between low and high)
select flag, count(*) as rows, round(sum(price), 2) as total from o
where price * 1000 between low and high or price * 100 between low and high or price / 100 between low and high or price / 1000 between low and high group by 1""",
)
def scale_suspects_missing_segment(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem", heavy=True).select(
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_orderkey") % 997 == 3, F.col("l_extendedprice") * 1000).otherwise(F.col("l_extendedprice")).alias("price"),
    )
    odd = audit.scale_suspects(d, "price", "flag")
    return odd.groupBy("flag").agg(F.count("*").alias("rows"), F.round(F.sum("price"), 2).alias("total"))


@register(
    "residuals_missing_segment",
    """
with r as (select case when l_returnflag = 'A' then null else l_returnflag end as flag,
 (case when l_orderkey % 997 = 3 then l_extendedprice * 1000 else l_extendedprice end) - 50000 as residual from lineitem),
m as (select flag, quantile_disc(residual, 0.5) as med from r group by 1),
d as (select r.flag, abs(residual - med) as dev from r join m on r.flag is not distinct from m.flag),
s as (select flag, quantile_disc(dev, 0.5) as mad from d group by 1)
select d.flag, count(*) as rows, round(max(dev), 2) as worst from d join s on d.flag is not distinct from s.flag
where 0.6745 * dev / mad > 3.5 group by 1""",
)
def residuals_missing_segment(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem", heavy=True).select(
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_orderkey") % 997 == 3, F.col("l_extendedprice") * 1000).otherwise(F.col("l_extendedprice")).alias("price"),
        F.lit(50000.0).alias("predicted"),
    )
    centre = quantiles.exact(d.select("flag", (F.col("price") - F.col("predicted")).alias("r")), "r", {"med": 0.5}, by=["flag"])
    odd = ev.residual_outliers(d, "price", "predicted", "flag").withColumnRenamed("flag", "f")
    both = odd.join(F.broadcast(centre), F.col("f").eqNullSafe(F.col("flag")))
    return both.groupBy("flag").agg(F.count("*").alias("rows"), F.round(F.max(F.abs(F.col("residual") - F.col("med"))), 2).alias("worst"))


@register(
    "lags_with_missing_months",
    f"""
with m as (select o_orderstatus, cast(date_trunc('month', o_orderdate) as date) as month, {decimal_round("avg(o_totalprice)", 4)} as value
 from orders where extract(month from o_orderdate) not in (3, 4, 9) group by 1, 2)
select m.o_orderstatus, m.month, m.value, a.value as lag_1, b.value as lag_3, c.value as lag_12 from m
 left join m a on a.o_orderstatus = m.o_orderstatus and a.month + interval 1 month = m.month
 left join m b on b.o_orderstatus = m.o_orderstatus and b.month + interval 3 month = m.month
 left join m c on c.o_orderstatus = m.o_orderstatus and c.month + interval 12 month = m.month""",
)
def lags_with_missing_months(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(~F.month("o_orderdate").isin(3, 4, 9))
    m = series.monthly(orders, "o_orderdate", "o_totalprice", ["o_orderstatus"])
    lagged = series.with_lags(m, ["o_orderstatus"], (1, 3, 12))
    return lagged.select("o_orderstatus", "month", *[F.round(c, 4).alias(c) for c in ("value", "lag_1", "lag_3", "lag_12")])


@register(
    "json_array_paths",
    """
select 'a[].x' as path, count(*) filter (where event_id % 2 = 0) as filled, count(*) as rows from events
union all select 'a[].y', count(*) filter (where event_id % 3 = 0), count(*) from events
union all select 'b[][]', count(*) filter (where event_id % 5 = 0), count(*) from events
union all select 'id', count(*), count(*) from events""",
)
def json_array_paths(spark, sf_dir):
    """Values in any element of an array, and in arrays of arrays, fill a row."""
    y = F.when(F.col("event_id") % 3 == 0, '{"y":7}').otherwise('{"y":null}')
    x = F.when(F.col("event_id") % 2 == 0, '{"x":1}').otherwise("{}")
    b = F.when(F.col("event_id") % 5 == 0, "[[],[1,2]]").otherwise("[[],[]]")
    doc = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"a":[{},'), x, F.lit(","), y, F.lit('],"b":'), b, F.lit("}"))
    return json_paths.inventory(table(spark, sf_dir, "events").select(doc.alias("j")), "j").select("path", "filled", "rows")


@register(
    "vector_topk_missing",
    """
with e as (select vec_id, case when vec_id % 10 = 0 then null else embedding::double[] end as v from embeddings),
s as (select a.vec_id as query, b.vec_id as neighbour, list_cosine_similarity(a.v, b.v) as similarity,
 row_number() over (partition by a.vec_id order by list_cosine_similarity(a.v, b.v) desc, b.vec_id) as rank
 from e a join e b on a.vec_id <> b.vec_id where a.v is not null and b.v is not null)
select query, neighbour, round(similarity, 6) as similarity, rank from s where rank <= 2""",
)
def vector_topk_missing(spark, sf_dir):
    """Vectors that are missing neither ask nor answer, the first one among them."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 10 != 0, F.col("embedding")).alias("v"))
    found = vectors.vector_search(e, e, 2, "vec_id", "v", "vec_id", "v", skip_self=True)
    return found.withColumn("similarity", F.round("similarity", 6))


# --- forecasts of known series, labels with known noise ------------------------


@register(
    "arima_known_series",
    """
with m as (select distinct o_orderpriority, cast(date_trunc('month', o_orderdate) as date) as month from orders),
t as (select *, (extract(year from month) - 1990) * 12 + extract(month from month) as t from m),
k as (select * from t where t % 17 <> 5),
l as (select o_orderpriority, max(t) as last, max(month) as last_month, count(*) as known, max(t) - min(t) + 1 as months from k group by 1),
s as (select *, step, last + step as t, cast(last_month + to_months(cast(step as int)) as date) as month from l, range(1, 19) r(step))
select o_orderpriority, cast(step as int) as step, month, cast(months as int) as months, cast(months - known as int) as filled,
 round(cast(length(o_orderpriority) * 10 + 3 * t + case when extract(month from month) >= 11 then 70 when extract(month from month) = 6 then -25 else 0 end as double), 4) as forecast,
 true as narrow
from s""",
)
def arima_known_series(spark, sf_dir):
    """A line and a yearly pattern over the months of the orders, some of them missing: the forecast goes on exactly."""
    m = table(spark, sf_dir, "orders").select("o_orderpriority", F.trunc("o_orderdate", "month").alias("month")).distinct()
    t = (F.year("month") - 1990) * 12 + F.month("month")
    season = F.when(F.month("month") >= 11, 70).when(F.month("month") == 6, -25).otherwise(0)
    known = m.withColumn("value", (F.length("o_orderpriority") * 10 + 3 * t + season).cast("double")).where(t % 17 != 5)
    found = arima.forecast(known, ["o_orderpriority"], 18)
    narrow = F.col("high") - F.col("low") < 1e-6
    return found.select("o_orderpriority", "step", "month", "months", "filled", F.round("forecast", 4).alias("forecast"), narrow.alias("narrow"))


@register(
    "arima_decomposition",
    """
with m as (select o_orderstatus, cast(date_trunc('month', o_orderdate) as date) as month from orders group by 1, 2),
s as (select o_orderstatus, datediff('month', min(month), max(month)) + 1 as months, count(*) as known from m group by 1)
select o_orderstatus, months, months - known as filled, months as adding_up, true as season_is_even from s""",
)
def arima_decomposition(spark, sf_dir):
    """Trend, season and rest add up to the value in every month, and a year's season sums up to nothing."""
    m = series.monthly(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", ["o_orderstatus"])
    parts = staged(arima.decompose(m, ["o_orderstatus"]), "parts")
    whole = F.abs(F.col("trend") + F.col("season") + F.col("rest") - F.col("value")) < 1e-6
    year = parts.groupBy("o_orderstatus", F.month("month").alias("moy")).agg(F.first("season").alias("season"))
    even = year.groupBy("o_orderstatus").agg((F.abs(F.sum("season")) < 1e-3).alias("season_is_even"))
    counts = parts.groupBy("o_orderstatus").agg(F.count("*").alias("months"), F.count_if("filled").alias("filled"), F.count_if(whole).alias("adding_up"))
    return counts.join(even, "o_orderstatus")


@register(
    "arima_intervals",
    """
select o_orderpriority, 6::bigint as steps, 6::bigint as ordered, 5::bigint as widening,
 datediff('month', min(date_trunc('month', o_orderdate)), max(date_trunc('month', o_orderdate))) + 1 >= 24 as known from orders group by 1""",
)
def arima_intervals(spark, sf_dir):
    """Forecasts of the mean order lie inside their intervals, which never narrow with the distance."""
    m = series.monthly(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", ["o_orderpriority"])
    found = arima.forecast(m, ["o_orderpriority"], 6)
    before = F.lag(F.col("high") - F.col("low")).over(W.partitionBy("o_orderpriority").orderBy("step"))
    found = found.withColumn("widening", (F.col("high") - F.col("low")) >= before - 1e-9)
    return found.groupBy("o_orderpriority").agg(
        F.count("*").alias("steps"), F.count_if((F.col("low") <= F.col("forecast")) & (F.col("forecast") <= F.col("high"))).alias("ordered"),
        F.count_if("widening").alias("widening"), F.bool_and(F.col("months") >= 24).alias("known"),
    )


NOISE_SQL = """
with d as (select l_orderkey, l_linenumber, l_orderkey % 3 as f, l_discount > 0.05 as cheap, l_discount > 0.04 as dear from lineitem),
g as (select f, cheap, sum(cast(dear as int)) as k, count(*) as n from d group by 1, 2),
r as (select a.f, a.cheap, sum(b.k) / sum(b.n) as p from g a join g b on a.cheap = b.cheap and a.f <> b.f group by 1, 2),
s as (select d.*, p from d join r on d.f = r.f and d.cheap = r.cheap),
t as (select avg(p) filter (where dear) as t1, avg(1 - p) filter (where not dear) as t0 from s),
l as (select *, case when p >= t1 and (1 - p < t0 or p > 1 - p) then true when 1 - p >= t0 then false end as likely from s, t)
"""


def _doubted(spark, sf_dir):
    """A label made by one rule, learned from a flag made by nearly the same one: the rows between them are the noise."""
    d = table(spark, sf_dir, "lineitem", heavy=True)
    d = d.select("l_orderkey", "l_linenumber", (F.col("l_discount") > 0.05).alias("cheap"), (F.col("l_discount") > 0.04).alias("dear"))
    catalog = {"dear": Feature("dear", ("l_discount",)), "cheap": Feature("cheap", ("l_shipmode",))}
    scored = label_noise.out_of_fold(
        d, "dear", ["cheap"], catalog, "RANDOM_FOREST_CLASSIFIER", fold=F.col("l_orderkey"), num_trees=1, max_tree_depth=1, bootstrap=False
    )
    return label_noise.likely(staged(scored, "out-of-fold"), "dear")


@register("label_noise_joint", NOISE_SQL + "select dear as given, likely, count(*) as rows from l group by 1, 2")
def label_noise_joint(spark, sf_dir):
    return label_noise.joint_counts(_doubted(spark, sf_dir), "dear")


@register(
    "label_noise_suspects",
    NOISE_SQL + "select l_orderkey, l_linenumber, dear as given, likely, round(case when likely then p - (1 - p) else 1 - p - p end, 4) as doubt from l where likely <> dear",
)
def label_noise_suspects(spark, sf_dir):
    found = label_noise.suspects(_doubted(spark, sf_dir), "dear")
    return found.select("l_orderkey", "l_linenumber", F.col("dear").alias("given"), "likely", F.round("doubt", 4).alias("doubt"))


# --- search inside a model type -------------------------------------------------


@register(
    "halving_closed_form",
    """
select 'halving' as search, '{"l2_reg": 0.0}' as best, 4::bigint as trials, 1::bigint as on_all_rows, round(1.0::double, 6) as r2 from lineitem having count(*) > 0
union all select 'full', '{"l2_reg": 0.0}', 3, 3, 1.0 from lineitem having count(*) > 0""",
)
def halving_closed_form(spark, sf_dir):
    """A label that is a sum of its features: no penalty fits it whole, and most candidates never see all rows."""
    d = table(spark, sf_dir, "lineitem", heavy=True).select("l_quantity", "l_tax", (F.col("l_quantity") * 2 + F.col("l_tax") * 300).alias("y"))
    found = None
    for name in ("halving", "full"):
        trials = search.halving_search(d, "y", "LINEAR_REG", {"l2_reg": [50.0, 0.0, 5.0]}, least=500, full=name == "full")
        rows = search.report(spark, trials)
        best = rows.where("share = 1 and kept").select("candidate", "score").first()
        one = rows.agg(F.count("*").alias("trials"), F.count_if(F.col("share") == 1).alias("on_all_rows"))
        one = one.select(F.lit(name).alias("search"), F.lit(best.candidate).alias("best"), "trials", "on_all_rows", F.lit(round(best.score, 6)).alias("r2"))
        found = one if found is None else found.unionByName(one)
    return found
