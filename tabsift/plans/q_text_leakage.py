"""Text features and leakage guards over whole tables and whole texts."""

from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.text_patterns import ALL_FLAGS, COMMERCIAL, TYPE_FLAGS
from ..operators import leakage, text_features
from ..operators.aggregates import mean_with_without
from ..session import one_row
from .registry import register
from .views import table, view, with_views


def _re(pattern, text="title"):
    return f"regexp_matches(lower({text}), '{pattern}')"


FLAG_SQL = ", ".join(f"{_re(p)} as {n}" for n, p in ALL_FLAGS.items())


@register("text_flags", with_views("part_titles", f"select p_partkey, {FLAG_SQL} from part_titles"))
def text_flags(spark, sf_dir):
    return text_features.add_flags(view(spark, sf_dir, "part_titles", heavy=True), "title", ALL_FLAGS).select("p_partkey", *ALL_FLAGS)


@register(
    "flag_coverage",
    with_views(
        "part_titles",
        " union all ".join(
            f"""select '{n}' as "column", count(*) filter (where {_re(p)}) as rows,
 round(100.0 * count(*) filter (where {_re(p)}) / count(*), 2) as pct,
 100.0 * count(*) filter (where {_re(p)}) / count(*) < 5 as too_rare from part_titles"""
            for n, p in ALL_FLAGS.items()
        ),
    ),
)
def flag_coverage(spark, sf_dir):
    marked = text_features.add_flags(view(spark, sf_dir, "part_titles"), "title", ALL_FLAGS)
    return text_features.coverage(marked, list(ALL_FLAGS))


@register(
    "flag_overlap",
    with_views(
        "part_titles",
        f"""
select {_re(TYPE_FLAGS["eh_casa"])} as casa, {_re(COMMERCIAL)} as comercial, {_re("piscina")} as piscina, count(*) as rows,
 quantile_disc(price, 0.5) as median_price, quantile_disc(price / p_size, 0.5) as median_per_size
from part_titles group by 1, 2, 3""",
    ),
)
def flag_overlap(spark, sf_dir):
    flags = {"casa": TYPE_FLAGS["eh_casa"], "comercial": COMMERCIAL, "piscina": "piscina"}
    marked = text_features.add_flags(view(spark, sf_dir, "part_titles"), "title", flags)
    return text_features.overlap(marked, list(flags), {"median_price": "price", "median_per_size": F.col("price") / F.col("p_size")})


def _effect_sql(group):
    by = f"{group}, " if group else ""
    return f"""
with f as (select *, {_re("piscina")} as flag from part_titles),
a as (select {by}count(*) filter (where flag) as n_with, count(*) filter (where not flag) as n_without,
 count(*) filter (where flag is null) as n_unknown, round(avg(price) filter (where flag), 2) as mean_with,
 round(avg(price) filter (where not flag), 2) as mean_without from f {"group by " + group if group else ""})
select *, round(100.0 * (mean_with - mean_without) / mean_without, 2) as gap_pct from a"""


@register("flag_effect", with_views("part_titles", _effect_sql("")))
def flag_effect(spark, sf_dir):
    d = view(spark, sf_dir, "part_titles")
    return text_features.gap(mean_with_without(d, scalars.contains("title", "piscina"), "price"))


@register("flag_effect_stratified", with_views("part_titles", _effect_sql("p_type")))
def flag_effect_stratified(spark, sf_dir):
    d = view(spark, sf_dir, "part_titles")
    return text_features.gap(mean_with_without(d, scalars.contains("title", "piscina"), "price", by=["p_type"]))


@register(
    "single_category",
    with_views(
        "part_titles",
        f"""
select case when {_re(TYPE_FLAGS["eh_casa"])} then 'casa' when {_re(COMMERCIAL)} then 'comercial'
 when {_re("piscina")} then 'lazer' else 'outro' end as category, count(*) as rows, round(avg(price), 2) as mean_price
from part_titles group by 1""",
    ),
)
def single_category(spark, sf_dir):
    kinds = {"casa": TYPE_FLAGS["eh_casa"], "comercial": COMMERCIAL, "lazer": "piscina"}
    d = view(spark, sf_dir, "part_titles").withColumn("category", text_features.category("title", kinds))
    return d.groupBy("category").agg(F.count("*").alias("rows"), F.round(F.avg("price"), 2).alias("mean_price"))


def _tokens_sql(source, text, covered):
    return f"""
with r as (select coalesce({covered}, false) as c,
  list_distinct(list_filter(string_split_regex(lower({text}), '[^a-z0-9à-öø-ÿ]+'), lambda x: x <> '')) as t from {source}),
s as (select count(*) filter (where not c) as u, count(*) filter (where c) as k from r),
e as (select c, unnest(t) as token from r),
g as (select token, count(*) filter (where not c) as uncovered_rows, count(*) filter (where c) as covered_rows from e group by 1)
select token, uncovered_rows, covered_rows,
 round((uncovered_rows / u) / nullif(covered_rows / k, 0), 4) as lift from g, s where uncovered_rows > 0"""


@register("uncovered_tokens", with_views("part_titles", _tokens_sql("part_titles", "title", _re(COMMERCIAL))))
def uncovered_tokens(spark, sf_dir):
    return text_features.uncovered_tokens(view(spark, sf_dir, "part_titles"), "title", scalars.contains("title", COMMERCIAL))


@register("uncovered_words_documents", _tokens_sql("documents", "text", "lang = 'en'"))
def uncovered_words_documents(spark, sf_dir):
    return text_features.uncovered_tokens(table(spark, sf_dir, "documents", heavy=True), "text", F.col("lang") == "en")


CAPTURE_SQL = r"nullif(regexp_extract(title, 'R\$\s*([\d\.]+(?:,\d+)?)', 1), '')"
AMOUNT_SQL = (
    f"case when {CAPTURE_SQL} like '%,%' then try_cast(replace(replace({CAPTURE_SQL}, '.', ''), ',', '.') as double)"
    f" else try_cast({CAPTURE_SQL} as double) end"
)


@register(
    "amount_in_text",
    with_views(
        "part_titles",
        f"select p_partkey, title, {CAPTURE_SQL} as written, {AMOUNT_SQL} as amount from part_titles where title like '%R$%'",
    ),
)
def amount_in_text(spark, sf_dir):
    d = view(spark, sf_dir, "part_titles").where(F.col("title").contains("R$"))
    return d.select(
        "p_partkey",
        "title",
        scalars.capture("title", scalars.AMOUNT_SHAPE).alias("written"),
        scalars.amount_in_text("title").alias("amount"),
    )


@register(
    "amount_match",
    with_views(
        "part_titles",
        f"""
select count(*) as rows, count(*) filter (where title like '%R$%') as with_sign, count(amount) as parsed,
 count(*) filter (where abs(amount - price) < 0.02 * price) as matching
from (select *, {AMOUNT_SQL} as amount from part_titles)""",
    ),
)
def amount_match(spark, sf_dir):
    return text_features.amount_match(view(spark, sf_dir, "part_titles"), "title", "price")


@register(
    "word_boundary",
    r"""
with w as (select lang, regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])the([^\p{L}\p{N}_]|$)') as whole,
 regexp_matches(lower(text), 'the') as anywhere from documents)
select lang, count(*) as rows, count(*) filter (where whole) as whole_word, count(*) filter (where anywhere) as anywhere
from w group by 1""",
)
def word_boundary(spark, sf_dir):
    d = table(spark, sf_dir, "documents", heavy=True).select(
        "lang", scalars.has_word("text", "the").alias("whole"), scalars.contains("text", "the").alias("anywhere")
    )
    return d.groupBy("lang").agg(
        F.count("*").alias("rows"), F.count_if("whole").alias("whole_word"), F.count_if("anywhere").alias("anywhere")
    )


# --- leakage -----------------------------------------------------------------


def scored_titles(spark, sf_dir):
    """Titles with the mined amount and a closed-form model that reads it when present.

    Elsewhere the model is the least-squares line of price on size.
    """
    d = view(spark, sf_dir, "part_titles").withColumn("amount", scalars.amount_in_text("title"))
    line = one_row(d.agg(F.regr_slope("price", "p_size").alias("b"), F.regr_intercept("price", "p_size").alias("a")))
    return d.withColumn("predicted", F.coalesce(F.when(F.col("amount") > 1, F.col("amount")), line["a"] + line["b"] * F.col("p_size")))


SCORED_SQL = f"""
with d as (select *, {AMOUNT_SQL} as amount from part_titles),
line as (select regr_slope(price, p_size) as b, regr_intercept(price, p_size) as a from d),
s as (select d.*, coalesce(case when amount > 1 then amount end, a + b * p_size) as predicted from d, line)
"""


@register(
    "leak_label_copy",
    with_views(
        "part_titles",
        f"with d as (select *, {AMOUNT_SQL} as amount from part_titles)"
        + " union all ".join(
            f"""
select '{c}' as "column", count({c}) as filled, count(*) filter (where abs({c} - price) < 0.02 * abs(price)) as equal_to_label,
 round(count(*) filter (where abs({c} - price) < 0.02 * abs(price)) / count({c}), 4) as rate,
 count(*) filter (where abs({c} - price) < 0.02 * abs(price)) / count({c}) >= 0.5 as is_copy from d"""
            for c in ("amount", "p_size")
        ),
    ),
)
def leak_label_copy(spark, sf_dir):
    d = view(spark, sf_dir, "part_titles").withColumn("amount", scalars.amount_in_text("title"))
    return leakage.label_copies(d, "price", ["amount", "p_size"])


@register(
    "error_by_subgroup",
    with_views(
        "part_titles",
        SCORED_SQL + "select amount is not null as text_tells, count(*) as rows, round(avg(abs(predicted - price)), 4) as mae from s group by 1",
    ),
)
def error_by_subgroup(spark, sf_dir):
    return leakage.error_by_group(scored_titles(spark, sf_dir), "price", "predicted", F.col("amount").isNotNull(), "text_tells")


@register(
    "leak_subgroup_gap",
    with_views(
        "part_titles",
        SCORED_SQL
        + """
select 'honest_amount' as "column", count(*) filter (where h) as rows_filled, count(*) filter (where not h) as rows_missing,
 round(avg(e) filter (where h), 4) as mae_filled, round(avg(e) filter (where not h), 4) as mae_missing,
 round(1 - avg(e) filter (where h) / avg(e) filter (where not h), 4) as relative_gap,
 1 - avg(e) filter (where h) / avg(e) filter (where not h) >= 0.25 as suspicious
from (select abs(predicted - price) as e, coalesce(abs(amount - price) < 0.02 * price, false) as h from s)""",
    ),
)
def leak_subgroup_gap(spark, sf_dir):
    near = F.abs(F.col("amount") - F.col("price")) < F.lit(0.02) * F.col("price")
    d = scored_titles(spark, sf_dir).withColumn("honest_amount", F.when(near, F.col("amount")))
    return leakage.subgroup_gaps(d, "price", "predicted", ["honest_amount"])


CATALOG = {
    f.name: f
    for f in (
        leakage.Feature("is_commercial", derived_from=("title",)),
        leakage.Feature("title_length", derived_from=("title",)),
        leakage.Feature("amount", derived_from=("title",)),
        leakage.Feature("price_per_size", derived_from=("price", "p_size")),
        leakage.Feature("sold_in_days", available_at="after"),
    )
}


@register(
    "lineage_guard",
    with_views(
        "part_titles",
        f"""
with k as (select count(*) filter (where {_re(COMMERCIAL)}) as positives from part_titles)
select v.feature, v.refused, v.reason, positives from k, (values
 ('title', true, 'the label was derived from it'), ('title_length', true, 'shares the label''s source title'),
 ('amount', true, 'shares the label''s source title'), ('is_commercial', true, 'is the label'),
 ('sold_in_days', true, 'known only after the event'), ('p_size', false, null), ('price', false, null)) v(feature, refused, reason)""",
    ),
)
def lineage_guard(spark, sf_dir):
    features = ["title", "title_length", "amount", "is_commercial", "sold_in_days", "p_size", "price"]
    label = view(spark, sf_dir, "part_titles").select(scalars.contains("title", COMMERCIAL).alias("is_commercial"))
    positives = label.agg(F.count_if("is_commercial")).scalar()
    return leakage.verdict_frame(spark, features, "is_commercial", CATALOG).withColumn("positives", positives)


@register(
    "availability_guard",
    """
select 'l_shipdate' as "column", count(*) filter (where l_shipdate > o_orderdate) as late_rows, count(*) as rows,
 round(100.0 * count(*) filter (where l_shipdate > o_orderdate) / count(*), 2) as pct
from lineitem join orders on l_orderkey = o_orderkey""",
)
def availability_guard(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return leakage.late_features(li.join(orders, "l_orderkey"), {"l_shipdate": ("l_shipdate", "o_orderdate")})


@register(
    "too_good_alarm",
    with_views(
        "part_titles",
        SCORED_SQL
        + """
, m as (select 'reads_the_text' as model, 'r2' as metric, 1 - sum((price - predicted) ** 2) / sum((price - mu) ** 2) as v
   from s, (select avg(price) as mu from s where amount is not null) where amount is not null
 union all select 'label_as_feature', 'r2', 1.0)
select model, metric, round(v, 4) as value, v > 0.99 as alarm from m""",
    ),
)
def too_good_alarm(spark, sf_dir):
    s = scored_titles(spark, sf_dir)
    told = s.where("amount is not null")
    mu = told.agg(F.avg("price")).scalar()
    r2 = lambda p, m: 1 - F.sum((F.col("price") - p) ** 2) / F.sum((F.col("price") - m) ** 2)
    whole_mean = s.agg(F.avg("price")).scalar()
    rows = told.agg(r2(F.col("predicted"), mu).alias("value")).select(F.lit("reads_the_text").alias("model"), F.lit("r2").alias("metric"), "value")
    copied = s.agg(r2(F.col("price"), whole_mean).alias("value")).select(
        F.lit("label_as_feature").alias("model"), F.lit("r2").alias("metric"), "value"
    )
    return leakage.too_good(rows.unionByName(copied), {"r2": 0.99}).withColumn("value", F.round("value", 4))


@register(
    "ratio_leak",
    with_views(
        "part_titles",
        """
select 'price_per_size' as feature, count(*) as rows,
 count(*) filter (where abs((price / p_size) * p_size - price) <= 1e-3 * greatest(abs(price), 1)) as rebuilt, true as refused
from part_titles""",
    ),
)
def ratio_leak(spark, sf_dir):
    d = view(spark, sf_dir, "part_titles").withColumn("price_per_size", F.try_divide(F.col("price"), F.col("p_size")))
    refused = bool(leakage.lineage_verdicts(["price_per_size"], "price", CATALOG))
    return d.agg(
        F.count("*").alias("rows"),
        F.count_if(scalars.nearly_equal(F.col("price_per_size") * F.col("p_size"), "price")).alias("rebuilt"),
    ).select(F.lit("price_per_size").alias("feature"), "rows", "rebuilt", F.lit(refused).alias("refused"))
