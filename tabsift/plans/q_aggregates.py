"""Aggregates, medians, shares and correlations over whole tables."""

from pyspark.sql import functions as F

from ..functions.scalars import contains, share
from ..operators import aggregates, quantiles
from .registry import register
from .views import table, view, with_views


@register(
    "describe_price",
    """
select count(o_totalprice) as n, round(min(o_totalprice), 2) as "min",
 round(quantile_disc(o_totalprice, 0.5), 2) as median, round(avg(o_totalprice), 2) as mean,
 round(max(o_totalprice), 2) as "max", round(stddev_samp(o_totalprice), 2) as stddev
from orders""",
)
def describe_price(spark, sf_dir):
    return aggregates.describe(table(spark, sf_dir, "orders"), "o_totalprice")


@register(
    "quantile_ladder",
    """
select quantile_disc(o_totalprice, 0.01) as p01, quantile_disc(o_totalprice, 0.5) as p50,
 quantile_disc(o_totalprice, 0.9) as p90, quantile_disc(o_totalprice, 0.99) as p99,
 min(o_totalprice) as p0, max(o_totalprice) as p100 from orders""",
)
def quantile_ladder(spark, sf_dir):
    probs = {"p0": 0.0, "p01": 0.01, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p100": 1.0}
    return quantiles.exact(table(spark, sf_dir, "orders"), "o_totalprice", probs)


@register(
    "conditional_aggs",
    with_views(
        "lineitem_dirty",
        """
select l_returnflag, count(*) as rows, count(*) filter (where price > 110000) as suspects,
 round(avg(case when price <= 110000 then price end), 2) as mean_plausible,
 round(stddev_samp(case when price <= 110000 then price end), 2) as stddev_plausible,
 round(100.0 * count(*) filter (where fee is null) / count(*), 1) as pct_no_fee
from lineitem_dirty group by l_returnflag""",
    ),
)
def conditional_aggs(spark, sf_dir):
    d, price = view(spark, sf_dir, "lineitem_dirty"), F.col("price")
    plausible = F.when(price <= 110000, price)
    return d.groupBy("l_returnflag").agg(
        F.count("*").alias("rows"),
        F.count_if(price > 110000).alias("suspects"),
        F.round(F.avg(plausible), 2).alias("mean_plausible"),
        F.round(F.stddev_samp(plausible), 2).alias("stddev_plausible"),
        share(F.count_if(F.col("fee").isNull()), F.count("*")).alias("pct_no_fee"),
    )


@register(
    "flag_rate",
    with_views(
        "part_titles",
        """
select p_type, count(*) as rows,
 round(100 * avg(cast(regexp_matches(lower(title), 'piscina') as int)), 4) as pct_pool
from part_titles group by p_type""",
    ),
)
def flag_rate(spark, sf_dir):
    d = view(spark, sf_dir, "part_titles").withColumn("pool", contains("title", "piscina"))
    return aggregates.profile_groups(d, "p_type", {}, {}, {"pct_pool": "pool"})


@register(
    "expr_quantile",
    with_views(
        "lineitem_dirty",
        """
select l_returnflag, quantile_disc(price / area_util, 0.5) as median_per_unit
from lineitem_dirty where price is not null and area_util > 0 group by l_returnflag""",
    ),
)
def expr_quantile(spark, sf_dir):
    d = view(spark, sf_dir, "lineitem_dirty").where("price is not null and area_util > 0")
    return quantiles.exact(d, F.col("price") / F.col("area_util"), {"median_per_unit": 0.5}, by=["l_returnflag"])


@register(
    "cv_population",
    """
select 'o_totalprice' as "column", round(avg(o_totalprice), 2) as mean,
 round(stddev_pop(o_totalprice), 2) as stddev_pop, round(stddev_pop(o_totalprice) / avg(o_totalprice), 6) as cv
from orders""",
)
def cv_population(spark, sf_dir):
    return aggregates.variation(table(spark, sf_dir, "orders"), ["o_totalprice"])


@register(
    "distinct_counts",
    with_views(
        "lineitem_dirty",
        """
select count(distinct contract_type) as contract_type, count(distinct city) as city,
 count(distinct l_returnflag) as l_returnflag from lineitem_dirty""",
    ),
)
def distinct_counts(spark, sf_dir):
    return aggregates.distinct_counts(view(spark, sf_dir, "lineitem_dirty"), ["contract_type", "city", "l_returnflag"])


@register(
    "median_check",
    """
with m as (select quantile_disc(o_totalprice, 0.5) as m from orders)
select count(o_totalprice) as n, count(*) filter (where o_totalprice <= m) as at_or_below,
 count(*) filter (where o_totalprice >= m) as at_or_above from orders, m""",
)
def median_check(spark, sf_dir):
    return aggregates.median_check(table(spark, sf_dir, "orders"), "o_totalprice")


@register(
    "class_share",
    """
select quality, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 1) as pct
from labels group by quality""",
)
def class_share(spark, sf_dir):
    return aggregates.class_share(table(spark, sf_dir, "labels"), "quality")


@register(
    "correlation_pairs",
    """
select 'l_quantity' as a, 'l_extendedprice' as b, round(corr(l_quantity, l_extendedprice), 6) as corr from lineitem
union all select 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) from lineitem
union all select 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 6) from lineitem""",
)
def correlation_pairs(spark, sf_dir):
    pairs = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_tax")]
    return aggregates.correlation(table(spark, sf_dir, "lineitem"), pairs)


@register(
    "joined_correlation",
    """
select 'l_quantity' as a, 'p_retailprice' as b, round(corr(l_quantity, p_retailprice), 6) as corr
from lineitem join part on l_partkey = p_partkey""",
)
def joined_correlation(spark, sf_dir):
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return aggregates.joined_correlation(li, "l_quantity", "l_partkey", part, "p_retailprice", "p_partkey")


@register(
    "having_order",
    """
select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 15""",
)
def having_order(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return spark.sql(
        "select o_custkey, count(*) as n from {o} group by 1 having n > 15 order by n desc, o_custkey", o=orders
    )
