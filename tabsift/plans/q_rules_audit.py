"""Cleaning rules, audits, repairs, duplicates, joins and samples over whole tables."""

from pyspark.sql import functions as F

from ..functions.scalars import share
from ..operators import aggregates, audit, joins, rules, sampling
from .registry import register
from .views import decimal_round, table, view, with_views

PRICE, AREA = (1000, 110000), (1, 50)


def gold_rules():
    """Signed decisions: a row without a plausible price and area is not data."""
    return [rules.between("price", *PRICE), rules.between("area_util", *AREA)]


GOLD_SQL = "price between 1000 and 110000 and area_util between 1 and 50"


def gold(spark, sf_dir):
    """Cut, then derive: the ratio is safe only after the filter."""
    kept = rules.apply_rules(view(spark, sf_dir, "lineitem_dirty"), gold_rules())
    return kept.withColumn("price_per_unit", F.round(F.col("price") / F.col("area_util"), 2)).drop("contract_type", "city", "area_total")


@register(
    "gold_build",
    with_views(
        "lineitem_dirty",
        f"""
select l_orderkey, l_linenumber, l_partkey, area_util, price, fee, l_discount, l_returnflag,
 {decimal_round("price / area_util", 2)} as price_per_unit from lineitem_dirty where {GOLD_SQL}""",
    ),
)
def gold_build(spark, sf_dir):
    return gold(spark, sf_dir)


@register(
    "gold_confirmation",
    with_views(
        "lineitem_dirty",
        f"""
with b as (select count(*) as rows_before, round(avg(price), 2) as mean_before,
  round(stddev_samp(price), 2) as stddev_before, round(quantile_disc(price, 0.5), 2) as median_before from lineitem_dirty),
a as (select count(*) as rows_after, round(avg(price), 2) as mean_after,
  round(stddev_samp(price), 2) as stddev_after, round(quantile_disc(price, 0.5), 2) as median_after
  from lineitem_dirty where {GOLD_SQL})
select *, rows_after = 0 as is_empty, round(100.0 * rows_after / rows_before, 3) as pct_kept from b, a""",
    ),
)
def gold_confirmation(spark, sf_dir):
    return rules.confirm(view(spark, sf_dir, "lineitem_dirty"), gold(spark, sf_dir), "price")


@register(
    "outlier_leverage",
    with_views(
        "lineitem_dirty",
        """
select count(*) filter (where price > 110000) as suspects, count(price) as n,
 round(100.0 * count(*) filter (where price > 110000) / count(price), 1) as pct,
 round(stddev_samp(price), 2) as stddev_with,
 round(stddev_samp(price) filter (where price <= 110000), 2) as stddev_without,
 round(100 * (1 - stddev_samp(price) filter (where price <= 110000) / stddev_samp(price)), 2) as spread_removed_pct
from lineitem_dirty""",
    ),
)
def outlier_leverage(spark, sf_dir):
    return audit.outlier_leverage(view(spark, sf_dir, "lineitem_dirty"), "price", 110000)


@register(
    "outlier_top10",
    with_views(
        "lineitem_dirty",
        """
select l_orderkey, l_linenumber, l_partkey, round(price) as price from lineitem_dirty where price > 110000
order by lineitem_dirty.price desc, l_orderkey, l_linenumber, l_partkey limit 10""",
    ),
)
def outlier_top10(spark, sf_dir):
    d = view(spark, sf_dir, "lineitem_dirty").where("price > 110000")
    top = d.orderBy(F.desc("price"), "l_orderkey", "l_linenumber", "l_partkey").limit(10)
    return top.select("l_orderkey", "l_linenumber", "l_partkey", F.round("price").alias("price"))


@register(
    "impossible_values",
    with_views(
        "lineitem_dirty",
        """
select 'area_util' as "column", count(*) filter (where area_util <= 1) as too_low,
 count(*) filter (where area_util > 50) as too_high, count(*) as rows from lineitem_dirty
union all select 'price', count(*) filter (where price <= 1000), count(*) filter (where price > 110000), count(*) from lineitem_dirty""",
    ),
)
def impossible_values(spark, sf_dir):
    return audit.impossible_values(view(spark, sf_dir, "lineitem_dirty"), {"area_util": (1, 50), "price": (1000, 110000)})


def _dead_sql(column):
    top = f"(select {column} as v, count(*) as k from lineitem_dirty where {column} is not null group by 1 order by k desc, v limit 1)"
    return f"""select '{column}' as "column", (select count(distinct {column}) <= 1 from lineitem_dirty) as is_constant,
 case when k >= 0.999 * (select count({column}) from lineitem_dirty) then cast(v as varchar) end as dominant_value,
 case when k >= 0.999 * (select count({column}) from lineitem_dirty) then k end as dominant_rows,
 (select count(distinct {column}) <= 1 from lineitem_dirty) or k >= 0.999 * (select count({column}) from lineitem_dirty) as is_dead
 from {top} t"""


DEAD_COLUMNS = ["contract_type", "city", "l_returnflag", "l_linenumber", "area_util"]


@register("dead_columns", with_views("lineitem_dirty", " union all ".join(map(_dead_sql, DEAD_COLUMNS))))
def dead_columns(spark, sf_dir):
    return audit.dead_columns(view(spark, sf_dir, "lineitem_dirty"), DEAD_COLUMNS)


CENSUS = ["l_orderkey", "area_util", "price", "fee", "city"]


@register(
    "null_census",
    with_views(
        "lineitem_dirty",
        " union all ".join(
            f"""select '{c}' as "column", count(*) - count({c}) as nulls, count(*) as rows,
 round(100.0 * (count(*) - count({c})) / count(*), 1) as pct from lineitem_dirty"""
            for c in CENSUS
        ),
    ),
)
def null_census(spark, sf_dir):
    return aggregates.null_census(view(spark, sf_dir, "lineitem_dirty"), CENSUS)


@register(
    "swapped_columns",
    with_views(
        "supplier_geo",
        """
select s_suppkey, latitude, longitude from supplier_geo
where latitude between -60 and -40 and longitude between -30 and 0""",
    ),
)
def swapped_columns(spark, sf_dir):
    return audit.swapped_columns(view(spark, sf_dir, "supplier_geo"), "latitude", (-30, 0), "longitude", (-60, -40))


@register(
    "swapped_or_missing",
    with_views(
        "supplier_geo",
        """
select s_suppkey, latitude, longitude from supplier_geo where latitude < -40 or latitude is null
order by latitude nulls last, s_suppkey limit 10""",
    ),
)
def swapped_or_missing(spark, sf_dir):
    d = view(spark, sf_dir, "supplier_geo")
    odd = d.where((F.col("latitude") < -40) | F.col("latitude").isNull())
    return odd.orderBy(F.asc_nulls_last("latitude"), "s_suppkey").limit(10)


@register(
    "swap_repair",
    with_views(
        "supplier_geo",
        """
select s_suppkey, case when latitude < -40 then longitude else latitude end as latitude,
 case when latitude < -40 then latitude else longitude end as longitude,
 latitude is not null as has_coordinate from supplier_geo""",
    ),
)
def swap_repair(spark, sf_dir):
    fixed = rules.swap_repair(view(spark, sf_dir, "supplier_geo"), "latitude", "longitude", F.col("latitude") < -40)
    return fixed.withColumn("has_coordinate", F.col("latitude").isNotNull())


@register(
    "cross_column_rule",
    with_views(
        "lineitem_dirty",
        """
select 'area_util_above_total' as "check", count(*) filter (where area_util > area_total) as broken,
 round(100.0 * count(*) filter (where area_util > area_total) / count(*), 3) as pct from lineitem_dirty
union all select 'fee_above_discount', count(*) filter (where fee > l_discount),
 round(100.0 * count(*) filter (where fee > l_discount) / count(*), 3) from lineitem_dirty""",
    ),
)
def cross_column_rule(spark, sf_dir):
    checks = {
        "area_util_above_total": F.col("area_util") > F.col("area_total"),
        "fee_above_discount": F.col("fee") > F.col("l_discount"),
    }
    return audit.cross_column(view(spark, sf_dir, "lineitem_dirty"), checks)


@register(
    "scale_error_suspects",
    with_views(
        "lineitem_dirty",
        """
with e as (select l_returnflag, quantile_disc(price, 0.01) as p01, quantile_disc(price, 0.99) as p99
  from lineitem_dirty group by 1),
j as (select d.l_orderkey, d.l_linenumber, d.l_partkey, d.l_returnflag, d.price,
  case when price / 0.001 between p01 and p99 then -3 when price / 0.01 between p01 and p99 then -2
       when price / 100 between p01 and p99 then 2 when price / 1000 between p01 and p99 then 3 end as power
  from lineitem_dirty d join e using (l_returnflag) where not price between p01 and p99)
select l_returnflag, power, count(*) as rows, round(max(price), 2) as worst from j where power is not null group by 1, 2""",
    ),
)
def scale_error_suspects(spark, sf_dir):
    found = audit.scale_suspects(view(spark, sf_dir, "lineitem_dirty"), "price", "l_returnflag")
    return found.groupBy("l_returnflag", "power").agg(F.count("*").alias("rows"), F.round(F.max("price"), 2).alias("worst"))


@register(
    "rule_report",
    with_views(
        "lineitem_dirty",
        """
with f as (select not coalesce(price between 1000 and 110000, false) as p,
  not coalesce(area_util between 1 and 50, false) as a, fee is null as n from lineitem_dirty)
select 'price_between' as rule, count(*) filter (where p) as cut, count(*) filter (where p and not a and not n) as cut_alone,
 count(*) as rows, count(*) filter (where not p and not a and not n) as kept,
 round(100.0 * count(*) filter (where p) / count(*), 3) as cut_pct from f
union all select 'area_util_between', count(*) filter (where a), count(*) filter (where a and not p and not n), count(*),
 count(*) filter (where not p and not a and not n), round(100.0 * count(*) filter (where a) / count(*), 3) from f
union all select 'fee_present', count(*) filter (where n), count(*) filter (where n and not p and not a), count(*),
 count(*) filter (where not p and not a and not n), round(100.0 * count(*) filter (where n) / count(*), 3) from f""",
    ),
)
def rule_report(spark, sf_dir):
    return rules.rule_report(view(spark, sf_dir, "lineitem_dirty"), [*gold_rules(), rules.present("fee")])


@register(
    "quarantine",
    with_views(
        "lineitem_dirty",
        """
with f as (select l_orderkey, l_linenumber, l_partkey,
  list_filter([case when not coalesce(price between 1000 and 110000, false) then 'price_between' end,
   case when not coalesce(area_util between 1 and 50, false) then 'area_util_between' end], lambda x: x is not null) as failed
  from lineitem_dirty)
select l_orderkey, l_linenumber, l_partkey, array_to_string(failed, ',') as failed_rules from f where len(failed) > 0""",
    ),
)
def quarantine(spark, sf_dir):
    _, rejected = rules.quarantine(view(spark, sf_dir, "lineitem_dirty"), gold_rules())
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("failed_rules", ",").alias("failed_rules"))


@register(
    "percentile_cut",
    """
with q as (select quantile_disc(o_totalprice, 0.99) as q from orders)
select o_orderkey, o_totalprice from orders, q where o_totalprice <= q""",
)
def percentile_cut(spark, sf_dir):
    cut = rules.cut_above_quantile(table(spark, sf_dir, "orders"), "o_totalprice", 0.99)
    return cut.select("o_orderkey", "o_totalprice")


@register(
    "tail_alarm",
    with_views(
        "lineitem_dirty",
        " union all ".join(
            f"""select '{c}' as "column", count({c}) as n, round(avg({c}), 2) as mean, round(quantile_disc({c}, 0.5), 2) as median,
 round(stddev_samp({c}), 2) as stddev, round(avg({c}) / quantile_disc({c}, 0.5), 4) as mean_to_median,
 stddev_samp({c}) > abs(avg({c})) as spread_exceeds_mean from lineitem_dirty"""
            for c in ("price", "area_util", "area_total")
        ),
    ),
)
def tail_alarm(spark, sf_dir):
    return audit.tail_alarm(view(spark, sf_dir, "lineitem_dirty"), ["price", "area_util", "area_total"])


@register(
    "duplicate_keys",
    "select l_orderkey, l_linenumber, count(*) as times from lineitem group by 1, 2 having count(*) > 1",
)
def duplicate_keys(spark, sf_dir):
    return audit.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "duplicate_texts",
    """
select sha256(text) as digest, count(*) as copies, min(doc_id) as first_id
from documents group by text having count(*) > 1""",
)
def duplicate_texts(spark, sf_dir):
    return audit.duplicate_texts(table(spark, sf_dir, "documents"), "text", "doc_id")


@register(
    "dedup_first",
    """
select doc_id, lang, source, n_chars from documents
qualify row_number() over (partition by text order by doc_id) = 1""",
)
def dedup_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("digest", F.sha2("text", 256)).drop("text")
    return audit.dedup_first(docs, ["digest"], ["doc_id"]).select("doc_id", "lang", "source", "n_chars")


@register(
    "split_leak",
    """
with d as (select text, count(*) as times,
  count(*) filter (where cast('0x' || substr(sha256('42:' || doc_id), 1, 8) as bigint) % 100 < 20) as in_test
  from documents group by text)
select count(*) filter (where times > 1) as duplicate_keys,
 count(*) filter (where in_test > 0 and in_test < times) as leaking_keys,
 cast(coalesce(sum(times) filter (where in_test > 0 and in_test < times), 0) as bigint) as leaking_rows from d""",
)
def split_leak(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("digest"), "doc_id")
    return audit.split_leak(docs, ["digest"], sampling.bucket("doc_id") < 20)


@register(
    "worst_per_segment",
    """
select * from (select l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
 row_number() over (partition by l_returnflag
  order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey) as rank from lineitem) where rank <= 5""",
)
def worst_per_segment(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return audit.top_per_group(li, ["l_returnflag"], order, 5)


@register(
    "join_fanout",
    """
with a as (select o_custkey as k, count(*) as nl from orders group by 1),
b as (select c_custkey as k, count(*) as nr from customer group by 1)
select cast(sum(nl) as bigint) as rows_left, cast(sum(nr) as bigint) as rows_right, cast(sum(nl * nr) as bigint) as rows_joined,
 max(nr) filter (where nl is not null) as max_right_per_key, max(nl) filter (where nr is not null) as max_left_per_key,
 count(*) filter (where nr is null) as left_keys_without_right, count(*) filter (where nl is null) as right_keys_without_left
from a full join b on a.k = b.k""",
)
def join_fanout(spark, sf_dir):
    return joins.fanout(table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer"), "c_custkey")


@register(
    "join_matched",
    """
select c_mktsegment, count(*) filter (where exists (select 1 from orders where o_custkey = c_custkey)) as with_orders,
 count(*) filter (where not exists (select 1 from orders where o_custkey = c_custkey)) as without_orders
from customer group by 1""",
)
def join_matched(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    o = table(spark, sf_dir, "orders")
    hit = joins.matched(c, o, "c_custkey", "o_custkey").select("c_mktsegment", F.lit(1).alias("hit"))
    miss = joins.unmatched(c, o, "c_custkey", "o_custkey").select("c_mktsegment", F.lit(0).alias("hit"))
    return (
        hit.unionByName(miss)
        .groupBy("c_mktsegment")
        .agg(F.count_if(F.col("hit") == 1).alias("with_orders"), F.count_if(F.col("hit") == 0).alias("without_orders"))
    )


@register(
    "hash_sample",
    "select doc_id, lang, n_chars from documents order by sha256('42:' || doc_id), doc_id limit 100",
)
def hash_sample(spark, sf_dir):
    return sampling.hash_sample(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id", 100)


@register(
    "sample_bias",
    """
with m as (select doc_id, lang = 'en' as f from documents),
p as (select 'whole' as part, count(*) as rows, count(*) filter (where f) as hits from m
 union all select 'sample', count(*), count(*) filter (where f) from (select * from m order by sha256('42:' || doc_id), doc_id limit 100)
 union all select 'head', count(*), count(*) filter (where f) from (select * from m order by doc_id limit 100)),
w as (select hits / rows as p from p where part = 'whole')
select part, rows, hits, round(100 * (hits / rows), 3) as pct,
 round((hits / rows - p) / sqrt(p * (1 - p) / rows), 4) as z from p, w""",
)
def sample_bias(spark, sf_dir):
    return sampling.sample_bias(table(spark, sf_dir, "documents"), "doc_id", F.col("lang") == "en", 100)


@register(
    "split_hash",
    """
select cast('0x' || substr(sha256('42:' || o_orderkey), 1, 8) as bigint) % 100 < 20 as is_test, count(*) as rows,
 round(100.0 * count(*) / sum(count(*)) over (), 3) as pct, cast(sum(o_orderkey) as bigint) as key_sum
from orders group by 1""",
)
def split_hash(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("is_test", sampling.bucket("o_orderkey") < 20)
    sides = o.groupBy("is_test").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("key_sum"))
    total = sides.agg(F.sum("rows")).scalar()
    return sides.withColumn("pct", share(F.col("rows"), total, 3))


@register(
    "missing_coordinates",
    with_views(
        "supplier_geo",
        " union all ".join(
            f"""select '{c}' as "column", count(*) - count({c}) as nulls, count(*) as rows,
 round(100.0 * (count(*) - count({c})) / count(*), 1) as pct from supplier_geo"""
            for c in ("latitude", "longitude")
        ),
    ),
)
def missing_coordinates(spark, sf_dir):
    return aggregates.null_census(view(spark, sf_dir, "supplier_geo"), ["latitude", "longitude"])
