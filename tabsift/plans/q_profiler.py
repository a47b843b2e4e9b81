"""Profiles of whole tables, raw and typed."""

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import profiler
from ..session import fresh_path, spread
from ..sources import csv_files
from .registry import register
from .views import table, view, with_views


def _columns_sql(source, kinds):
    parts = []
    for c, kind in kinds.items():
        d = f"count(distinct {c})"
        parts.append(
            f"""select '{c}' as "column", '{kind}' as type, {d} as "distinct", false as is_estimate,
 count(*) filter (where {c} is null or trim(cast({c} as varchar)) = '') as empty, {d} <= 1 as is_constant,
 case when {d} <= 1 then min(cast({c} as varchar)) end as constant_value from {source}"""
        )
    return " union all ".join(parts)


DIRTY = {
    **dict.fromkeys(["l_orderkey", "l_linenumber", "l_partkey", "area_total", "area_util", "price", "fee", "l_discount"], "number"),
    **dict.fromkeys(["l_returnflag", "contract_type", "city"], "category"),
}


@register("profile_columns", with_views("lineitem_dirty", _columns_sql("lineitem_dirty", DIRTY)))
def profile_columns(spark, sf_dir):
    return profiler.profile_columns(view(spark, sf_dir, "lineitem_dirty", heavy=True), exact=True)


RAW = {"doc_id": "number", "text": "text", "lang": "category", "source": "category", "n_chars": "number"}


@register("profile_raw_csv", _columns_sql("documents", RAW))
def profile_raw_csv(spark, sf_dir):
    """The same profile of untyped text cells, read back from a CSV with a detected separator."""
    path = fresh_path(spark, "profile")
    csv_files.write_csv(table(spark, sf_dir, "documents"), path, sep=";")
    return profiler.profile_columns(spread(csv_files.read_csv(spark, path, sep=";", multiline=True)), exact=True)


def _regression_sql(c):
    cv, good = f"stddev_pop({c}) / avg({c})", f"stddev_pop({c}) / avg({c}) between 0.3 and 5 and count(distinct {c}) > 100"
    figures = {"cv": f"round({cv}, 4)", "mean": f"round(avg({c}), 2)", "stddev": f"round(stddev_pop({c}), 2)"}
    return [
        f"""select 'regression' as task, '{c}' as "column", '{m}' as measure, {v} as value, {good} as good,
 null::date as first_day, null::date as last_day from orders"""
        for m, v in figures.items()
    ]


@register(
    "target_candidates",
    " union all ".join(q for c in ("o_orderkey", "o_custkey", "o_totalprice") for q in _regression_sql(c))
    + """
union all select 'classification', 'o_orderstatus', 'categories', cast(count(distinct o_orderstatus) as double), true, null, null from orders
union all select 'classification', 'o_orderpriority', 'categories', cast(count(distinct o_orderpriority) as double), true, null, null from orders
union all select 'time_series', 'o_orderdate', 'months', cast(count(distinct strftime(o_orderdate, '%Y-%m')) as double),
 count(distinct strftime(o_orderdate, '%Y-%m')) >= 24, cast(min(o_orderdate) as date), cast(max(o_orderdate) as date) from orders
union all select 'free_text', 'note', 'mean_chars',
 round(avg(length('order ' || o_orderkey || ' placed with priority ' || o_orderpriority || ' and status ' || o_orderstatus)), 2), true, null, null
from orders""",
)
def target_candidates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", heavy=True)
    parts = ["order ", F.col("o_orderkey").cast("string"), " placed with priority ", F.col("o_orderpriority"), " and status ", F.col("o_orderstatus")]
    note = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return profiler.target_candidates(orders.withColumn("note", note))


@register(
    "binary_target",
    """select 'classification' as task, 'o_totalprice' as "column", 'above_p90' as measure, true as good, count(*) >= 10 as offered from orders""",
)
def binary_target(spark, sf_dir):
    """Without a category that fits, a number gives a yes-or-no target."""
    found = profiler.target_candidates(table(spark, sf_dir, "orders").select("o_totalprice")).where("task = 'classification'")
    return found.select("task", "column", "measure", "good", (F.col("value") > 0).alias("offered"))


@register(
    "preview",
    """
select cast(doc_id as varchar) as doc_id, substr(text, 1, 70) as text, lang, source, cast(n_chars as varchar) as n_chars
from documents order by documents.doc_id limit 3""",
)
def preview(spark, sf_dir):
    return profiler.preview(table(spark, sf_dir, "documents"), ["doc_id"])


HUNT = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "cut", "net"]
HUNT_FROM = """(select *, l_extendedprice * l_discount as cut,
 case when l_orderkey % 997 = 0 then 7.0 else l_extendedprice - l_extendedprice * l_discount end as net from lineitem)"""


def _hunt_sql(columns, source, ratio):
    """Every row once per formula, then one group per formula that counts the hits of all targets."""
    formulas = [(c, c, [c]) for c in columns]
    for a, b in combinations(columns, 2):
        formulas += [(f"{a} * {b}",) * 2 + ([a, b],), (f"{a} + {b}",) * 2 + ([a, b],), (f"{a} - {b}",) * 2 + ([a, b],), (f"{b} - {a}",) * 2 + ([a, b],)]
        if ratio:
            formulas += [(f"{a} / {b}", f"{a} / nullif({b}, 0)", [a, b]), (f"{b} / {a}", f"{b} / nullif({a}, 0)", [a, b])]
    cells = ", ".join(f"{{'f': '{name}', 'v': {value}, 'uses': {used}}}" for name, value, used in formulas)
    near = "coalesce(abs(e.v - {y}) <= 1e-3 * greatest(abs(e.v), abs({y}), 1.0), false)"
    counts = [f"count(*) filter (where {near.format(y=y)}) as k_{y}, count(e.v - {y}) as n_{y}" for y in columns]
    found = " union all ".join(f"select '{y}' as target, f, uses, k_{y} as k, n_{y} as n from c" for y in columns)
    return f"""
with s as (select {", ".join(f"cast({c} as double) as {c}" for c in columns)} from {source}),
r as (select *, unnest([{cells}]) as e from s),
c as (select e.f as f, any_value(e.uses) as uses, {", ".join(counts)} from r group by e.f),
u as ({found})
select target, f as formula, n as rows, round(100.0::double * k / n, 2) as pct from u where n > 0 and k / n >= 0.99 and not list_contains(uses, target)"""


@register("identity_hunt", _hunt_sql(HUNT, HUNT_FROM, False))
def identity_hunt(spark, sf_dir):
    """All numbers of the line items; one row in a thousand breaks an identity, which is still found."""
    li = table(spark, sf_dir, "lineitem", heavy=True).withColumn("cut", F.col("l_extendedprice") * F.col("l_discount"))
    net = F.when(F.col("l_orderkey") % 997 == 0, 7.0).otherwise(F.col("l_extendedprice") - F.col("cut"))
    return profiler.identity_hunt(li.withColumn("net", net), HUNT)


RATIO = ["l_extendedprice", "rate", "cut"]
RATIO_FROM = """(select l_extendedprice, case when l_orderkey % 5 = 0 then 0.0 else l_discount end as rate,
 l_extendedprice * (case when l_orderkey % 5 = 0 then 0.0 else l_discount end) as cut from lineitem)"""


@register("identity_hunt_ratio", _hunt_sql(RATIO, RATIO_FROM, True))
def identity_hunt_ratio(spark, sf_dir):
    """Quotients too, over rows of which many have a zero denominator."""
    rate = F.when(F.col("l_orderkey") % 5 == 0, 0.0).otherwise(F.col("l_discount"))
    li = table(spark, sf_dir, "lineitem").select("l_extendedprice", rate.alias("rate"))
    return profiler.identity_hunt(li.withColumn("cut", F.col("l_extendedprice") * F.col("rate")), RATIO, ratio=True)


@register("identity_search", _hunt_sql(HUNT, HUNT_FROM, False))
def identity_search(spark, sf_dir):
    """The same answer by looking up values in a probe and counting what that leaves on all rows."""
    li = table(spark, sf_dir, "lineitem", heavy=True).withColumn("cut", F.col("l_extendedprice") * F.col("l_discount"))
    net = F.when(F.col("l_orderkey") % 997 == 0, 7.0).otherwise(F.col("l_extendedprice") - F.col("cut"))
    return profiler.identity_search(li.withColumn("net", net), HUNT)


# Fifty columns without a rule beside the ten: remainders by the primes from 100,003 on, of keys times a number of their own.
NOISE = [f"noise_{i}" for i in range(50)]
NOISE_TERM = "(l_orderkey * {p} + l_partkey * {q} + l_suppkey * 31 + l_linenumber * 7919) % 1000003 / {r}"
NOISE_TERMS = {c: NOISE_TERM.format(p=7919 + 104 * i, q=104729 + 1299 * i, r=f"cast({7 + i}.5 as double)") for i, c in enumerate(NOISE)}
PLANTED = {
    ("cut", "l_extendedprice * l_discount"): ["cut", "l_extendedprice", "l_discount"],
    ("cut", "l_extendedprice - net"): ["cut", "l_extendedprice", "net"],
    ("net", "l_extendedprice - cut"): ["net", "l_extendedprice", "cut"],
    ("l_extendedprice", "cut + net"): ["l_extendedprice", "cut", "net"],
}
_HIT = "abs(({f}) - {y}) <= 1e-3 * greatest(abs({f}), abs({y}), 1.0)"


def _planted_sql():
    found = " union all ".join(
        f"select '{y}' as target, '{f}' as formula, count(*) filter (where {_HIT.format(y=y, f=f)}) as k, count(({f}) - {y}) as n from s"
        for y, f in PLANTED
    )
    return f"""
with s as (select {", ".join(f"cast({c} as double) as {c}" for c in HUNT)} from {HUNT_FROM}),
u as ({found})
select target, formula, n as rows, round(100.0::double * k / n, 2) as pct from u where n > 0 and k / n >= 0.99"""


@register("identity_search_wide", _planted_sql())
def identity_search_wide(spark, sf_dir):
    """Sixty columns, 410,640 formulas: the planted identities and no others."""
    li = table(spark, sf_dir, "lineitem", heavy=True).withColumn("cut", F.col("l_extendedprice") * F.col("l_discount"))
    net = F.when(F.col("l_orderkey") % 997 == 0, 7.0).otherwise(F.col("l_extendedprice") - F.col("cut"))
    wide = li.withColumn("net", net).select(*HUNT, *[F.expr(e).alias(c) for c, e in NOISE_TERMS.items()])
    return profiler.identity_search(wide, HUNT + NOISE)
