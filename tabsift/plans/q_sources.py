"""JSON fields, CSV round trips, bronze to silver, items and scalar helpers."""

from pyspark.sql import functions as F

from ..functions import json_fields as J
from ..functions import scalars as S
from ..operators import items
from ..session import fresh_path
from ..sources import csv_files, json_paths, medallion
from .registry import register
from .views import decimal_round, table, view, with_views


@register(
    "json_value",
    "select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events",
)
def json_value(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", J.value("props", "k").try_cast("bigint").alias("k"))


@register(
    "json_defaults",
    with_views(
        "envelopes",
        """
with f as (select event_id, try_cast(raw ->> '$.body.garagem' as bigint) as g, raw ->> '$.body.status' as s from envelopes)
select event_id, coalesce(g, 1) as spaces_if_missing, case when g is null or g = 0 then 1 else g end as spaces_if_blank,
 coalesce(s, 'pendente') as status_if_missing, case when s is null or s = '' then 'pendente' else s end as status_if_blank from f""",
    ),
)
def json_defaults(spark, sf_dir):
    d = view(spark, sf_dir, "envelopes").select(
        "event_id", J.body("raw", "garagem").try_cast("bigint").alias("g"), J.body("raw", "status").alias("s")
    )
    return d.select(
        "event_id",
        J.default_if_missing(F.col("g"), 1).alias("spaces_if_missing"),
        J.default_if_blank(F.col("g"), 1).alias("spaces_if_blank"),
        J.default_if_missing(F.col("s"), "pendente").alias("status_if_missing"),
        J.default_if_blank(F.col("s"), "pendente").alias("status_if_blank"),
    )


@register(
    "envelope",
    with_views(
        "envelopes",
        """
select event_id, raw ->> '$.user' as at_root, try_cast(raw ->> '$.body.user' as bigint) as in_body,
 raw ->> '$.body."E-mail do aluno"' as mail, raw ->> '$.body.address.city' as city,
 try_cast(raw ->> '$.body.quartos[0]' as bigint) as quartos, try_cast(raw ->> '$.body.quartos' as bigint) as quartos_uncut
from envelopes""",
    ),
)
def envelope(spark, sf_dir):
    return view(spark, sf_dir, "envelopes", heavy=True).select(
        "event_id",
        J.value("raw", "user").alias("at_root"),
        J.body("raw", "user").try_cast("bigint").alias("in_body"),
        J.body("raw", "E-mail do aluno").alias("mail"),
        J.value("raw", "$.body.address.city").alias("city"),
        J.one_of_list("raw", "body", "quartos").alias("quartos"),
        J.body("raw", "quartos").try_cast("bigint").alias("quartos_uncut"),
    )


def _path_sql(shown, at):
    v = f"raw ->> '{at}'"
    return f"""select '{shown}' as path, count({v}) as filled, count(*) as rows,
 round(100.0 * count({v}) / count(*), 1) as pct, count(distinct {v}) <= 1 as is_constant from envelopes"""


PATHS = {
    "body.E-mail do aluno": '$.body."E-mail do aluno"',
    "body.address.city": "$.body.address.city",
    "body.garagem": "$.body.garagem",
    "body.quartos[]": "$.body.quartos[0]",
    "body.status": "$.body.status",
    "body.user": "$.body.user",
    "headers.content-type": '$.headers."content-type"',
    "query": "$.query",
}


@register("json_path_profile", with_views("envelopes", " union all ".join(_path_sql(s, a) for s, a in PATHS.items())))
def json_path_profile(spark, sf_dir):
    return json_paths.inventory(view(spark, sf_dir, "envelopes", heavy=True), "raw").select("path", "filled", "rows", "pct", "is_constant")


@register("csv_json_roundtrip", with_views("envelopes", "select event_id, cast(ts as varchar) as ts, raw from envelopes"))
def csv_json_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "csv")
    csv_files.write_csv(view(spark, sf_dir, "envelopes").withColumn("ts", F.col("ts").cast("string")), path)
    return csv_files.read_csv(spark, path, schema="event_id bigint, ts string, raw string", multiline=True)


@register(
    "csv_multiline_text",
    "select doc_id, sha256(text) as digest, cast(length(text) as bigint) as chars from documents",
)
def csv_multiline_text(spark, sf_dir):
    path = fresh_path(spark, "csv")
    csv_files.write_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), path, sep="|")
    back = csv_files.read_csv(spark, path, sep="|", schema="doc_id bigint, text string", multiline=True)
    return back.select("doc_id", F.sha2("text", 256).alias("digest"), F.length("text").cast("bigint").alias("chars"))


@register(
    "sniff_delimiter",
    """
select d.sep, o_orderstatus, count(*) as rows, round(sum(o_totalprice), 2) as total
from orders, (values (','), (';'), (chr(9)), ('|')) d(sep) group by 1, 2""",
)
def sniff_delimiter(spark, sf_dir):
    out = None
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for sep in csv_files.SEPARATORS:
        path = fresh_path(spark, "sniff")
        csv_files.write_csv(orders, path, sep)
        seen = csv_files.sniff_delimiter(spark, path)
        back = csv_files.read_csv(spark, path, seen, schema="o_orderkey bigint, o_orderstatus string, o_totalprice double")
        part = back.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))
        part = part.withColumn("sep", F.lit(seen))
        out = part if out is None else out.unionByName(part)
    return out


@register(
    "corrupt_rows_kept",
    """
select o_orderkey % 10 = 3 as broken, count(*) as rows, count(case when o_orderkey % 10 <> 3 then o_totalprice end) as typed
from orders group by 1""",
)
def corrupt_rows_kept(spark, sf_dir):
    """Every tenth price is written as text: the rows survive, marked, with a NULL price."""
    path = fresh_path(spark, "corrupt")
    price = F.when(F.col("o_orderkey") % 10 == 3, F.lit("n/d")).otherwise(F.col("o_totalprice").cast("string"))
    csv_files.write_csv(table(spark, sf_dir, "orders").select("o_orderkey", price.alias("o_totalprice")), path)
    back = csv_files.read_csv(spark, path, schema="o_orderkey bigint, o_totalprice double", keep_corrupt=True)
    return back.groupBy(F.col(csv_files.CORRUPT).isNotNull().alias("broken")).agg(
        F.count("*").alias("rows"), F.count("o_totalprice").alias("typed")
    )


SILVER = {
    "user_id": ("$.body.user", "bigint"),
    "mail": ("$.body['E-mail do aluno']", "string"),
    "garagem": ("$.body.garagem", "bigint"),
    "quartos": ("$.body.quartos[0]", "bigint"),
    "city": ("$.body.address.city", "string"),
    "status_as_number": ("$.body.status", "bigint"),
}


@register(
    "silver_typed",
    with_views(
        "envelopes",
        """
select event_id, try_cast(raw ->> '$.body.user' as bigint) as user_id, raw ->> '$.body."E-mail do aluno"' as mail,
 try_cast(raw ->> '$.body.garagem' as bigint) as garagem, try_cast(raw ->> '$.body.quartos[0]' as bigint) as quartos,
 raw ->> '$.body.address.city' as city, try_cast(raw ->> '$.body.status' as bigint) as status_as_number from envelopes""",
    ),
)
def silver_typed(spark, sf_dir):
    bronze = fresh_path(spark, "bronze")
    medallion.to_bronze(view(spark, sf_dir, "envelopes", heavy=True).select("event_id", "raw"), bronze)
    return medallion.to_silver(spark.read.parquet(bronze), "raw", SILVER, keep=("event_id",))


@register(
    "table_overwrite",
    """
select o_orderpriority, count(*) as rows, round(avg(o_totalprice), 2) as mean_price from orders
where o_totalprice >= 1000 group by 1""",
)
def table_overwrite(spark, sf_dir):
    """Built twice under one name: the second build replaces the first."""
    path = fresh_path(spark, "gold")
    name = "tabsift_" + path.rsplit("-", 1)[1]
    orders = table(spark, sf_dir, "orders")
    medallion.replace_table(orders, name, path)
    medallion.replace_table(orders.where("o_totalprice >= 1000"), name, path)
    return medallion.query(
        spark,
        "select o_orderpriority, count(*) as rows, round(avg(o_totalprice), 2) as mean_price from identifier(:t) group by 1",
        t=name,
    )


@register(
    "item_pairing",
    """
with c as (select min(ts) as started, count(*) as items from events)
select event_type, count(*) as n, max(items) as items, max(first_user) as first_user
from events, c, (select user_id as first_user from events order by event_id limit 1) group by 1""",
)
def item_pairing(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    config = items.first_item(ev, "event_id").select("user_id")
    step = items.with_config(ev, config, {"first_user": "user_id"})
    step = items.with_config(step, items.count_items(ev), {"items": "items"})
    return step.groupBy("event_type").agg(F.count("*").alias("n"), F.max("items").alias("items"), F.max("first_user").alias("first_user"))


@register(
    "projection_variants",
    with_views(
        "lineitem_dirty",
        """
select l_orderkey, l_linenumber, l_partkey, area_util, price, fee, l_discount, l_returnflag,
 fee is not null as has_fee, price / nullif(area_util, 0) as per_unit
from lineitem_dirty where l_returnflag = 'R' and (price < 5000 or price is null)""",
    ),
)
def projection_variants(spark, sf_dir):
    d = view(spark, sf_dir, "lineitem_dirty").drop("contract_type", "city", "area_total")
    d = d.where("l_returnflag = 'R'").where((F.col("price") < 5000) | F.col("price").isNull())
    return d.withColumns(
        {"has_fee": F.col("fee").isNotNull(), "per_unit": F.try_divide(F.col("price"), F.col("area_util"))}
    )


@register(
    "scalar_battery",
    with_views(
        "part_titles",
        f"select p_partkey, {decimal_round('price / p_size', 1)} as r1, "
        r"""
abs(price - 1000) as gap, cast(round(price) as bigint) as whole,
 case when price between 900 and 950 then 'low' when p_type is null or p_type != 'ECONOMY' then 'other' else 'eco' end as band,
 lower(title) as low, title like '%,%' as has_comma, length(title) as chars,
 try_cast(replace(replace(nullif(regexp_extract(title, '([0-9.]+,[0-9]+)', 1), ''), '.', ''), ',', '.') as double) as with_comma,
 list_extract(string_split(p_brand, '#'), 2) as brand_no, list_extract(string_split(p_brand, '#'), 9) as past_end,
 abs(price - price * 1.0005) <= 1e-3 * greatest(abs(price), abs(price * 1.0005), 1) as close,
 abs(price - price * 1.01) <= 1e-3 * greatest(abs(price), abs(price * 1.01), 1) as far
from part_titles""",
    ),
)
def scalar_battery(spark, sf_dir):
    price = F.col("price")
    band = (
        F.when(price.between(900, 950), "low")
        .when(F.col("p_type").isNull() | (F.col("p_type") != "ECONOMY"), "other")
        .otherwise("eco")
    )
    return view(spark, sf_dir, "part_titles").select(
        "p_partkey",
        F.round(price / F.col("p_size"), 1).alias("r1"),
        F.abs(price - 1000).alias("gap"),
        S.rounded_int(price).alias("whole"),
        band.alias("band"),
        F.lower("title").alias("low"),
        F.col("title").like("%,%").alias("has_comma"),
        F.length("title").alias("chars"),
        S.parse_amount(S.capture("title", "([0-9.]+,[0-9]+)")).alias("with_comma"),
        items.element(F.split("p_brand", "#"), 1).alias("brand_no"),
        items.element(F.split("p_brand", "#"), 8).alias("past_end"),
        S.nearly_equal(price, price * 1.0005).alias("close"),
        S.nearly_equal(price, price * 1.01).alias("far"),
    )


@register(
    "date_battery",
    """
with t as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso, strftime(o_orderdate, '%d/%m/%Y') as dmy,
 date_trunc('month', o_orderdate) as m from orders)
select cast(m as date) as month, count(*) as rows, count(*) as iso_dates, count(*) as dmy_dates, 0::bigint as other_dates
from t group by 1""",
)
def date_battery(spark, sf_dir):
    when = F.col("o_orderdate")
    t = table(spark, sf_dir, "orders").select(
        F.date_format(when, "yyyy-MM-dd").alias("iso"),
        F.date_format(when, "dd/MM/yyyy").alias("dmy"),
        F.concat(F.lit("pedido "), F.col("o_orderkey").cast("string")).alias("other"),
    )
    same = S.parse_date("iso").eqNullSafe(S.parse_date("dmy"))
    return t.groupBy(S.month_of(S.parse_date("dmy")).alias("month")).agg(
        F.count("*").alias("rows"),
        F.count_if(S.looks_like_date("iso")).alias("iso_dates"),
        F.count_if(S.looks_like_date("dmy") & same).alias("dmy_dates"),
        F.count_if(S.looks_like_date("other")).alias("other_dates"),
    )


@register(
    "number_battery",
    """
with t as (select printf('R$ %.2f', o_totalprice) as money, replace(printf('%.2f', o_totalprice), '.', ',') as comma,
 case o_orderstatus when 'F' then 'N/A' when 'O' then '-' else 'abc' end as junk, o_totalprice as x, o_orderstatus from orders)
select o_orderstatus, count(*) as rows, round(sum(x), 2) as from_money, round(sum(x), 2) as from_comma, 0::bigint as from_junk
from t group by 1""",
)
def number_battery(spark, sf_dir):
    x = F.col("o_totalprice")
    t = table(spark, sf_dir, "orders").select(
        "o_orderstatus",
        F.format_string("R$ %.2f", x).alias("money"),
        F.replace(F.format_string("%.2f", x), F.lit("."), F.lit(",")).alias("comma"),
        F.when(F.col("o_orderstatus") == "F", "N/A").when(F.col("o_orderstatus") == "O", "-").otherwise("abc").alias("junk"),
    )
    return t.groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"),
        F.round(F.sum(S.parse_number("money")), 2).alias("from_money"),
        F.round(F.sum(S.parse_number("comma")), 2).alias("from_comma"),
        F.count(S.parse_number("junk")).alias("from_junk"),
    )
