"""Base tables and the derived views that put known defects into them.

Each view is one SQL text that Spark and the checking engine both run, keyed on
the row's own values, so both see the same dirt on every row of the table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import spread

VIEWS: dict[str, str] = {
    "lineitem_dirty": """
select l_orderkey, l_linenumber, l_partkey, l_quantity as area_total,
 case when l_orderkey % 89 = 0 then l_quantity * 10000
      when l_orderkey % 101 = 0 then 0.0 else l_quantity end as area_util,
 case when l_orderkey % 97 = 0 then l_extendedprice * 1000
      when l_orderkey % 103 = 0 then null else l_extendedprice end as price,
 case when l_orderkey % 7 = 0 then null else l_tax end as fee,
 l_discount, l_returnflag, 'REAL' as contract_type,
 case when l_orderkey = 0 then 'B' else 'A' end as city
from {lineitem}""",
    "supplier_geo": """
select s_suppkey,
 case when s_suppkey % 5 = 0 then cast(null as double)
      when s_suppkey % 41 = 1 then -49.0 - s_nationkey / 100.0 else -16.0 - s_nationkey / 100.0 end as latitude,
 case when s_suppkey % 5 = 0 then cast(null as double)
      when s_suppkey % 41 = 1 then -16.0 - s_nationkey / 100.0 else -49.0 - s_nationkey / 100.0 end as longitude
from {supplier}""",
    "part_titles": """
select p_partkey, p_retailprice as price, p_size, p_type, p_brand,
 concat(case when p_partkey % 6 = 0 then 'GALPÃO ' when p_partkey % 6 = 1 then 'galpao '
             when p_partkey % 6 = 2 then 'Casa '   when p_partkey % 6 = 3 then 'Sala ' else '' end,
        p_name,
        case when p_partkey % 29 = 0 then ' com piscina' else '' end,
        case when p_partkey % 50 = 0 then concat(' R$ ', cast(cast(p_retailprice as int) as string), ',00')
             when p_partkey % 50 = 10 then concat(' R$', cast(cast(p_retailprice as int) as string), '.00')
             when p_partkey % 50 = 20 then ' R$ 1.234.567,89'
             when p_partkey % 500 = 30 then ' R$ .00' else '' end) as title
from {part}""",
    "envelopes": """
select event_id, ts,
 concat('{{"headers":{{"content-type":"application/json"}},"query":{{}},"body":{{"user":', cast(user_id as string),
  ',"E-mail do aluno":"u', cast(user_id as string), '@x","garagem":',
  case when event_id % 11 = 0 then 'null' when event_id % 13 = 0 then '0' else cast(event_id % 5 as string) end,
  ',"status":"', case when event_id % 3 = 0 then '' else event_type end,
  '","quartos":[', cast(event_id % 4 as string), '],"address":{{"city":"C', cast(user_id % 7 as string), '"}}}}}}') as raw
from {events}""",
    "sentences": """
select p_partkey, p_brand,
 concat('quero um ', case when p_partkey % 3 = 0 then 'apartamento' when p_partkey % 3 = 1 then 'casa' else 'lote' end,
  case when p_partkey % 3 = 2 then '' else concat(' de ', cast(p_size % 5 + 1 as string), ' quartos') end,
  ' no ', p_brand,
  case when p_partkey % 4 = 0 then '' else concat(', uns ', cast(p_size * 3 as string), ' metros') end) as msg
from {part}""",
    "orders_copied": """
select o_orderkey as id, o_custkey as buyer, o_orderdate as day, o_totalprice as price, o_orderpriority as priority from {orders}
union all
select o_orderkey + 1000000000000, o_custkey, o_orderdate, o_totalprice * 10, o_orderpriority from {orders} where o_orderkey % 40 = 7
union all
select o_orderkey + 2000000000000, null, o_orderdate, o_totalprice * 10, o_orderpriority from {orders} where o_orderkey % 80 = 7""",
    "label_text": """
select l.doc_id, d.text, d.lang, d.n_chars, l.quality, l.toxic
from {documents} d join {labels} l on d.doc_id = l.doc_id""",
}


def table(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """A whole base table; ``heavy`` work per row is spread when the file is one split."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if heavy else rows


def _bases(text: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text)))


def view(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """A derived view over the whole base table."""
    text = VIEWS[name]
    return spark.sql(text, **{b: table(spark, sf_dir, b, heavy) for b in _bases(text)})


def with_views(names: str, body: str) -> str:
    """Check SQL that starts from the named derived views."""
    ctes = []
    for name in names.split():
        text = VIEWS[name]
        ctes.append(f"{name} as ({text.format(**{b: b for b in _bases(text)})})")
    body = body.strip()
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body


def decimal_round(expr: str, digits: int) -> str:
    """Check SQL that rounds the printed decimal half up, as Spark rounds doubles."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38, 18)), {digits}) as double)"
