"""Streams over whole tables: messages typed, defaulted, scored, cleaned."""

from pyspark.sql import functions as F

from ..functions import json_fields as J
from ..modelling import models
from ..session import fresh_path
from ..streaming import messages
from .q_rules_audit import GOLD_SQL, gold_rules
from .registry import register
from .views import table, view, with_views

FIELDS = {"user_id": (("user",), "bigint"), "garagem": (("garagem",), "bigint"), "quartos": (("quartos", 0), "bigint")}


@register(
    "stream_score",
    with_views(
        "envelopes",
        """
with l as (select regr_slope(value, user_id) as b, regr_intercept(value, user_id) as a from events)
select event_id, try_cast(raw ->> '$.body.user' as bigint) as user_id,
 round(a + b * try_cast(raw ->> '$.body.user' as bigint), 4) as predicted_value from envelopes, l""",
    ),
)
def stream_score(spark, sf_dir):
    """Envelope in, typed field out, model applied: the batch model inside a stream."""
    model = models.train(table(spark, sf_dir, "events").select("value", "user_id"), "LINEAR_REG", "value", split_method="NONE")
    inbox, out, marks = (fresh_path(spark, n) for n in ("inbox", "scored", "marks"))
    view(spark, sf_dir, "envelopes").repartition(4).write.parquet(inbox)
    arriving = messages.open_stream(spark, inbox, "event_id bigint, ts timestamp_ntz, raw string", files_per_trigger=2)
    typed = messages.unwrap(arriving, "raw", FIELDS, keep=("event_id",))
    messages.run_once(messages.score(typed, model).select("event_id", "user_id", "predicted_value"), out, marks)
    return spark.read.parquet(out).withColumn("predicted_value", F.round("predicted_value", 4))


@register(
    "stream_gold",
    with_views(
        "lineitem_dirty",
        f"""
select not coalesce({GOLD_SQL}, false) as quarantined, l_returnflag, count(*) as rows, round(sum(price), 2) as total
from lineitem_dirty group by 1, 2""",
    ),
)
def stream_gold(spark, sf_dir):
    inbox, out, marks = (fresh_path(spark, n) for n in ("inbox", "cleaned", "marks"))
    rows = view(spark, sf_dir, "lineitem_dirty").select("l_returnflag", "price", "area_util")
    rows.repartition(6).write.parquet(inbox)
    messages.clean_stream(messages.open_stream(spark, inbox, rows.schema, files_per_trigger=2), gold_rules(), out, marks)
    done = messages.read_cleaned(spark, out)
    return done.groupBy("quarantined", "l_returnflag").agg(F.count("*").alias("rows"), F.round(F.sum("price"), 2).alias("total"))


@register(
    "default_before_score",
    with_views(
        "envelopes",
        """
with f as (select event_id, try_cast(raw ->> '$.body.garagem' as bigint) as g from envelopes)
select event_id, coalesce(g, 2) as garagem, g is not null and g = 0 as zero_kept from f""",
    ),
)
def default_before_score(spark, sf_dir):
    inbox, out, marks = (fresh_path(spark, n) for n in ("inbox", "filled", "marks"))
    view(spark, sf_dir, "envelopes").write.parquet(inbox)
    arriving = messages.open_stream(spark, inbox, "event_id bigint, ts timestamp_ntz, raw string")
    typed = messages.fill(messages.unwrap(arriving, "raw", FIELDS, keep=("event_id", "raw")), {"garagem": 2})
    told = J.body("raw", "garagem").try_cast("bigint")
    zero = F.coalesce((told == 0) & (F.col("garagem") == 0), F.lit(False))
    messages.run_once(typed.select("event_id", "garagem", zero.alias("zero_kept")), out, marks)
    return spark.read.parquet(out)


@register(
    "extract_fields",
    with_views(
        "sentences",
        r"""
select p_partkey, nullif(regexp_extract(lower(msg), '(apartamento|casa|lote)', 1), '') as kind,
 try_cast(nullif(regexp_extract(lower(msg), '(\d+) quartos?', 1), '') as bigint) as rooms,
 try_cast(nullif(regexp_extract(lower(msg), '(\d+) metros', 1), '') as bigint) as metres, p_brand as district from sentences""",
    ),
)
def extract_fields(spark, sf_dir):
    said = view(spark, sf_dir, "sentences")
    found = messages.extract_fields(said.drop("p_brand"), "msg", table(spark, sf_dir, "part").select("p_brand"), "p_brand")
    return found.drop("msg")
