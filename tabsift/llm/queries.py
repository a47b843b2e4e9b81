"""One registered query per operator: whole tables in, the digest columns of its contract out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from . import bilinear, bpe_transducer, count_rtree, decontaminate, digest, html_text, language, merkle, quality, ranked_search, repeats, simhash, simple8b
from .common import remainder, table

QUERIES: dict = {}
CHECK_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike it is to that and to the next document."""
    docs = table(spark, sf_dir, "documents")
    return digest.compared(docs, digest.rarity(docs))


@query
def op2_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text and the text they decode to, as digests."""
    coded = bpe_transducer.encode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op4_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text written to Simple-8b files in id order and read back from them."""
    folder = fresh_path(spark, "ids")
    simple8b.write(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), end_id=1)
    return simple8b.read(spark, folder, digests=True)


@query
def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by additive tables learned from the labelled rows that are not held out."""
    numbers = quality.numbers_of(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 4) != 2)
    scored = quality.score(numbers, quality.train(numbers, labels)).withColumnRenamed("key", "doc_id")
    held = (remainder("doc_id", 4) == 2).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text that are left without strings of 100 bytes that start earlier as well."""
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op7_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every text by a log-bilinear model and by smoothed counts of the learning texts."""
    docs = table(spark, sf_dir, "documents")
    scored = bilinear.score(docs, *bilinear.learned(docs.filter(remainder("doc_id", 10) != 0)))
    return scored.select("doc_id", (remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by the nearest centroid, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(remainder("doc_id", 4) != 2))
    named = language.predict(docs, model)
    return named.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows inside documents, by Wu-Manber search."""
    found = decontaminate.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates through vantage-point trees: one row per document with its component."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of every document, folded from its text or, for a third of the ids, from a tampered one."""
    docs = table(spark, sf_dir, "documents")
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = {"text": F.translate("text", capitals, capitals.lower())}
    rows = merkle.leaves(docs, presented=tampered, where=remainder("doc_id", 3) == 0)
    found = merkle.manifest(rows).withColumnRenamed("key", "doc_id")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op12_count_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at least nine tenths of their three-word shingles in common: one row each with its component."""
    return count_rtree.linked(table(spark, sf_dir, "documents"))


@query
def op13_presence_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


CHECK_SQL["op6_repeats"] = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, i, md5(substr(h, 2 * i + 1, 200)) as s
      from (select doc_id, h, unnest(range(0, cast(length(h) // 2 - 99 as bigint))) as i from d where length(h) >= 200)),
late as (select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) as r from w) where r > 1),
starts as (select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i) > 100, true) as fresh from late),
runs as (select doc_id, i, sum(cast(fresh as int)) over (partition by doc_id order by i) as run from starts),
spans as (select doc_id, min(i) as a, max(i) + 100 as b from runs group by doc_id, run),
gaps as (
  select s.doc_id, s.a, s.b, coalesce(lag(s.b) over (partition by s.doc_id order by s.a), 0) as from_ from spans s),
kept as (
  select g.doc_id, string_agg(substr(d.h, 2 * g.from_ + 1, 2 * (g.a - g.from_)), '' order by g.a) as k,
         max(g.b) as last, sum(g.b - g.a) as n_removed, count(*) as n_spans
  from gaps g join d on d.doc_id = g.doc_id group by g.doc_id)
select d.doc_id, cast(length(d.h) // 2 as bigint) as n_bytes, cast(coalesce(k.n_removed, 0) as bigint) as n_removed,
       cast(coalesce(k.n_spans, 0) as bigint) as n_spans,
       sha256(unhex(case when k.doc_id is null then d.h else k.k || substr(d.h, 2 * k.last + 1) end)) as kept_sha256
from d left join kept k on k.doc_id = d.doc_id
"""

CHECK_SQL["op9_decontaminate"] = r"""
with b as (
  select cast(item_id as varchar) as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
bw as (
  select item, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i, least(10, len(w)) as m, w from b where len(w) > 0),
p as (select distinct item, m, array_to_string(w[i:i + m - 1], ' ') as win from bw),
lengths as (select distinct m from p),
wins as (select distinct m, win from p),
d as (
  select doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
dw as (select doc_id, m, unnest(range(1, len(w) - m + 2)) as i, w from d, lengths where len(w) >= m),
hits as (
  select dw.doc_id, dw.i, dw.m, wins.win from (select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as win from dw) dw
  join wins on dw.m = wins.m and dw.win = wins.win),
covered as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + m)) as j from hits) group by 1),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct h.doc_id, p.item from hits h join p on p.m = h.m and p.win = h.win) group by 1)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(c.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(f.n_items, 0) as bigint) as n_items, sha256(coalesce(f.ids, '')) as items_sha256,
       coalesce(c.n_hit, 0) > 0 as contaminated
from d left join covered c on c.doc_id = d.doc_id left join found f on f.doc_id = d.doc_id
"""

# Recursion goes up the levels of all trees at once, then folds the shown leaves along them; crc32 is spelled out bit by bit.
CHECK_SQL["op11_merkle"] = """
with recursive f as (
  select doc_id, lang, unnest([false, true]) as tampered,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as small, text, source, n_chars
  from documents),
h as (
  select doc_id, lang, tampered, sha256(array_to_string(list_transform(
    [cast(doc_id as varchar), source, lang, cast(n_chars as varchar), case when tampered then small else text end],
    lambda v: case when v is null then '-' else octet_length(encode(v)) || ':' || v end), '')) as leaf from f),
ids as (
  select doc_id, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(cast(doc_id as varchar)) + 1),
      lambda i: ord(substr(cast(doc_id as varchar), i, 1))::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) as crc from documents),
d as (
  select o.doc_id, coalesce('+' || o.lang, '') as tree, o.leaf,
         case when xor(i.crc, 4294967295) % 3 = 0 then t.leaf else o.leaf end as shown,
         row_number() over (partition by o.lang order by o.doc_id) - 1 as place
  from h o join h t on t.doc_id = o.doc_id and t.tampered and not o.tampered join ids i on i.doc_id = o.doc_id),
up as (
  select tree, 0 as level, place, leaf as node, count(*) over (partition by tree) as n from d
  union all
  select tree, level + 1, place // 8, sha256(string_agg(node, '' order by place)), (any_value(n) + 7) // 8 from up where n > 1 group by tree, level, place // 8),
tops as (select tree, row_number() over (order by tree) - 1 as place, node, level from up where n = 1),
top as (
  select 0 as level, place, node, count(*) over () as n from tops
  union all
  select level + 1, place // 8, sha256(string_agg(node, '' order by place)), (any_value(n) + 7) // 8 from top where n > 1 group by level, place // 8),
nodes as (
  select u.tree, u.level, u.place, u.node from up u where u.n > 1
  union all
  select t.tree, t.level + p.level, p.place, p.node from tops t, top p where p.n > 1),
starts as (select d.*, t.node as subroot, t.place as top_place, t.level as height, (select node from top where n = 1) as root from d join tops t using (tree)),
levels as (select tree, max(level) + 1 as n from nodes group by tree),
walk as (
  select s.doc_id, s.tree, 0 as level, s.place, s.shown as folded, '' as proof from starts s
  union all
  select w.doc_id, w.tree, w.level + 1, any_value(p.place) // 8,
         sha256(string_agg(case when o.place = p.place then w.folded else o.node end, '' order by o.place)),
         any_value(w.proof) || coalesce(string_agg(o.node, '' order by o.place) filter (where o.place <> p.place), '')
  from walk w join levels l on l.tree = w.tree and w.level < l.n
  join (select doc_id, height, top_place from starts) s on s.doc_id = w.doc_id,
  lateral (select case when w.level = s.height then s.top_place else w.place end as place) p
  join nodes o on o.tree = w.tree and o.level = w.level and o.place // 8 = p.place // 8
  group by w.doc_id, w.tree, w.level)
select s.doc_id, s.leaf, s.subroot, s.root, sha256(w.proof) as proof_sha256, w.folded as folded_root, w.folded = s.root as verified
from starts s join walk w on w.doc_id = s.doc_id left join levels l on l.tree = s.tree where w.level = coalesce(l.n, 0)
"""

CHECK_SQL["op13_presence_masks"] = r"""
with d as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark),
q as (select item_id, t, count(*) as r from b group by 1, 2),
c as (select count(*)::bigint as n, sum(len(w))::bigint as l from d where len(w) > 0),
p as (select doc_id, len(w) as n, t, count(*) as tf from (select doc_id, w, unnest(w) as t from d) where t in (select t from q) group by doc_id, w, t),
f as (select t, floor(1000 * ln((2 * (select n from c) + 2)::double / (2 * count(*) + 1)))::bigint as w from p group by t),
s as (
  select q.item_id, p.doc_id, sum(q.r * f.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (100 - 25 + (25 * p.n * c.n) // c.l))))::bigint as score
  from q join p using (t) join f using (t), c group by 1, 2),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from r where rank <= 20
"""
