"""From raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``, extra columns included. Each works on all that
its predecessor kept:

1. language: documents that language identification rejects go. The model is learned from the documents that are not
   held out and have a language.
2. near_duplicates: one document of each SimHash group stays, the one with the smallest id.
3. repeats: bytes in strings that start earlier as well go from the texts; what a cut leaves of a character goes too.
4. decontamination: documents with a benchmark window go.
5. tokens: the ids of every text that is left, and the text they decode to as a digest.

Where ids are missing or repeated, stage 2 keeps any one row of a group. A text that loses all its bytes stays as an
empty one. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsift.llm import bpe_transducer, decontaminate, language, repeats, simhash
from tabsift.llm.common import remainder, stage, table
from tabsift.llm.queries import vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near enough to a known language."""
    model = language.train(docs.filter(remainder("doc_id", 4) != 2))
    return language.keep_known(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    # Own names beside the whole row as one value, so that no column of the table can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    packed = docs.select(row, F.col("doc_id").alias("id"), F.col("text").alias("text"))
    unclear = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1).count() > 0
    if unclear:  # rows without an id, or with the same: a number per row tells them apart
        packed = stage(packed.withColumn("id", F.monotonically_increasing_id()), "rows")
    grouped = simhash.near_duplicates(packed, "id")
    copies = grouped.filter(F.col("id") != F.col("component_id")).select("id")
    return packed.join(copies, "id", "left_anti").select("row.*")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that start earlier as well, and their new length where ``n_chars`` holds it."""
    clean = repeats.cleaned(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digest of what they decode to."""
    coded = bpe_transducer.encode(docs, vocabulary("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("repeats", without_repeats),
    ("decontamination", decontaminated),
    ("tokens", tokens),
]

# Language models, component search and transducers are beyond SQL; tests hold every stage to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name)
    return docs
