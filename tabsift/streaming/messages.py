"""Messages as a stream: unwrap, default, score, and clean with the same rules as batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import json_fields, scalars
from ..modelling.models import Model, predict
from ..operators.rules import Rule, with_failures
from ..session import broadcast_if_small

# How a request names the kind, the rooms and the size it wants.
KIND = r"(apartamento|casa|lote)"
ROOMS = r"(\d+) quartos?"
METRES = r"(\d+) metros"


def open_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of parquet files read as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def unwrap(messages: DataFrame, raw: str, fields: Mapping[str, tuple[tuple, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Typed fields of the payload: ``{column: (path steps below body, type)}``."""
    return messages.select(*keep, *[json_fields.body(raw, *steps).try_cast(t).alias(c) for c, (steps, t) in fields.items()])


def fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Defaults for missing fields only: zero garages stay zero."""
    return df.withColumns({c: json_fields.default_if_missing(F.col(c), v) for c, v in defaults.items()})


def extract_fields(df: DataFrame, text: str, districts: DataFrame, district: str) -> DataFrame:
    """Kind, rooms, size and district named in a sentence; what is not said stays NULL.

    The district is whatever follows "no" and is a known one.
    """
    low = F.lower(text)
    known = broadcast_if_small(districts.select(F.col(district).alias("district"), F.lower(district).alias("_said")).distinct())
    said = scalars.capture(low, r"(?:^|\s)no ([^,]+?)\s*(?:,|$)")
    out = df.withColumns(
        {
            "kind": scalars.capture(low, KIND),
            "rooms": scalars.capture(low, ROOMS).try_cast("bigint"),
            "metres": scalars.capture(low, METRES).try_cast("bigint"),
            "_said": said,
        }
    )
    return out.join(known, "_said", "left").drop("_said")


def score(messages: DataFrame, model: Model) -> DataFrame:
    """Predictions of a stored model; the same call on a stream and on a table."""
    return predict(model, messages)


def run_once(df: DataFrame, path: str, checkpoint: str) -> None:
    """Process what has arrived and stop; restarting continues after it."""
    query = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    finish(query)


def clean_stream(df: DataFrame, rules: Sequence[Rule], path: str, checkpoint: str) -> None:
    """Split arriving rows into gold and quarantine with the batch rules.

    Each micro-batch is read and written once, into a folder of its own that a
    re-run replaces, so a lost executor or driver leaves no duplicate. Inside it
    ``quarantined`` is a partition: readers of gold never open rejected rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = with_failures(batch, rules).withColumn("quarantined", F.size("failed_rules") > 0)
        marked.write.mode("overwrite").partitionBy("quarantined").parquet(f"{path}/batch={batch_id}")

    finish(df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """All cleaned rows with a true boolean ``quarantined`` (a folder name is text)."""
    return spark.read.parquet(path).withColumn("quarantined", F.col("quarantined").cast("boolean"))


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
