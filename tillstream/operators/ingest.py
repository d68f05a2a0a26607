"""Topic record -> bronze row, and the way back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.times import processing_time
from tillstream.schemas import EventSpec


def parse_events(records: DataFrame, spec: EventSpec, keep_raw: bool = True) -> DataFrame:
    """Decode JSON values into the event's columns, keeping the source columns.

    A record that is not JSON gives a row of NULLs. ``_raw`` then still holds what
    arrived; it is a column of its own, so reads that do not ask for it skip it.
    """
    text = F.col("value").cast("string")
    source = ["offset", "partition", F.col("timestamp").alias("_record_time")]
    raw = [text.alias("_raw")] if keep_raw else []
    decoded = records.select(F.from_json(text, spec.schema).alias("data"), *source, *raw)
    return decoded.select("data.*", "offset", "partition", "_record_time", *(["_raw"] if raw else []))


def with_ingest_metadata(events: DataFrame, spec: EventSpec) -> DataFrame:
    """Name the source columns as bronze does and add ingest time and event type."""
    kept = [c for c in events.columns if c not in ("offset", "partition", "_record_time", "_raw")]
    raw = ["_raw"] if "_raw" in events.columns else []
    return events.select(
        *kept,
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.col("_record_time").alias("kafka_timestamp"),
        processing_time().alias("ingested_at"),
        F.lit(spec.name).alias("source_topic"),
        *raw,
    )


def to_bronze(records: DataFrame, spec: EventSpec, keep_raw: bool = True) -> DataFrame:
    return with_ingest_metadata(parse_events(records, spec, keep_raw), spec)


def to_records(
    events: DataFrame, key_columns: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Encode rows as keyed JSON records, ready for a topic or a file sink.

    The key is the first of ``key_columns`` that is neither NULL nor empty. Columns
    named in ``keep`` stay next to the record instead of going into it.
    """
    key = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in key_columns])
    fields = [c for c in events.columns if c not in keep]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return events.select(
        key.cast("binary").alias("key"), value.cast("binary").alias("value"), *keep
    )
