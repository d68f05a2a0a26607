"""KPI rows as keyed documents: ids, JSON encoding, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.times import iso_string
from tillstream.operators.dedup import dedup_latest
from tillstream.schemas import KPI_KEYS


def _is_timestamp(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))


def _id_part(column: Column) -> Column:
    """A key value as id text; `_` and `%` are escaped so that ids stay apart."""
    text = F.replace(F.replace(column, F.lit("%"), F.lit("%25")), F.lit("_"), F.lit("%5F"))
    text = F.when(text == "None", F.lit("%4Eone")).otherwise(text)
    return F.coalesce(text, F.lit("None"))


def with_doc_id(
    kpi: DataFrame, kpi_type: str, key_columns: Sequence[str] | None = None
) -> DataFrame:
    """Add ``id``: the KPI type and every key, unless the rows have an id already."""
    if "id" in kpi.columns:
        return kpi
    keys = KPI_KEYS[kpi_type] if key_columns is None else key_columns
    parts = []
    for name in keys:
        timestamp = _is_timestamp(kpi.schema[name])
        parts.append(_id_part(iso_string(F.col(name)) if timestamp else F.col(name).cast("string")))
    return kpi.withColumn("id", F.concat_ws("_", F.lit(kpi_type), *parts))


def to_documents(
    kpi: DataFrame, kpi_type: str, key_columns: Sequence[str] | None = None
) -> DataFrame:
    """One JSON document per row as (kpi_type, id, doc).

    Timestamps become ISO text, missing values stay as JSON nulls, nested rows
    become nested objects.
    """
    rows = with_doc_id(kpi, kpi_type, key_columns).withColumn("kpi_type", F.lit(kpi_type))
    fields = [
        iso_string(F.col(f.name)).alias(f.name) if _is_timestamp(f) else F.col(f.name)
        for f in rows.schema.fields
    ]
    doc = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return rows.select("kpi_type", "id", doc.alias("doc"))


def upsert_kpis(
    existing: DataFrame,
    updates: DataFrame,
    keys: Sequence[str] = ("kpi_type", "id"),
    order: Sequence[str] = ("computed_at",),
) -> DataFrame:
    """Existing rows, replaced by or joined with the updates of the same key.

    When several updates share a key the last in ``order`` wins, and the greatest
    row among equals. Columns either side lacks are NULL in its rows. Both sides go
    through one exchange, on the keys; neither is computed twice.
    """
    both = existing.withColumn("_fresh", F.lit(0)).unionByName(
        updates.withColumn("_fresh", F.lit(1)), allowMissingColumns=True
    )
    rest = [c for c in updates.columns if c not in keys and c not in order]
    return dedup_latest(both, keys, ["_fresh", *order, *rest]).drop("_fresh")
