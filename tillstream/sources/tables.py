"""Layer tables: <base>/<layer>/<name>."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillstream.schemas import EVENT_TYPES

DEFAULT_FORMAT = "parquet"


def layer_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}"


def quarantine_path(base: str, name: str) -> str:
    return layer_path(base, "silver/_quarantine", name)


def read_table(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read.format(fmt)
    # A Delta table carries its own schema and refuses one from outside.
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def read_layer(
    spark: SparkSession,
    base: str,
    layer: str,
    name: str,
    fmt: str = DEFAULT_FORMAT,
    schema: StructType | None = None,
) -> DataFrame:
    """Read one table of a layer.

    Bronze gets its schema from the contract: files written before a column was
    added read as NULL there, and no footers are opened to find the schema.
    """
    if schema is None and layer == "bronze":
        schema = EVENT_TYPES[name].bronze_table_schema
    return read_table(spark, layer_path(base, layer, name), fmt, schema)


def read_quarantine(
    spark: SparkSession, base: str, name: str, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """The rejected rows of an event type; ``failed_rules`` is NULL unless asked for."""
    return read_table(spark, quarantine_path(base, name), fmt, EVENT_TYPES[name].quarantine_schema)
