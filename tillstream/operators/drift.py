"""Fields of raw records that the contract does not name, or cannot read."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.schemas import EventSpec

UNDECLARED, UNREADABLE = "undeclared", "unreadable"


def _parsed(bronze: DataFrame) -> DataFrame:
    """Raw records as VARIANT: any JSON, with its own types; null where there is none.

    A filter of ``_raw`` would be carried down to where it is made, and make it twice.
    """
    return bronze.select(F.try_parse_json("_raw").alias("_record"))


def _fields(records: DataFrame) -> DataFrame:
    """One row per field of each record's objects that has a value: ``level``, ``key``, ``value``."""
    spark = records.sparkSession
    fields = spark.sql(
        "select level, key, value from {records}, lateral variant_explode(object)", records=records
    )
    return fields.filter(F.col("key").isNotNull() & ~F.is_variant_null("value"))


def _unreadable(kind: str) -> Column:
    """Whether ``value``, which comes from JSON, has no form of this kind.

    Text can be made of any value, and a double of any number. Only the others are
    converted to find out, which costs far more than a look at the type.
    """
    if kind == "string":
        return F.lit(False)
    fails = F.try_variant_get("value", "$", kind).isNull()
    if kind != "double":
        return fails
    found = F.substring_index(F.schema_of_variant("value"), "(", 1)
    return ~found.isin("BIGINT", "DECIMAL", "DOUBLE") & fails


def _finding(schema: T.StructType) -> Column:
    """What is wrong with a field of an object, null for nothing."""
    key = F.col("key")
    by_kind: dict[str, list[str]] = {}
    for field in schema.fields:
        if not isinstance(field.dataType, T.StructType):
            by_kind.setdefault(field.dataType.simpleString(), []).append(field.name)
    each = [key.isin(*names) & _unreadable(kind) for kind, names in by_kind.items()]
    unreadable = reduce(Column.__or__, each, F.lit(False))
    unknown = ~key.isin(*schema.names)
    return F.when(unknown, F.lit(UNDECLARED)).when(unreadable, F.lit(UNREADABLE))


def drift_report(bronze: DataFrame, spec: EventSpec) -> DataFrame:
    """Fields of ``_raw`` that the event type does not name, or whose values it cannot read.

    One row per ``path``, JSON ``type`` and ``finding``, with the number of ``rows``. Nested
    objects of the contract are looked into. Null values count as missing. Records that
    are not JSON objects have no fields. Each record is parsed once, for all its objects,
    and tasks count their fields before any shuffle.
    """
    levels, objects = {"": spec.schema}, {"": F.col("_record")}
    for field in spec.schema.fields:
        if isinstance(field.dataType, T.StructType):
            levels[f"{field.name}."] = field.dataType
            objects[f"{field.name}."] = F.try_variant_get("_record", f"$.{field.name}", "variant")
    each = [F.struct(F.lit(p).alias("level"), o.alias("object")) for p, o in objects.items()]
    fields = _fields(_parsed(bronze).select(F.inline(F.array(*each))))
    level = F.col("level")
    finding = F.coalesce(*[F.when(level == p, _finding(schema)) for p, schema in levels.items()])
    found = fields.withColumn("finding", finding).filter(F.col("finding").isNotNull())
    path, kind = F.concat("level", "key").alias("path"), F.schema_of_variant("value").alias("type")
    return found.groupBy(path, kind, "finding").agg(F.count("*").alias("rows"))


def record_schema(bronze: DataFrame) -> DataFrame:
    """The merged schema of all raw records, as one row ``schema``."""
    return _parsed(bronze).agg(F.schema_of_variant_agg("_record").alias("schema"))


def with_raw_fields(bronze: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add fields of the raw records as columns: by name, the path and the type of each.

    A value is null where it is missing or of another type. The record is parsed once
    for all fields. They come out of a generator, below which no filter of them is
    carried, as it would parse the record a second time.
    """
    values = [
        F.try_variant_get("_record", f"$.{path}", kind).alias(f"_{i}")
        for i, (path, kind) in enumerate(fields.values())
    ]
    parsed = bronze.withColumn("_record", F.try_parse_json("_raw"))
    read = parsed.withColumn("_read", F.explode(F.array(F.struct(*values))))
    named = {name: F.col(f"_read._{i}") for i, name in enumerate(fields)}
    return read.withColumns(named).drop("_record", "_read")


def with_raw_field(bronze: DataFrame, path: str, kind: str, into: str | None = None) -> DataFrame:
    """Add a field of the raw records as a column; null where it is missing or of another type.

    ``path`` is as in the report, e.g. ``coupon`` or ``product.brand``.
    """
    return with_raw_fields(bronze, {into or path.replace(".", "_"): (path, kind)})
