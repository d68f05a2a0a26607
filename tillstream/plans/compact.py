"""Closed dates of bronze -> copies in few large files, which silver rebuilds read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstream import session
from tillstream.plans.changes import read_if_there
from tillstream.schemas import ARRIVAL_DATE, EVENT_TYPES
from tillstream.sources.tables import DEFAULT_FORMAT, layer_path, read_layer, read_table

FILE_BYTES = 512 * session.MIB
# A date is copied once so many whole days lie between it and today: batches that
# began on the date have been committed by then.
SETTLED_DAYS = 1


def compact_path(base: str, event_type: str) -> str:
    return layer_path(base, "bronze_compact", event_type)


def compacted_dates(spark: SparkSession, base: str, event_type: str) -> list[date]:
    """The arrival dates whose copy is complete, in order; one per day of the table."""
    notes = read_if_there(
        spark, layer_path(base, "bronze_compact/_dates", event_type), f"{ARRIVAL_DATE} date"
    )
    return [row[0] for row in notes.distinct().orderBy(ARRIVAL_DATE).collect()]


@contextmanager
def _files_of(spark: SparkSession, file_bytes: int) -> Iterator[None]:
    """Let scans pack small files up to a size, so that a copy needs no shuffle."""
    packing = {
        "spark.sql.files.maxPartitionBytes": str(file_bytes),
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.files.openCostInBytes": "1",
    }
    before = {name: spark.conf.get(name, None) for name in packing}
    for name, value in packing.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def compact_bronze(
    spark: SparkSession,
    base: str,
    event_type: str,
    settled_days: int = SETTLED_DAYS,
    file_bytes: int = FILE_BYTES,
) -> dict[date, int]:
    """Copy the arrival dates that have closed since the last copy; returns rows by date.

    Streams leave a file per task and batch, and their own log names what belongs to the
    table, so those files stay. The copies, ``<base>/bronze_compact/<type>``, hold the same
    rows in files of about ``file_bytes``. A date counts as copied from the moment its line
    is noted, after its rows were counted in the copy; what broke off before is written
    again. Dates up to the last one copied are not looked at again, and rows without an
    arrival date are never copied. Delta tables are compacted by Delta itself.
    """
    if settled_days < 0:
        raise ValueError(f"a date that is not over cannot be copied, got settled_days={settled_days}")
    bronze = read_layer(spark, base, "bronze", event_type)
    done = compacted_dates(spark, base, event_type)
    closed = F.col(ARRIVAL_DATE) < F.date_sub(F.current_date(), settled_days)
    if done:
        closed &= F.col(ARRIVAL_DATE) > F.lit(done[-1])
    waiting = bronze.filter(closed).select(ARRIVAL_DATE).distinct().orderBy(ARRIVAL_DATE).collect()
    copied = {}
    for (day,) in waiting:
        path = f"{compact_path(base, event_type)}/{ARRIVAL_DATE}={day}"
        seen = Observation()
        rows = bronze.filter(F.col(ARRIVAL_DATE) == F.lit(day)).drop(ARRIVAL_DATE)
        with _files_of(spark, file_bytes):
            rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        copied[day] = seen.get["rows"]
        held = read_table(spark, path, schema=rows.schema).count()
        if held != copied[day]:
            raise RuntimeError(f"{event_type} {day}: {copied[day]} rows read, {held} in the copy")
        note = spark.range(1).select(F.lit(day).alias(ARRIVAL_DATE))
        note.write.mode("append").parquet(layer_path(base, "bronze_compact/_dates", event_type))
    return copied


def all_bronze(
    spark: SparkSession, base: str, event_type: str, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """All rows of bronze: copied dates from their copies, the others as they were ingested."""
    bronze = read_layer(spark, base, "bronze", event_type, fmt)
    done = compacted_dates(spark, base, event_type) if fmt == DEFAULT_FORMAT else []
    if not done:
        return bronze
    schema = EVENT_TYPES[event_type].bronze_table_schema
    copies = read_table(spark, compact_path(base, event_type), fmt, schema)
    # Both are filters on the partition column: no file of the other half is opened.
    copied = F.col(ARRIVAL_DATE).isin(done)
    rest = bronze.filter(F.col(ARRIVAL_DATE).isNull() | ~copied)
    return copies.filter(copied).unionByName(rest)
