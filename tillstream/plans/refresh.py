"""Silver partitions that changed -> parts -> KPIs, without reading the rest of silver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.lookup import in_partitions
from tillstream.operators.parts import PART_TYPES, build_parts, combine
from tillstream.plans.changes import changes_noted, read_if_there
from tillstream.plans.gold import save_kpi, write_gold
from tillstream.schemas import EVENT_DATE
from tillstream.sources.tables import DEFAULT_FORMAT, layer_path, read_layer, read_table

def _part_path(base: str, name: str) -> str:
    return layer_path(base, "gold_parts", name)


def refresh_parts(spark: SparkSession, base: str, event_type: str, fmt: str = DEFAULT_FORMAT) -> bool:
    """Make the parts of the dates again that silver runs have changed; returns whether any.

    Every part names the last run it has seen, so what is newer is what changed since.
    After a rebuild of silver, and the first time, all parts are made.
    """
    first = _part_path(base, PART_TYPES[event_type][0])
    seen = read_if_there(spark, first, "_run long").agg(F.max("_run")).first()[0]
    changed = changes_noted(spark, base, event_type)
    if seen is not None:
        changed = changed.filter(F.col("run") > seen)
    run, whole = changed.agg(F.max("run"), F.max("whole")).first()
    if run is None and seen is not None:
        return False
    run, whole = run or 0, bool(whole) or seen is None
    silver = read_layer(spark, base, "silver", event_type, fmt)
    dates = changed.select(EVENT_DATE).distinct()
    if not whole:
        silver = in_partitions(silver, dates, [EVENT_DATE])
    for name, part in build_parts(silver, event_type).items():
        part = part.withColumn("_run", F.lit(run))
        # A date without rows gets a part without any, in place of the one it had.
        marked = dates if not whole else dates.limit(0)
        rows = part.withColumn("_empty", F.lit(False)).unionByName(
            marked.withColumns({"_empty": F.lit(True), "_run": F.lit(run)}), allowMissingColumns=True
        )
        writer = rows.write.mode("overwrite").partitionBy(EVENT_DATE)
        if not whole:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(_part_path(base, name))
    return True


def load_parts(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    names = [name for parts in PART_TYPES.values() for name in parts]
    parts = {name: spark.read.parquet(_part_path(base, name)) for name in names}
    return {name: part.filter("not _empty").drop("_empty", "_run") for name, part in parts.items()}


def refresh_gold(
    spark: SparkSession, base: str, fmt: str = DEFAULT_FORMAT, as_of: datetime | None = None
) -> None:
    """Bring the gold tables and stored KPIs up to date from the dates that changed.

    Silver is read for those dates only; all else comes from the parts, which hold a row
    per date and group. The result equals a gold run over all of silver.
    """
    changed = [refresh_parts(spark, base, event_type, fmt) for event_type in PART_TYPES]
    if not any(changed):
        return
    for kpi_type, kpi in combine(load_parts(spark, base), as_of).items():
        path = layer_path(base, "gold", kpi_type)
        write_gold(kpi, path, fmt)
        save_kpi(spark, base, kpi_type, read_table(spark, path, fmt), fmt)
