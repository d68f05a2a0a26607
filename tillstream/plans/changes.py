"""Which event dates silver runs have changed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.schemas import EVENT_DATE
from tillstream.sources.tables import layer_path

_CHANGED = "run long, whole boolean, event_date date"


def changed_path(base: str, event_type: str) -> str:
    return layer_path(base, "silver/_changed", event_type)


def note_changes(dates: DataFrame, base: str, event_type: str, run: int, whole: bool = False) -> None:
    """Add the event dates that a silver run changes; ``whole`` for all of them."""
    rows = dates.select(F.lit(run).alias("run"), F.lit(whole).alias("whole"), EVENT_DATE)
    rows.coalesce(1).write.mode("append").parquet(changed_path(base, event_type))


def changes_noted(spark: SparkSession, base: str, event_type: str) -> DataFrame:
    return read_if_there(spark, changed_path(base, event_type), _CHANGED)


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
