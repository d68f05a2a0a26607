"""Session set-up shared by the jobs, the tests and the benchmark."""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024
_UNITS = {unit: 1024**power for power, unit in enumerate(("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"))}

# Event times are compared and truncated in this zone, whatever the host says.
TIME_ZONE = "UTC"


def pin(spark: SparkSession) -> SparkSession:
    """Set the SQL options results depend on, in a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def build(app_name: str, master: str | None = None, **options: str) -> SparkSession:
    """A session with adaptive execution and skew-join splitting.

    All generated code of the engine's plans fits in the code cache, so a plan that
    runs again is not compiled again.

    Recording a Python call site for every expression costs several calls to the
    JVM each, which adds up in plans of this size, so that is off.

    Writers of a partitioned table keep a file open per partition value, so rows
    need no sort by that value first (beyond eight values Spark sorts after all).

    Checkpoints are deleted once nothing refers to them.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", TIME_ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def planned_bytes(df: DataFrame) -> float:
    """The size the optimizer expects of a frame; for a table read, its listed files."""
    view = f"_planned_{uuid.uuid4().hex}"
    df.createTempView(view)
    try:
        plan = df.sparkSession.sql(f"explain cost select * from {view}").first()[0]
    finally:
        df.sparkSession.catalog.dropTempView(view)
    size, unit = re.search(r"sizeInBytes=([0-9.E+]+) (\w+)", plan).groups()
    return float(size) * _UNITS[unit]


def size_shuffles(
    spark: SparkSession, *inputs: DataFrame, per_partition: int = 128 * MIB
) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to suit the size of a job's inputs.

    A fixed number fits one input size only, and adaptive execution merges
    partitions but never makes more. The sizes are those of the listed files. The
    number has no upper limit, so partitions are as large at any input size; a silver
    rebuild of a very large table is better cut into pieces (see ``plans/silver``).
    """
    wanted = math.ceil(sum(map(planned_bytes, inputs)) / per_partition)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)
