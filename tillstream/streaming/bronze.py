"""Topics -> bronze tables: stateless append streams, one per event type."""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.ingest import to_bronze
from tillstream.schemas import ARRIVAL_DATE, EVENT_TYPES
from tillstream.sources.tables import DEFAULT_FORMAT, layer_path
from tillstream.sources.topics import read_topic

TRIGGER = {"processingTime": "10 seconds"}


def write_bronze(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping | None = None,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Iterable[str] = (ARRIVAL_DATE,),
) -> StreamingQuery:
    """Append to a bronze table, exactly once per source record.

    The checkpoint must be in shared storage: it is what a restarted query
    continues from.
    """
    return (
        bronze.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("mergeSchema", "true")
        .partitionBy(*partition_by)
        .trigger(**(trigger or TRIGGER))
        .start(path)
    )


def start_bronze(
    spark: SparkSession,
    base: str,
    checkpoints: str,
    topic_prefix: str = "",
    source_fmt: str = "kafka",
    source_base: str | None = None,
    source_options: Mapping[str, str] | None = None,
    fmt: str = DEFAULT_FORMAT,
    trigger: Mapping | None = None,
    event_types: Iterable[str] = tuple(EVENT_TYPES),
) -> list[StreamingQuery]:
    """Start one stream per event type; ``source_base`` holds topics kept as files."""
    started = []
    for name in event_types:
        spec = EVENT_TYPES[name]
        topic = spec.topic(topic_prefix)
        path = f"{source_base.rstrip('/')}/{topic}" if source_base else None
        records = read_topic(spark, topic, source_fmt, path, **(source_options or {}))
        started.append(
            write_bronze(
                to_bronze(records, spec).withColumn(ARRIVAL_DATE, F.to_date("ingested_at")),
                layer_path(base, "bronze", name),
                f"{checkpoints.rstrip('/')}/bronze/{name}",
                trigger,
                fmt,
            )
        )
    return started


def await_all(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Wait for all queries; when one fails, stop the others and raise its error."""
    running = list(queries)
    try:
        while running:
            # Forget what has ended before looking: a query that ends after this line
            # makes the wait below return at once.
            spark.streams.resetTerminated()
            ended = [q for q in running if not q.isActive]
            running = [q for q in running if q not in ended]
            for query in ended:
                query.awaitTermination()  # raises the query's own error
            if running and not ended:
                # The error of a query of ours is raised above, of another's is not ours.
                with contextlib.suppress(StreamingQueryException):
                    spark.streams.awaitAnyTermination()
    finally:
        for query in running:
            query.stop()
