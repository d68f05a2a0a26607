"""Topic streams, in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.schemas import TOPIC_SCHEMA

# Read a topic from its start and go on when the broker has
# already dropped old records.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def read_topic(
    spark: SparkSession, topic: str, fmt: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """Stream one topic as key, value, topic, partition, offset, timestamp.

    With ``fmt="kafka"`` pass ``kafka.bootstrap.servers``. Set ``minPartitions``
    when a hot key fills one topic partition (its offset range is then read by
    several tasks) and ``maxOffsetsPerTrigger`` to bound a catch-up batch.

    Any file format works too: ``path`` then holds files with the same columns.
    """
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").options(**KAFKA_DEFAULTS)
        return reader.option("subscribe", topic).options(**options).load()
    return spark.readStream.format(fmt).schema(TOPIC_SCHEMA).options(**options).load(path)


def write_topic(
    records: DataFrame, topic: str, fmt: str = "kafka", path: str | None = None, **options: str
) -> None:
    """Publish keyed records (see `to_records`) to a topic, or append them to files.

    A task that is run again publishes its records again; the duplicate removal on
    the way to silver takes care of them.
    """
    addressed = records.withColumn("topic", F.lit(topic))
    writer = addressed.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("append").save(path)
