"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Offset and partition name a topic record; the times only matter when a topic
# was re-created or replayed. All are narrow, so no wide column is read for order.
#
# With records of one key in several partitions their offsets do not compare;
# ARRIVAL_ORDER then takes the broker's time first.
ARRIVAL_ORDER = ("kafka_timestamp", "kafka_offset", "kafka_partition", "ingested_at")
RECORD_ORDER = ("kafka_offset", "kafka_partition", "kafka_timestamp", "ingested_at")


def dedup_latest(
    df: DataFrame, key: str | Sequence[str] = "event_id", order: Sequence[str] = RECORD_ORDER
) -> DataFrame:
    """Keep, per key, the row that comes last in ``order`` (columns compared in turn).

    Columns of ``order`` that the rows lack are passed over; with none left there is no
    last row, and ValueError is raised.

    Keeping rank 1 lets Spark drop all but one copy per key in each task *before*
    the shuffle (WindowGroupLimit), so a key with a third of all rows sends at most
    one row per task to the task that settles it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    present = [c for c in order if c in df.columns]
    if not present:
        raise ValueError(f"none of the order columns {list(order)} is there")
    latest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in present])
    ranked = df.withColumn("_rank", F.row_number().over(latest_first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
