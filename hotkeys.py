"""Measure the steps that could meet a hot key: generated rows, a third with one key.

Prints a line per step: rows shuffled, and rows and seconds of its reduce tasks. The
figures come from Spark's event log, in a folder of this run's own.

Environment: HOT_ROWS (12 million), HOT_CPUS (8), HOT_DIR (a scratch folder).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillstream import session  # noqa: E402
from tillstream.operators import kpis as K  # noqa: E402
from tillstream.operators.dedup import dedup_latest  # noqa: E402


def key(prefix: str, others: int) -> F.Column:
    """One value for every third row, ``others`` values for the rest."""
    rest = F.concat(F.lit(prefix), F.pmod(F.xxhash64("id"), F.lit(others)).cast("string"))
    return F.when(F.col("id") % 3 == 0, F.lit(f"{prefix}hot")).otherwise(rest)


def events(spark: SparkSession, rows: int) -> DataFrame:
    product = F.struct(
        key("SKU-", 200_000).alias("id"), F.lit("Lamp").alias("name"), F.lit("Home").alias("category")
    )
    return spark.range(0, rows, 1, 64).select(
        key("EVT-", rows).alias("event_id"),
        F.col("id").alias("kafka_offset"),
        (F.col("id") % 3).cast("int").alias("kafka_partition"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 864_000).alias("event_ts"),
        key("zone ", 20).alias("region"),
        F.concat(F.lit("CUST-"), F.col("id").cast("string")).alias("customer_id"),
        F.concat(F.lit("ORD-"), F.col("id").cast("string")).alias("order_id"),
        product.alias("product"),
        F.lit(2).alias("quantity"),
        (F.col("id") % 10_000 / 100 + 1).alias("total_amount"),
        F.lit(0.5).alias("discount_amount"),
        F.lit("completed").alias("status"),
        key("SKU-", rows).alias("product_id"),
        F.lit("Lamp").alias("product_name"),
        F.lit("WH-1").alias("warehouse_id"),
        (F.col("id") % 500).cast("int").alias("stock_level"),
        F.lit(50).alias("reorder_threshold"),
        (F.col("id") % 500 < 50).alias("low_stock_alert"),
    )


STEPS = {
    "duplicate removal": lambda rows: dedup_latest(rows.select("event_id", "kafka_offset", "status")),
    "hourly revenue": K.hourly_revenue,
    "top products": K.top_products,
    "latest stock": K.inventory_latest,
    "stock status": K.inventory_status,
}


def reduce_tasks(log: Path) -> dict[str, dict[int, list[tuple[int, float]]]]:
    """Rows read and seconds of each task that reads a shuffle, by step and stage."""
    step_of, found = {}, {}
    for line in log.open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            name = (event.get("Properties") or {}).get("spark.job.description")
            step_of.update(dict.fromkeys(event["Stage IDs"], name))
        elif event["Event"] == "SparkListenerTaskEnd":
            metrics = event.get("Task Metrics") or {}
            rows = metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            if rows:
                stages = found.setdefault(step_of.get(event["Stage ID"]), {})
                seconds = metrics["Executor Run Time"] / 1000
                stages.setdefault(event["Stage ID"], []).append((rows, seconds))
    return found


def main() -> None:
    folder = os.environ.get("HOT_DIR") or tempfile.mkdtemp(prefix="hotkeys-")
    options = {
        "spark.sql.shuffle.partitions": "32",
        "spark.driver.memory": "8g",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{folder}",
        "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = session.build("hotkeys", f"local[{os.environ.get('HOT_CPUS', '8')}]", **options)
    spark.sparkContext.setLogLevel("ERROR")
    rows = events(spark, int(os.environ.get("HOT_ROWS", "12000000")))
    for name, step in STEPS.items():
        spark.sparkContext.setJobDescription(name)
        step(rows).write.format("noop").mode("overwrite").save()
    log = Path(folder, spark.sparkContext.applicationId)
    spark.stop()
    for name, stages in reduce_tasks(log).items():
        if name in STEPS:
            # The stage that reads most rows is the one a hot key would hold up.
            tasks = max(stages.values(), key=lambda t: sum(n for n, _ in t))
            counts, seconds = zip(*tasks)
            print(
                f"{name}: {sum(counts):,} rows shuffled; rows per task, median / most: "
                f"{statistics.median(counts):,.0f} / {max(counts):,}; seconds, median / longest: "
                f"{statistics.median(seconds):.1f} / {max(seconds):.1f}"
            )


if __name__ == "__main__":
    main()
