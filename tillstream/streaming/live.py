"""Silver rows and hourly KPIs kept up to date by streams.

Two queries follow one another: the first writes each event's latest copy to a table, the
second reads that table as a stream and corrects the stored hours. What they keep is
bounded by the watermark and lives in Spark's state store.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions.times import event_time
from tillstream.operators.cleaning import standardise
from tillstream.operators.dedup import RECORD_ORDER
from tillstream.operators.kpis import hourly_revenue
from tillstream.operators.validation import valid_rows
from tillstream.plans.gold import expire_kpis, save_kpi
from tillstream.schemas import EVENT_DATE, EventSpec
from tillstream.sources.tables import DEFAULT_FORMAT, layer_path

LATE = "1 hour"
COPIES = "copies"
# Each batch makes a version of its KPI; reads may use one of so many.
VERSIONS = 10


def latest_copies(
    events: DataFrame, late: str = LATE, order: Sequence[str] = RECORD_ORDER, key: str = "event_id"
) -> DataFrame:
    """One row per event: the copy that comes last in ``order``, and how many ``copies`` came.

    Keeps the latest, as the batch does, so a row is given once no better one can come: when
    the watermark has passed its last copy by ``late``. Copies whose times lie further
    apart than that are rows of their own, and rows behind the watermark are dropped and
    counted (see `stream_counts`). Rows without a readable time never pass the watermark;
    the batch has them. Works on a table too, where nothing is late.
    """
    timed = events.filter(F.col("event_ts").isNotNull())
    if timed.isStreaming:
        timed = timed.withWatermark("event_ts", late)
    present = [c for c in order if c in events.columns]
    if not present:
        raise ValueError(f"none of the order columns {list(order)} is there")
    latest = F.max_by(F.struct(*events.columns), F.struct(*present))
    # A session ends when no copy has come for as long as rows may be late.
    copies = timed.groupBy(key, F.session_window("event_ts", late)).agg(
        latest.alias("_row"), F.count("*").alias(COPIES)
    )
    return copies.select("_row.*", COPIES)


def silver_stream(
    bronze: DataFrame, spec: EventSpec, late: str = LATE, strict: bool = False
) -> DataFrame:
    """Valid events of a bronze stream, standardised, each once."""
    valid = valid_rows(bronze, spec, strict).drop("_raw")
    rows = standardise(valid, spec.text_rules).withColumn("event_ts", event_time("timestamp"))
    return latest_copies(rows, late)


def live_path(base: str, event_type: str) -> str:
    return layer_path(base, "silver_live", event_type)


def start_silver(
    silver: DataFrame,
    spec: EventSpec,
    base: str,
    checkpoint: str,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Append the rows of `silver_stream` to ``<base>/silver_live/<type>``, each exactly once."""
    return (
        silver.withColumn(EVENT_DATE, F.to_date("event_ts"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*spec.silver_partitions)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start(live_path(base, spec.name))
    )


def stream_counts(query: StreamingQuery) -> dict[str, int]:
    """Rows read, and dropped as too late, over the progress reports the query still has."""
    reports = query.recentProgress
    operators = [op for report in reports for op in report.stateOperators]
    return {
        "rows": sum(report.numInputRows for report in reports),
        "late_rows": sum(op.numRowsDroppedByWatermark for op in operators),
    }


# ── Hours, corrected as rows come in ─────────────────────────────────────────
def _applied_path(base: str, kpi_type: str) -> str:
    return layer_path(base, "kpis", f"{kpi_type}/applied")


def last_batch(spark: SparkSession, base: str, kpi_type: str, stream: str) -> int:
    """The last batch of a stream that a stored KPI has taken in; -1 for none."""
    try:
        applied = spark.read.schema("stream string, batch long").json(_applied_path(base, kpi_type))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    found = applied.filter(F.col("stream") == stream).agg(F.max("batch")).first()[0]
    return -1 if found is None else found


def kpi_sink(
    base: str,
    kpi_type: str,
    stream: str,
    fmt: str = DEFAULT_FORMAT,
    keep: int | None = VERSIONS,
) -> Callable[[DataFrame, int], None]:
    """Upsert each batch of whole KPI rows, once per batch number.

    All but the ``keep`` newest versions of the KPI are deleted (none where it is None).

    A batch that is replayed is passed over. One that broke off before its number was
    noted is upserted again: its rows are totals, so that changes nothing.
    """

    def upsert(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        if batch <= last_batch(spark, base, kpi_type, stream):
            return
        save_kpi(spark, base, kpi_type, rows, fmt)
        line = spark.range(1).select(F.lit(stream).alias("stream"), F.lit(batch).alias("batch"))
        line.coalesce(1).write.mode("append").json(_applied_path(base, kpi_type))
        if keep is not None:
            expire_kpis(spark, base, keep, [kpi_type])

    return upsert


def start_hourly_revenue(
    orders: DataFrame,
    base: str,
    checkpoint: str,
    late: str = LATE,
    trigger: Mapping | None = None,
    fmt: str = DEFAULT_FORMAT,
    stream: str = "hourly_revenue",
    keep: int | None = VERSIONS,
) -> StreamingQuery:
    """Keep the stored hours up to date from a stream of silver orders.

    Each batch gives the new totals of the hours its rows fall in, also of hours that are
    past, as long as the watermark has not passed them.
    """
    hours = hourly_revenue(orders, estimate_customers=True, late=late)
    return (
        hours.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(kpi_sink(base, "hourly_revenue", stream, fmt, keep))
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
