"""Silver tables -> gold tables -> stored KPIs."""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import session
from tillstream.operators import kpis as K
from tillstream.operators.documents import upsert_kpis, with_doc_id
from tillstream.schemas import KPI_SCHEMAS, SNAPSHOT_KPIS
from tillstream.sources.tables import DEFAULT_FORMAT, layer_path, read_layer, read_table

KPI_TYPES = tuple(KPI_SCHEMAS)


def build_kpis(
    orders: DataFrame,
    clicks: DataFrame,
    inventory: DataFrame,
    as_of: datetime | None = None,
    latest_stock: bool = False,
) -> dict[str, DataFrame]:
    """The plans of all KPIs, by KPI type; nothing runs yet."""
    stock = K.inventory_latest if latest_stock else K.inventory_status
    return {
        "hourly_revenue": K.hourly_revenue(orders, as_of),
        "products": K.product_revenue(orders, as_of),
        "top_products": K.top_products(orders, computed_at=as_of),
        "conversion": K.conversion_funnel(orders, clicks, as_of),
        "inventory": stock(inventory, as_of),
        "summary": K.summary(orders, clicks, as_of, as_of),
    }


def write_gold(kpi: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace a gold table."""
    writer = kpi.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def write_json(df: DataFrame, path: str) -> None:
    """Export rows as JSON lines."""
    df.write.mode("overwrite").json(path)


# ── Stored KPIs: one typed table per KPI type ────────────────────────────────
# An upsert reads the table it replaces, so the new rows go to a new folder and a
# line in the list of versions makes them current once they are complete.


def _versions_path(base: str, kpi_type: str) -> str:
    return layer_path(base, "kpis", f"{kpi_type}/versions")


def _current_path(spark: SparkSession, base: str, kpi_type: str) -> str | None:
    try:
        versions = spark.read.schema("version long, folder string").json(
            _versions_path(base, kpi_type)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = versions.orderBy(F.desc("version"), F.desc("folder")).first()
    return newest and layer_path(base, "kpis", f"{kpi_type}/{newest.folder}")


def load_kpis(
    spark: SparkSession,
    base: str,
    fmt: str = DEFAULT_FORMAT,
    kpi_types: Iterable[str] = KPI_TYPES,
) -> dict[str, DataFrame]:
    """The stored KPI tables by KPI type; one without rows for a KPI never stored."""
    kpis = {}
    for name in kpi_types:
        path = _current_path(spark, base, name)
        if path is None:
            kpis[name] = spark.createDataFrame([], KPI_SCHEMAS[name])
        else:
            kpis[name] = read_table(spark, path, fmt)
    return kpis


# Reads of one row look at the file's index of ids: small groups of rows, sorted by id.
ID_GROUP_BYTES = 1 << 20


def _write_by_id(rows: DataFrame, path: str, fmt: str) -> None:
    """Write rows in order of ``id``, so that a read of one id opens one group of rows.

    Files cover ranges of ids, row groups are small, and each has a Bloom filter of its
    ids: what cannot hold an id is skipped by its footer.
    """
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id")
    writer = ordered.write.format(fmt).mode("errorifexists")
    if fmt == "parquet":
        writer = writer.option("parquet.bloom.filter.enabled#id", "true").option(
            "parquet.block.size", str(ID_GROUP_BYTES)
        )
    writer.save(path)


def save_kpi(
    spark: SparkSession, base: str, kpi_type: str, updates: DataFrame, fmt: str = DEFAULT_FORMAT
) -> None:
    """Bring one KPI's stored table up to date. One writer at a time per KPI.

    Rows of the dated KPIs are upserted; a KPI that describes the present is replaced,
    so what has left it is gone.
    """
    merged = with_doc_id(updates, kpi_type)
    if kpi_type not in SNAPSHOT_KPIS:
        merged = upsert_kpis(load_kpis(spark, base, fmt, [kpi_type])[kpi_type], merged)
    version = time.time_ns() // 1000
    folder = f"v{version}"
    path = layer_path(base, "kpis", f"{kpi_type}/{folder}")
    _write_by_id(merged, path, fmt)
    line = spark.range(1).select(F.lit(version).alias("version"), F.lit(folder).alias("folder"))
    line.coalesce(1).write.mode("append").json(_versions_path(base, kpi_type))


def expire_kpis(
    spark: SparkSession, base: str, keep: int = 3, kpi_types: Iterable[str] = KPI_TYPES
) -> int:
    """Delete all but the ``keep`` newest versions of each stored KPI; returns how many.

    A version that a running read may still use must be among those kept.
    """
    if keep < 1:
        raise ValueError(f"at least the current version stays, got keep={keep}")
    gone = 0
    for name in kpi_types:
        if _current_path(spark, base, name) is None:
            continue
        versions = spark.read.schema("version long, folder string").json(_versions_path(base, name))
        rows = versions.orderBy(F.desc("version"), F.desc("folder")).collect()
        for row in rows[keep:]:
            path = spark._jvm.org.apache.hadoop.fs.Path(layer_path(base, "kpis", f"{name}/{row.folder}"))
            files = path.getFileSystem(spark._jsc.hadoopConfiguration())
            gone += bool(files.exists(path) and files.delete(path, True))
    return gone


def run_gold(
    spark: SparkSession,
    base: str,
    fmt: str = DEFAULT_FORMAT,
    as_of: datetime | None = None,
    latest_stock: bool = False,
    export: str | None = None,
) -> None:
    """Compute all KPIs, replace the gold tables and bring the stored KPIs up to date.

    Each KPI is computed once: the stored table is made from the gold table just
    written. Orders are read three times, clicks once, stock once.
    """
    silver = [read_layer(spark, base, "silver", n, fmt) for n in ("orders", "clicks", "inventory")]
    # Shuffles carry groups, not rows, once tasks have aggregated their share.
    session.size_shuffles(spark, *silver, per_partition=512 * session.MIB)
    kpis = build_kpis(*silver, as_of=as_of, latest_stock=latest_stock)

    def written(name: str, rows: DataFrame) -> DataFrame:
        path = layer_path(base, "gold", name)
        write_gold(rows, path, fmt)
        return read_table(spark, path, fmt)

    # Funnel and summary come from one row of totals, the leaders from all products.
    totals = written("_totals", K.order_click_totals(*silver[:2]))
    kpis["conversion"] = K.funnel_of(totals, as_of)
    kpis["summary"] = K.summary_of(totals, as_of, as_of)
    for kpi_type, kpi in kpis.items():
        gold = written(kpi_type, kpi)
        if kpi_type == "products":
            leaders = K.rank_products(gold, K.TOP_PRODUCTS)
            leaders = leaders.withColumn("kpi_type", F.lit("top_products"))
            kpis["top_products"] = leaders.select(*kpis["top_products"].columns)
        save_kpi(spark, base, kpi_type, gold, fmt)
        if export:
            write_json(gold, f"{export.rstrip('/')}/{kpi_type}")
