"""Bronze tables -> silver and quarantine tables.

A run reads the arrival dates that are new and rewrites the silver partitions that
gain or lose rows. A rebuild reads all of bronze, in pieces by event id if it is large.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream import session
from tillstream.functions.money import no_decimal_form
from tillstream.operators.cleaning import CLEANERS
from tillstream.operators.dedup import RECORD_ORDER
from tillstream.operators.lookup import in_partitions, likely_in, partition_key
from tillstream.plans.changes import note_changes
from tillstream.plans.compact import all_bronze
from tillstream.schemas import ARRIVAL_DATE, EVENT_DATE, EVENT_TYPES
from tillstream.sources.tables import (
    DEFAULT_FORMAT,
    layer_path,
    quarantine_path,
    read_layer,
    read_table,
)


def write_silver(
    silver: DataFrame,
    event_type: str,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    mode: str = "overwrite",
    only_partitions: bool = False,
) -> None:
    """Replace a silver table, add to it, or replace the partitions that have rows.

    The rows come out of the duplicate removal hash-partitioned by event id and
    are written from there: another shuffle by partition column would put the
    commonest status into few tasks.
    """
    _write(silver, path, fmt, mode, EVENT_TYPES[event_type].silver_partitions, only_partitions)


def write_quarantine(
    rejected: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, only_partitions: bool = False
) -> None:
    """Replace a quarantine table, or the arrival dates that have rows: reruns add nothing."""
    _write(rejected, path, fmt, "overwrite", [ARRIVAL_DATE], only_partitions)


def _write(
    df: DataFrame, path: str, fmt: str, mode: str, partition: Sequence[str], only_partitions: bool
) -> None:
    writer = df.write.format(fmt).mode(mode)
    if only_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    elif fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.partitionBy(*partition).save(path)


# ── What earlier runs have done ──────────────────────────────────────────────
def _runs_path(base: str, event_type: str) -> str:
    return layer_path(base, "silver/_runs", event_type)


def last_run(spark: SparkSession, base: str, event_type: str) -> Row | None:
    """The last run's ``phase`` (begun, done) and the arrival date it read up to."""
    try:
        runs = spark.read.schema("run long, phase string, upto string").json(
            _runs_path(base, event_type)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return runs.orderBy(F.desc("run"), F.desc("phase")).first()


def _note(spark: SparkSession, base: str, event_type: str, run: int, phase: str, upto: str | None) -> None:
    line = spark.range(1).select(
        F.lit(run).alias("run"), F.lit(phase).alias("phase"), F.lit(upto).cast("string").alias("upto")
    )
    line.coalesce(1).write.mode("append").json(_runs_path(base, event_type))


# ── Runs ─────────────────────────────────────────────────────────────────────
def _measures(event_type: str) -> list[Column]:
    unreadable = F.col("event_ts").isNull() & F.col("timestamp").isNotNull()
    measures = [
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if(unreadable).alias("unreadable_timestamps"),
    ]
    if event_type == "orders":
        odd = no_decimal_form("total_amount") | no_decimal_form("discount_amount")
        measures.append(F.count_if(odd).alias("unreadable_amounts"))
    return measures


def _changes(
    stored: DataFrame,
    fresh: DataFrame,
    count: int,
    order: Sequence[str],
    partition: Sequence[str],
) -> DataFrame:
    """Narrow rows of fresh copies that win and of stored copies that lose.

    Of equal copies the stored one wins, so reading a date again changes nothing. Of the
    stored ids only those are shuffled that a filter of the fresh ones lets pass.
    """
    columns = ["event_id", *order, *partition]
    ids = fresh.select("event_id")
    old = likely_in(stored.select(*columns), ids, "event_id", count)
    old = old.join(ids, "event_id", "left_semi")
    both = old.withColumn("_fresh", F.lit(False)).unionByName(
        fresh.select(*columns).withColumn("_fresh", F.lit(True))
    )
    latest = Window.partitionBy("event_id").orderBy(*[F.desc(c) for c in order], "_fresh")
    wins = F.row_number().over(latest) == 1
    return both.withColumn("_wins", wins).filter(F.col("_wins") == F.col("_fresh"))


def _folder(row: Row, columns: Sequence[str]) -> str:
    """Where a partitioned table keeps a partition."""
    none = "__HIVE_DEFAULT_PARTITION__"
    return "/".join(f"{c}={none if row[c] is None else _escaped(str(row[c]))}" for c in columns)


def _escaped(value: str) -> str:
    """Fixed rule of partition folders: these characters, and control characters, as %XX."""
    return re.sub(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda c: f"%{ord(c.group()):02X}", value)


def process_silver(
    spark: SparkSession,
    base: str,
    event_type: str,
    fmt: str = DEFAULT_FORMAT,
    strict: bool = False,
    detail: bool = False,
    order: Sequence[str] = RECORD_ORDER,
    rebuild: bool = False,
    pieces: int = 1,
) -> dict[str, int]:
    """Bring one event type's silver and quarantine tables up to date; returns row counts.

    Reads the arrival dates from the last one on that a run has read, which may have
    grown since; rows without an arrival date are read every time. Their latest copies
    are compared with the stored copies of the same ids, whenever those arrived, and
    only silver partitions that gain or lose a row are written again.

    A rebuild replaces both tables from all of bronze, in ``pieces`` by event id, each
    with a shuffle of its share. It is also done on the first run, where the last run
    broke off while it replaced partitions, and for formats other than files. After a
    change of ``strict`` or ``order`` ask for one.

    The counts are of the rows read: bronze = valid + quarantine, or the run fails.
    """
    spec = EVENT_TYPES[event_type]
    silver_path = layer_path(base, "silver", event_type)
    before = last_run(spark, base, event_type)
    whole = rebuild or before is None or before.phase != "done" or fmt == "delta"
    upto = before and before.upto
    if whole:
        bronze = all_bronze(spark, base, event_type, fmt)
    else:
        bronze = read_layer(spark, base, "bronze", event_type, fmt)
        if upto is not None:
            since = F.lit(upto).cast("date")
            bronze = bronze.filter(F.col(ARRIVAL_DATE).isNull() | (F.col(ARRIVAL_DATE) >= since))
    counts: dict[str, int] = {}
    run = time.time_ns() // 1000
    options = {"strict": strict, "detail": detail, "order": order}
    clean = CLEANERS[event_type]

    def cleaned(rows: DataFrame) -> tuple[DataFrame, list[Observation]]:
        # Read rows are counted below the rules: nearly all rows pass them, so no file
        # would be skipped by them here, unlike in the quarantine's own pass.
        read, seen, made = Observation(), Observation(), Observation()
        rows = rows.drop("_raw").observe(
            read,
            F.count(F.lit(1)).alias("bronze_rows"),
            F.max(ARRIVAL_DATE).cast("string").alias("upto"),
        )
        silver, _ = clean(rows.drop(ARRIVAL_DATE), seen=seen, **options)
        silver = silver.withColumn(EVENT_DATE, F.to_date("event_ts"))
        return silver.observe(made, *_measures(event_type)), [read, seen, made]

    def add(observations: Iterable[Observation]) -> None:
        nonlocal upto
        for found in observations:
            for name, value in found.get.items():
                if name != "upto":
                    counts[name] = counts.get(name, 0) + value
                elif value is not None:
                    upto = max(upto or value, value)

    if whole:
        session.size_shuffles(spark, bronze.drop("_raw"), per_partition=128 * session.MIB * pieces)
        _note(spark, base, event_type, run, "begun", upto)
        for piece in range(pieces):
            own = F.pmod(F.xxhash64("event_id"), F.lit(pieces)) == piece
            silver, observations = cleaned(bronze.filter(own) if pieces > 1 else bronze)
            write_silver(silver, event_type, silver_path, fmt, "append" if piece else "overwrite")
            add(observations)
        every = spark.range(1).select(F.lit(None).cast("date").alias(EVENT_DATE))
        note_changes(every, base, event_type, run, whole=True)
    else:
        session.size_shuffles(spark, bronze.drop("_raw"))
        staging = layer_path(base, "silver/_staging", event_type)
        silver, observations = cleaned(bronze)
        silver.write.format(fmt).mode("overwrite").save(staging)
        add(observations)
        fresh = read_table(spark, staging, fmt, silver.schema)
        count = counts["silver_rows"]
        counts["silver_rows"] = _merge(spark, base, event_type, fmt, fresh, count, order, run, upto)

    set_aside = Observation()
    _, rejected = clean(bronze, **options)
    rejected = rejected.observe(set_aside, F.count(F.lit(1)).alias("quarantine_rows"))
    write_quarantine(rejected, quarantine_path(base, event_type), fmt, only_partitions=not whole)
    add([set_aside])
    counts["duplicate_rows"] = counts["valid_rows"] - counts["silver_rows"]
    if counts["valid_rows"] + counts["quarantine_rows"] != counts["bronze_rows"]:
        raise RuntimeError(f"{event_type}: rows were lost on the way to silver: {counts}")
    _note(spark, base, event_type, run, "done", upto)
    return counts


def _merge(
    spark: SparkSession,
    base: str,
    event_type: str,
    fmt: str,
    fresh: DataFrame,
    count: int,
    order: Sequence[str],
    run: int,
    upto: str | None,
) -> int:
    """Put the winners of ``fresh`` into the silver table; returns how many there are.

    The partitions that change are a table that the stored one is joined with: Spark
    reads no others, and their number has no bound.
    """
    partition = EVENT_TYPES[event_type].silver_partitions
    path = layer_path(base, "silver", event_type)
    stored = read_table(spark, path, fmt, fresh.schema)
    present = [c for c in order if c in fresh.columns]

    def staged(rows: DataFrame, name: str) -> DataFrame:
        own = layer_path(base, "silver/_staging", f"{event_type}_{name}")
        rows.write.mode("overwrite").format(fmt).save(own)
        return read_table(spark, own, fmt, rows.schema)

    changes = staged(_changes(stored, fresh, count, present, partition), "changes")
    touched = staged(
        changes.groupBy(*partition)
        .agg(F.count_if("_fresh").alias("_in"), F.count_if(~F.col("_fresh")).alias("_out"))
        .coalesce(1),
        "touched",
    )
    taken = touched.agg(F.sum("_in")).first()[0]
    if taken is None:
        return 0
    before = in_partitions(stored, touched, partition)
    rows = _after(before, fresh, changes, present)
    # Partitions whose last row goes: an event has one row, so counts tell.
    held = before.groupBy(*partition).agg(F.count("*").alias("_rows"))
    held = held.withColumn("_partition", partition_key(partition))
    sizes = touched.select(partition_key(partition).alias("_partition"), "_in", "_out")
    gone = held.join(sizes, "_partition").filter(F.col("_rows") + F.col("_in") == F.col("_out"))
    emptied = gone.select(*partition).collect()
    # From here to "done" the table may be between two states.
    _note(spark, base, event_type, run, "begun", upto)
    note_changes(touched.select(EVENT_DATE).distinct(), base, event_type, run)
    write_silver(rows, event_type, path, fmt, only_partitions=True)
    nothing = spark.createDataFrame([], fresh.drop(*partition).schema)
    for row in emptied:
        nothing.write.mode("overwrite").format(fmt).save(f"{path}/{_folder(row, partition)}")
    return taken


def _after(before: DataFrame, fresh: DataFrame, changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows of the partitions that change, after the change."""
    losers = changes.filter("not _fresh").select("event_id", *order)
    same = [before["event_id"] == losers["event_id"]]
    same += [before[c].eqNullSafe(losers[c]) for c in order]
    winners = changes.filter("_fresh").select("event_id")
    staying = before.join(losers, same, "left_anti")
    return staying.unionByName(fresh.join(winners, "event_id", "left_semi"))


def run_silver(
    spark: SparkSession,
    base: str,
    fmt: str = DEFAULT_FORMAT,
    event_types: Iterable[str] = tuple(EVENT_TYPES),
    **options: object,
) -> dict[str, dict[str, int]]:
    return {name: process_silver(spark, base, name, fmt, **options) for name in event_types}
