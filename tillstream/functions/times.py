"""Event-time parsing, processing-time stamps and ISO rendering."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(column: str) -> Column:
    """ISO-8601 text to a timestamp; NULL, not a failed job, when it cannot be read.

    Text without a full date is not read: a bare time would mean the day of the run.
    """
    dated = F.col(column).rlike(r"^\s*\d{4,}-\d{1,2}-\d{1,2}")
    return F.when(dated, F.try_to_timestamp(F.col(column)))


def processing_time(at: datetime | None = None) -> Column:
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def iso_string(column: Column) -> Column:
    """2026-01-02T03:04:05, with six fraction digits when there is a fraction."""
    seconds = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(column == F.date_trunc("second", column), seconds).otherwise(micros)
