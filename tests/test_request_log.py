import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.operators import request_log as R

START = datetime(2026, 1, 2)
SCHEMA = "ts timestamp, method string, endpoint string, status int, duration_sec double, operation string"


def make_rows():
    random.seed(11)
    durations = [0.0, 0.004, 0.01, 0.02, 0.06, 0.3, 0.9, 2.5, 2.6, 60.0, None]
    rows = []
    for _ in range(3000):
        status = random.choice([200] * 8 + [404, 499, 500, 503, 599, 600])
        rows.append(
            (
                START + timedelta(seconds=random.randrange(0, 7200) + random.random()),
                "GET",
                random.choice(["/a", "/b", "/c"]),
                status,
                random.choice(durations),
                "query" if status == 503 else None,
            )
        )
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def bucket(ts, minutes):
    return START + timedelta(minutes=(ts - START).total_seconds() // 60 // minutes * minutes)


def grouped(minutes, key=lambda row: ()):
    groups = defaultdict(list)
    for row in ROWS:
        groups[(bucket(row[0], minutes), *key(row))].append(row)
    return groups


def test_counts(log):
    found = {r.window_start: r.requests for r in R.request_counts(log).collect()}
    assert found == {k[0]: len(v) for k, v in grouped(5).items()}
    status = {(r.window_start, r.status): r.requests for r in R.status_breakdown(log).collect()}
    assert status == {k: len(v) for k, v in grouped(30, lambda r: (r[3],)).items()}


def test_sliding_counts(log):
    found = R.request_counts(log, slide="1 minute").filter(F.minute("window_start") == 7).first()
    end = found.window_start + timedelta(minutes=5)
    assert found.window_end == end
    assert found.requests == sum(found.window_start <= r[0] < end for r in ROWS)


def test_rate_by_endpoint(log):
    found = {(r.window_start, r.endpoint): r.per_second for r in R.request_rate(log).collect()}
    assert found == {k: len(v) / 60 for k, v in grouped(1, lambda r: (r[2],)).items()}


def test_error_rate_counts_5xx_only(log):
    found = {r.window_start: r.error_pct for r in R.error_rate(log).collect()}
    for (start,), rows in grouped(5).items():
        failed = sum(500 <= r[3] <= 599 for r in rows)
        assert found[start] == failed / len(rows) * 100


def test_store_errors(log):
    found = {r.window_start: r.requests for r in R.store_errors(log).collect()}
    wanted = {k[0]: sum(r[5] is not None for r in v) for k, v in grouped(5).items()}
    assert found == {k: n for k, n in wanted.items() if n}


def test_bands(spark):
    rates = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.99, 1.0, 4.99, 5.0, None)], "pct double")
    bands = [r.band for r in R.classify(rates, "pct", R.ERROR_RATE_STEPS).collect()]
    assert bands == ["green", "green", "green", "yellow", "yellow", "red", None]


def test_histogram(log):
    found = {(r.window_start, r.le): r.requests for r in R.latency_histogram(log).collect()}
    bounds = [*R.LATENCY_BUCKETS, math.inf]
    wanted = {}
    for (start,), rows in grouped(1).items():
        measured = [r[4] for r in rows if r[4] is not None]
        wanted.update({(start, le): sum(d <= le for d in measured) for le in bounds})
    assert found == wanted


def interpolated(durations, q):
    """The dashboard's estimate, step by step."""
    if not durations:
        return None
    bounds = list(R.LATENCY_BUCKETS)
    cumulative = [sum(d <= le for d in durations) for le in bounds] + [len(durations)]
    wanted = q * len(durations)
    at = next(i for i, n in enumerate(cumulative) if n >= wanted)
    if at == len(bounds):
        return bounds[-1]
    low = bounds[at - 1] if at else 0.0
    before = cumulative[at - 1] if at else 0
    inside = cumulative[at] - before
    return low + (bounds[at] - low) * ((wanted - before) / inside if inside else 0.0)


@pytest.mark.parametrize("minutes", [1, 5])
def test_quantiles(log, minutes):
    qs = (0.0, 0.5, 0.95, 0.99, 0.999, 1.0)
    rows = R.latency_quantiles(log, qs, f"{minutes} minutes").collect()
    found = {r.window_start: tuple(r)[2:] for r in rows}
    for (start,), group in grouped(minutes).items():
        measured = [r[4] for r in group if r[4] is not None]
        assert found[start] == pytest.approx([interpolated(measured, q) for q in qs])


def test_quantiles_of_unmeasured_and_slow_requests(spark):
    rows = [(START, "GET", "/a", 200, None, None), (START + timedelta(hours=1), "GET", "/a", 200, 99.0, None)]
    found = R.latency_quantiles(spark.createDataFrame(rows, SCHEMA)).orderBy("window_start").collect()
    assert [r.p50 for r in found] == [None, 2.5]
    assert found[0].asDict().keys() >= {"p50", "p95", "p99"}


def test_stream_equals_batch(spark, log, tmp_path):
    source = str(tmp_path / "log")
    log.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    rollups = {
        "counts": lambda d, **o: R.request_counts(d, **o),
        "errors": lambda d, **o: R.error_rate(d, **o),
        "quantiles": lambda d, **o: R.latency_quantiles(d, **o),
        "histogram": lambda d, **o: R.latency_histogram(d, **o),
    }
    for name, rollup in rollups.items():
        out = str(tmp_path / name)
        query = (
            rollup(stream, late="0 seconds")
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / f"{name}_checkpoint"))
            .trigger(availableNow=True)
            .start(out)
        )
        query.awaitTermination()
        # The watermark closes every window but those around the newest row.
        closed = spark.read.parquet(out)
        newest = closed.agg(F.max("window_end")).first()[0]
        batch = rollup(log).filter(F.col("window_end") <= F.lit(newest))
        assert closed.count() > 0
        assert closed.exceptAll(batch).count() == 0 and batch.exceptAll(closed).count() == 0


def test_sliding_windows_are_counted_by_step_first(spark):
    log = spark.range(1).selectExpr(
        "timestamp'2026-01-01 00:00:00' as ts", "200 as status", "0.1D as duration_sec"
    )
    for rollup in (R.request_counts, R.error_rate, R.latency_quantiles, R.latency_histogram):
        plan = rollup(log, window="5 minutes", slide="1 minute")
        text = plan._jdf.queryExecution().executedPlan().toString()
        # Plans print from the top: the copies are made above the counts by step.
        assert "HashAggregate" in text.split("Expand")[1]
    odd = R.request_counts(log, window="5 minutes", slide="2 minutes")
    assert odd.agg({"requests": "sum"}).first()[0] in (2, 3)
