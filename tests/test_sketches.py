"""Merged sketches, exact quantiles and scraped counters against plain versions."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstream.operators import counters, quantiles, sketches

START = datetime(2026, 1, 1)


def orders(spark, rows):
    """(hour, region, customer)"""
    return spark.createDataFrame(
        [(START + timedelta(hours=h, minutes=5), r, c, "completed") for h, r, c in rows],
        "event_ts timestamp, region string, customer_id string, status string",
    )


def test_customers_of_any_span_and_regions(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(48), rng.choice(["EU", "US", "AS"]), f"c{rng.randrange(3000)}") for _ in range(9000)]
    stored = sketches.customer_sketches(orders(spark, [*rows, (1, "EU", None)]))

    def check(wanted, **options):
        found = sketches.distinct_customers(stored, **options).first().customers
        assert abs(found - len(wanted)) <= sketches.CUSTOMER_ERROR * len(wanted)

    check({c for _, _, c in rows})
    check({c for h, r, c in rows if 5 <= h < 30 and r != "US"}, since=START + timedelta(hours=5),
          until=START + timedelta(hours=30), regions=["EU", "AS"])
    per_day = sketches.distinct_customers(stored, by={"day": F.to_date("hour_bucket")}).collect()
    assert len(per_day) == 2
    for row in per_day:
        exact = len({c for h, _, c in rows if START.date() + timedelta(days=h // 24) == row.day})
        assert abs(row.customers - exact) <= sketches.CUSTOMER_ERROR * exact


def log(spark, rows):
    """(seconds, duration, endpoint)"""
    return spark.createDataFrame(
        [(START + timedelta(seconds=s), d, e) for s, d, e in rows], "ts timestamp, duration_sec double, endpoint string"
    ).repartition(4)


def windows(rows, length, slide):
    found = defaultdict(list)
    for s, d, e in rows:
        if d is None or d != d:
            continue
        k = s // slide * slide
        while k > s - length:
            found[START + timedelta(seconds=k), e].append(d)
            k -= slide
    return found


# Ties, a window with most rows, values close together or far apart, none at all.
def rough_rows():
    rng = random.Random(7)
    rows = [(rng.randrange(300), rng.choice([0.1, 0.2, rng.random()]), "hot") for _ in range(4000)]
    rows += [(rng.randrange(3000), rng.lognormvariate(0, 6), rng.choice("ab")) for _ in range(1500)]
    rows += [(900 + k, 1.0 + k * 2**-50, "near") for k in range(60)]
    rows += [(1200, v, "wide") for v in (-1e300, 1e300, 0.0, 5e-324, float("inf"), 3.0, 4.0)]
    return rows + [(1500, None, "a"), (1501, float("nan"), "a"), (2995, 1.5, "one"), (1800, float("nan"), "none")]


@pytest.mark.parametrize(("slide", "options"), [(300, {}), (60, {"passes": 1, "parts": 4}), (300, {"passes": 0})])
def test_quantiles_are_exact(spark, slide, options):
    rows, qs = rough_rows(), (0, 0.25, 0.5, 0.95, 0.999, 1)
    found = quantiles.exact_quantiles(
        log(spark, rows), qs, "5 minutes", f"{slide} seconds", by=["endpoint"], **options
    ).collect()
    wanted = windows(rows, 300, slide)
    assert len(found) == len(wanted)
    for row in found:
        with np.errstate(invalid="ignore"):
            exact = np.quantile(wanted[row.window_start, row.endpoint], qs)
        for value, want, q in zip(row[3:], exact, qs, strict=True):
            # numpy makes NaN of places next to an infinite value.
            assert np.isnan(want) or value == pytest.approx(want, rel=1e-12, abs=1e-300), (row, q)


def test_no_task_gathers_a_window(spark):
    """Values are dealt out by window and value, never by window alone, before they are few."""
    plan = quantiles.exact_quantiles(log(spark, rough_rows()))._jdf.queryExecution().toString()
    assert "hashpartitioning(window" in plan and "_value" in plan
    rows = log(spark, [(k % 300, float(k), "a") for k in range(20_000)])
    assert quantiles.exact_quantiles(rows, (0.5,)).first().p50 == 9999.5


def test_merged_quantile_sketches_are_near(spark):
    rows = rough_rows()
    steps = sketches.latency_sketches(log(spark, rows), "1 minute", ["endpoint"])
    found = sketches.sketched_quantiles(steps, (0.5, 0.95), "5 minutes", "1 minute", ["endpoint"]).collect()
    wanted = windows(rows, 300, 60)
    assert {(r.window_start, r.endpoint): r.requests for r in found} == {k: len(v) for k, v in wanted.items()}
    for row in found:
        values = np.sort(wanted[row.window_start, row.endpoint])
        for q, value in ((0.5, row.p50), (0.95, row.p95)):
            low, high = (np.searchsorted(values, value, side) / len(values) for side in ("left", "right"))
            assert low - sketches.RANK_ERROR <= q <= high + sketches.RANK_ERROR


def plain_increase(samples, length, slide):
    series = defaultdict(dict)
    for s, name, value in samples:
        if value is not None and value == value:
            series[name][s] = max(value, series[name].get(s, value))
    found = {}
    for name, own in series.items():
        times = sorted(own)
        for start in range(min(times) // slide * slide - length, max(times) + 1, slide):
            inside = [t for t in times if start <= t < start + length]
            if len(inside) < 2:
                continue
            grown = 0.0
            for a, b in zip(inside, inside[1:]):
                grown += own[b] - own[a] if own[b] >= own[a] else own[b]
            span = inside[-1] - inside[0]
            mean = span / (len(inside) - 1)
            back, ahead = inside[0] - start, start + length - inside[-1]
            back = mean / 2 if back >= mean * 1.1 else back
            ahead = mean / 2 if ahead >= mean * 1.1 else ahead
            if grown > 0:
                back = min(back, span * own[inside[0]] / grown)
            found[name, START + timedelta(seconds=start)] = grown * (span + back + ahead) / span
    return found


def counter_rows():
    rng, rows = random.Random(2), []
    for name in ("a", "b", None):
        value = 0.0
        for t in range(0, 7200, 15):
            value = rng.choice([0.0, 2.0]) if rng.random() < 0.02 else value + rng.randrange(5)
            if not 2000 < t < 3500 and rng.random() > 0.1:  # an outage, and missing scrapes
                rows.append((t + rng.randrange(3), name, value))
    rows += [rows[5], (rows[9][0], "a", rows[9][2] - 1), (40, "a", None), (41, "a", float("nan")), (9000, "lone", 5.0)]
    return rows


@pytest.mark.parametrize(("length", "slide", "block"), [(300, 300, "10 minutes"), (600, 120, "1 day"), (300, 300, "20 seconds")])
def test_increase_with_resets_and_gaps(spark, length, slide, block):
    rows = counter_rows()
    samples = spark.createDataFrame(
        [(START + timedelta(seconds=s), n, v) for s, n, v in rows], "ts timestamp, name string, value double"
    ).repartition(3)
    found = counters.increase(samples, ["name"], f"{length} seconds", f"{slide} seconds", block).collect()
    wanted = plain_increase(rows, length, slide)
    assert {(r.name, r.window_start) for r in found} == set(wanted)
    for row in found:
        assert row.increase == pytest.approx(wanted[row.name, row.window_start])
        assert row.per_second == pytest.approx(row.increase / length)


def test_growth_is_carried_over_blocks(spark):
    rows = [(0, 5.0), (100, 7.0), (5000, 9.0), (5100, 1.0), (99_000, 4.0)]
    samples = spark.createDataFrame([(START + timedelta(seconds=s), "a", v) for s, v in rows], "ts timestamp, name string, value double")
    found = counters.with_growth(samples, ["name"], "1 minute").orderBy("ts").collect()
    assert [r.growth for r in found] == [None, 2.0, 2.0, 1.0, 3.0]
    assert counters.increase(samples.limit(0), ["name"]).count() == 0
