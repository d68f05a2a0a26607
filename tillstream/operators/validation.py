"""Splitting events into valid and quarantined rows.

Each rule has two forms, a test that holds and a test that fails, and both are
made of plain comparisons and null checks that reach the file scan. The two forms
complement each other for NULLs as well, so no row can miss both outputs.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.text import is_blank, standard_text
from tillstream.schemas import EventSpec


class Rule(NamedTuple):
    name: str
    holds: Column
    fails: Column


def rules_for(spec: EventSpec, strict: bool = False) -> list[Rule]:
    """The validity rules of an event type; ``strict`` also refuses blanks and NaN."""
    rules = []
    for name in spec.required:
        value = F.col(name)
        holds, fails = value.isNotNull(), value.isNull()
        if strict:
            holds, fails = holds & ~is_blank(name), fails | is_blank(name)
        rules.append(Rule(f"missing_{name}", holds, fails))
    if spec.bound is not None:
        value, limit = F.col(spec.bound.column), F.lit(spec.bound.limit)
        inside = value >= limit if spec.bound.inclusive else value > limit
        outside = value < limit if spec.bound.inclusive else value <= limit
        holds, fails = value.isNotNull() & inside, value.isNull() | outside
        if strict:
            holds, fails = holds & ~F.isnan(value), fails | F.isnan(value)
        rules.append(Rule(f"invalid_{spec.bound.column}", holds, fails))
    return rules


def valid_rows(events: DataFrame, spec: EventSpec, strict: bool = False) -> DataFrame:
    return events.filter(reduce(and_, (rule.holds for rule in rules_for(spec, strict))))


def quarantined_rows(
    events: DataFrame, spec: EventSpec, strict: bool = False, detail: bool = False
) -> DataFrame:
    """The rows `valid_rows` leaves out, with the reason.

    ``detail`` adds the names of the rules each row breaks.
    """
    rules = rules_for(spec, strict)
    rejected = events.filter(reduce(or_, (rule.fails for rule in rules))).withColumn(
        "quarantine_reason", F.lit(spec.quarantine_reason)
    )
    if not detail:
        return rejected
    broken = F.array_compact(F.array(*[F.when(r.fails, F.lit(r.name)) for r in rules]))
    return rejected.withColumn("failed_rules", broken)


def split_valid(
    events: DataFrame, spec: EventSpec, strict: bool = False, detail: bool = False
) -> tuple[DataFrame, DataFrame]:
    return valid_rows(events, spec, strict), quarantined_rows(events, spec, strict, detail)


def check_values(events: DataFrame, spec: EventSpec) -> DataFrame:
    """Events with a value outside the set its column may have.

    ``wrong_values`` names the columns. Values are compared in their standard form; a
    missing value is a matter of the required columns, not of this check.
    """
    wrong = F.array_compact(
        F.array(
            *[
                F.when(~standard_text(name, spec.text_rules[name]).isin(*allowed), F.lit(name))
                for name, allowed in spec.allowed.items()
            ]
        )
    )
    return events.withColumn("wrong_values", wrong).filter(F.size("wrong_values") > 0)


def layer_counts(bronze: DataFrame, spec: EventSpec, strict: bool = False) -> DataFrame:
    """Rows of each layer in one pass: bronze = valid + quarantine, silver without copies."""
    rules = rules_for(spec, strict)
    valid = reduce(and_, (rule.holds for rule in rules))
    # One row per event id and task before the shuffle, whatever the number of copies.
    return bronze.select("event_id", valid.alias("ok")).agg(
        F.count("*").alias("bronze_rows"),
        F.count_if("ok").alias("valid_rows"),
        F.count_if(~F.col("ok")).alias("quarantine_rows"),
        F.count_distinct(F.when(F.col("ok"), F.col("event_id"))).alias("silver_rows"),
    )
