"""Text standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks at both ends go in every rule; `trim` removes spaces only, not tabs.
CASE_RULES = {
    "upper": lambda c: F.upper(F.trim(c)),
    "lower": lambda c: F.lower(F.trim(c)),
    "keep": lambda c: F.trim(c),
}


def standard_text(column: str, rule: str) -> Column:
    return CASE_RULES[rule](F.col(column))


def is_blank(column: str) -> Column:
    return F.trim(F.col(column)) == ""
