"""Secret scans: rules looked up in a trigram index, then verified on the text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.llm.common import lower_ascii, scratch_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret: the matches of ``pattern`` whose ``group`` has ``least`` characters.

    Matches are the leftmost ones that do not overlap; those too short are dropped, and
    nothing is tried again inside them. Patterns match no empty text.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The text after ``+`` runs on as far as it can, so a run that is too short stays so
# wherever a match may begin in it: the least length is part of these two patterns.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        base=True,
    ),
    Rule("access", "AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", "[0-9a-f]{24,}", base=True),
)
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("login", r"(https?|ftp|postgres|mysql|mongodb|redis|amqp)://[^\x00-\x20/@:]+:[^\x00-\x20/@]+@"),
    Rule("key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

# ── Trigram queries ──────────────────────────────────────────────────────────
# A regex is turned into ways to match it. Each is a tuple of texts that a match must
# hold in this order, with anything between two of them.
_GAP = ("", "")
# Past so many ways an element counts as anything, which asks for less and loses nothing.
MOST_WAYS = 64
_WIDE_CLASS = 5


def _then(left: set[tuple], right: set[tuple]) -> set[tuple]:
    if len(left) * len(right) > MOST_WAYS:
        right = {_GAP}
    return {(*a[:-1], a[-1] + b[0], *b[1:]) for a in left for b in right}


def _ways(nodes: Iterable[tuple]) -> set[tuple]:
    """Ways to match a sequence of elements, as Python's own regex parser gives them."""
    ways: set[tuple] = {("",)}
    for kind, value in nodes:
        name = str(kind)
        if name == "LITERAL":
            element = {(chr(value),)}
        elif name == "IN" and all(str(k) == "LITERAL" for k, _ in value) and len(value) <= _WIDE_CLASS:
            element = {(chr(c),) for _, c in value}
        elif name == "SUBPATTERN":
            element = _ways(value[3])
        elif name == "BRANCH":
            element = set().union(*map(_ways, value[1]))
        elif name == "MAX_REPEAT":
            least, most, inner = value
            once = _ways(inner)
            element = {("",)} | (once if most == 1 else {_GAP}) if least == 0 else once
            if least > 0 and most != 1:
                element = _then(element, {_GAP})
        else:
            element = {_GAP}
        ways = _then(ways, element if len(element) <= MOST_WAYS else {_GAP})
    return ways


def _folded(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of trigrams, one of which a text with a match must hold whole.

    Trigrams are of text with A-Z lower-cased. None where a match need hold none.
    """
    parsed = re._parser.parse(pattern)
    sets = set()
    for way in _ways(parsed):
        pieces = map(_folded, way)
        sets.add(frozenset(p[i : i + 3] for p in pieces for i in range(len(p) - 2)))
    if frozenset() in sets:
        return None
    # A set that holds another whole one asks for nothing more.
    return sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)


# ── Index ────────────────────────────────────────────────────────────────────
def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows under 128 bits of their id and text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = F.col(f"`{id_col}`")
    return docs.select(
        own.alias("_id"),
        text.alias("_text"),
        F.xxhash64(own, text).alias("_k1"),
        F.xxhash64(F.lit(1), text, own).alias("_k2"),
    )


def build_index(keyed: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """Postings: which text (``_k1``, ``_k2``) holds which of the trigrams."""
    folded = keyed.select("_k1", "_k2", lower_ascii(F.col("_text")).alias("_folded"))
    listed = F.array(*[F.lit(t) for t in trigrams])
    held = F.filter(listed, lambda t: F.contains(F.col("_folded"), t))
    return folded.select("_k1", "_k2", F.explode(held).alias("_trigram"))


def _candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Texts whose postings hold a whole trigram set of a rule, with the rules' names.

    Postings of a set are intersected by counting: tasks count what they hold of a text
    before anything is shuffled.
    """
    spark = postings.sparkSession
    sets = [
        (name, place, len(wanted), trigram)
        for name, query in queries.items()
        for place, wanted in enumerate(query)
        for trigram in sorted(wanted)
    ]
    asked = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("_rule"),
                    F.lit(place).alias("_set"),
                    F.lit(size).alias("_wanted"),
                    F.lit(trigram).alias("_trigram"),
                )
                for name, place, size, trigram in sets
            ]
        )
    )
    # As many rows as the rules have trigrams.
    asked = F.broadcast(spark.range(1).select(asked))
    found = (
        postings.join(asked, "_trigram")
        .groupBy("_k1", "_k2", "_rule", "_set", "_wanted")
        .agg(F.count_distinct("_trigram").alias("_held"))
        .filter(F.col("_held") == F.col("_wanted"))
    )
    return found.groupBy("_k1", "_k2").agg(F.collect_set("_rule").alias("_rules"))


# ── Matches ──────────────────────────────────────────────────────────────────
def _matches(texts: DataFrame, rule: Rule, kind: int) -> DataFrame:
    """One row per match: its place among the rule's, and the lengths that give its span."""
    found = F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(0))
    between = F.split("_text", rule.pattern, -1)
    lengths = F.transform(
        F.arrays_zip(
            found.alias("found"),
            F.slice(between, F.lit(1), F.size(found)).alias("before"),
            F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(rule.group)).alias("group"),
        ),
        lambda m: F.struct(
            F.char_length(m["before"]).alias("_before"),
            F.char_length(m["found"]).alias("_length"),
            (F.char_length(m["group"]) >= rule.least).alias("_counts"),
        ),
    )
    matched = texts.filter(F.col("_text").rlike(rule.pattern))
    return matched.select(
        "_k1", "_k2", F.lit(kind).alias("_kind"), F.posexplode(lengths).alias("_place", "_match")
    ).select("_k1", "_k2", "_kind", "_place", "_match.*")


def _spans(matches: DataFrame) -> DataFrame:
    """Per text its spans in order of start, then of kind."""
    # Copies of a row give equal matches; they leave each task once.
    own = matches.groupBy("_k1", "_k2", "_kind", "_place").agg(
        *[F.any_value(c).alias(c) for c in ("_before", "_length", "_counts")]
    )
    own = own.repartition("_k1", "_k2")
    so_far = Window.partitionBy("_k1", "_k2", "_kind").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    end = F.sum(F.col("_before") + F.col("_length")).over(so_far)
    spans = own.withColumn("_end", end).filter("_counts")
    span = F.struct((F.col("_end") - F.col("_length")).alias("start"), F.col("_kind").alias("kind"), F.col("_end").alias("end"))
    return spans.groupBy("_k1", "_k2").agg(F.array_sort(F.collect_list(span)).alias("_spans"))


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Secrets in each text: ``_id`` and ``spans`` of ``kind``, ``start``, ``end``, ``base``.

    Every rule's regex gives sets of trigrams, one of which each match must hold. Texts are
    indexed under the trigrams that any rule asks for; postings are intersected per set,
    and only texts with a whole set are matched against the regex. Rules whose matches need
    hold no trigram are matched against all texts. Texts that no rule asks for are never
    shuffled but for the lookup of candidates, which Spark broadcasts where these are few.

    Spans are in code points, end exclusive, in order of start, then of rule. Each rule
    finds its own leftmost matches; spans of different rules may overlap. Null or empty
    texts have none. Rows with equal id and text get equal results. A long text is
    matched whole; its matches are rows, so their number does not bound it. Extra columns
    are ignored; an empty table gives an empty table.
    """
    keyed = _keyed(docs, id_col, text_col)
    texts = keyed.select("_k1", "_k2", "_text")
    queries = {rule.name: trigram_query(rule.pattern) for rule in rules}
    indexed = {name: query for name, query in queries.items() if query is not None}
    parts = []
    if indexed:
        wanted = sorted({t for query in indexed.values() for s in query for t in s})
        path = scratch_path(docs.sparkSession, "postings")
        build_index(keyed, wanted).write.parquet(path)
        candidates = _candidates(docs.sparkSession.read.parquet(path), indexed)
        asked = texts.join(candidates, ["_k1", "_k2"])
        # Candidates are few: looked up once, then matched rule by rule.
        path = scratch_path(docs.sparkSession, "candidates")
        asked.write.parquet(path)
        asked = docs.sparkSession.read.schema(asked.schema).parquet(path)
    for kind, rule in enumerate(rules):
        if rule.name in indexed:
            parts.append(_matches(asked.filter(F.array_contains("_rules", rule.name)), rule, kind))
        else:
            parts.append(_matches(texts, rule, kind))
    own = keyed.select("_id", "_k1", "_k2")
    if not parts:
        return own.select("_id", F.array().cast(_SPAN_TYPE).alias("spans"))
    names = F.array(*[F.lit(rule.name) for rule in rules])
    base = F.array(*[F.lit(rule.base) for rule in rules])
    spans = _spans(reduce(DataFrame.unionByName, parts))

    def named(span: Column) -> Column:
        return F.struct(
            F.get(names, span["kind"]).alias("kind"),
            span["start"].cast("int").alias("start"),
            span["end"].cast("int").alias("end"),
            F.get(base, span["kind"]).alias("base"),
        )

    found = F.coalesce(F.transform("_spans", named), F.array().cast(_SPAN_TYPE))
    return own.join(spans, ["_k1", "_k2"], "left").select("_id", found.alias("spans"))


_SPAN_TYPE = "array<struct<kind:string,start:int,end:int,base:boolean>>"
