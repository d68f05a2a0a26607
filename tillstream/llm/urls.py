"""URL filters: host and path rules, and boosted trees where no rule fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import cut, lower_ascii

ALLOW, BLOCK = "allow", "block"
# (host, path, verdict). A rule fits its host and all subdomains.
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)
# The trees are fitted on so many labelled URLs at most.
MOST_LABELLED = 4000
TREES, DEPTH, SEED = 20, 4, 42

_LEXICAL = (
    "url_chars",
    "host_chars",
    "path_chars",
    "host_labels",
    "path_depth",
    "digit_ratio",
    "entropy",
    "parameters",
    "suffix_share",
    "suffix_bad",
)
# The share of bad URLs under a suffix counts as if so many more had the share of all.
PRIOR = 20


def _between(url: Column, pattern: str) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)


def host_of(url: Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(_between(url, r"^(?s:.*?)://([^/?#]*)"))


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return _between(url, r"^(?s:.*?)://[^/?#]*([^?#]*)")


def longest_rule(
    host: Column, path: Column, rules: Sequence[tuple[str, str, str]]
) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does.

    Of rules of the same length the one that comes last in code point order wins.
    """
    order = sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1]), reverse=True)
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, decision in reversed(order):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(
            path, F.lit(rule_path)
        )
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits per character over a-z, digits and common signs; others count as one sign."""
    signs = "abcdefghijklmnopqrstuvwxyz0123456789-._~/"
    length = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    counts = F.transform(
        F.array(*[F.lit(c) for c in signs]),
        lambda c: F.char_length(text) - F.char_length(F.replace(text, c, F.lit(""))),
    )
    known = F.aggregate(counts, F.lit(0), lambda so_far, n: so_far + n)
    counts = F.concat(counts, F.array(F.char_length(text) - known))
    shares = F.transform(counts, lambda n: n / length)
    return F.aggregate(
        shares, F.lit(0.0), lambda bits, p: bits - F.when(p > 0, p * F.log2(p)).otherwise(0.0)
    )


def lexical_features(parts: DataFrame) -> DataFrame:
    """Columns of ``_LEXICAL`` but the suffix statistics, and ``_suffix``, the last host label.

    Rows have ``url``, ``host`` and ``path``.
    """
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    chars = F.greatest(F.char_length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return parts.withColumns(
        {
            "_suffix": F.element_at(F.split("host", r"\."), -1),
            "url_chars": F.char_length(url),
            "host_chars": F.char_length(host),
            "path_chars": F.char_length(path),
            "host_labels": F.size(F.split(host, r"\.")),
            "path_depth": F.regexp_count(path, F.lit(r"/[^/]")),
            "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / chars,
            "entropy": _entropy(F.lower(url)),
            "parameters": F.when(query == "", 0).otherwise(1 + F.regexp_count(query, F.lit("&"))),
        }
    )


def suffix_shares(lexical: DataFrame) -> DataFrame:
    """Share of all rows below each last host label: ``_suffix``, ``suffix_share``."""
    counts = cut(lexical.groupBy("_suffix").agg(F.count("*").alias("_pages")))
    pages = counts.agg(F.sum("_pages")).first()[0] or 1
    return counts.select("_suffix", (F.col("_pages") / pages).alias("suffix_share"))


def suffix_badness(labels: DataFrame, prior: int = PRIOR) -> tuple[DataFrame, float]:
    """Share of bad ones among labelled URLs below each last host label, and of all.

    ``labels`` has ``_suffix`` and ``label`` and is a bounded sample; a suffix with few
    labels is drawn towards the share of all, which also holds for unseen ones.
    """
    overall = labels.agg(F.avg("label")).first()[0]
    overall = 0.5 if overall is None else overall
    by_suffix = labels.groupBy("_suffix").agg(
        ((F.sum("label") + prior * overall) / (F.count("*") + prior)).alias("suffix_bad")
    )
    return by_suffix, overall


def fit_trees(sample: DataFrame) -> GBTClassificationModel:
    """Boosted trees on the columns ``_LEXICAL`` and ``label`` of a bounded sample."""
    assembler = VectorAssembler(inputCols=list(_LEXICAL), outputCol="_features")
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED
    )
    return trees.fit(assembler.transform(sample).select("_features", "label"))


def table_of(spark: SparkSession, labelled: Sequence[tuple[str, str]]) -> DataFrame:
    """``url`` and ``verdict`` of a short list, from one literal."""
    lines = F.lit("\n".join(f"{verdict} {url}" for url, verdict in labelled))
    split = spark.range(1).select(F.explode(F.split(lines, "\n")).alias("_line"))
    return split.select(
        F.substring_index("_line", " ", 1).alias("verdict"),
        F.regexp_extract("_line", "^[^ ]* (.*)$", 1).alias("url"),
    )


def labelled_sample(
    named: DataFrame, shares: DataFrame, most_labelled: int = MOST_LABELLED
) -> tuple[DataFrame, DataFrame, float]:
    """Features and ``label`` of labelled URLs, and what :func:`suffix_badness` says of them.

    ``named`` has ``url`` and ``verdict``; each URL counts once, with its least verdict,
    and ``most_labelled`` are taken at most, by a hash of the URL.
    """
    by_url = (
        named.filter("url is not null and verdict is not null")
        .groupBy("url")
        .agg(F.min("verdict").alias("verdict"))
        .orderBy(F.xxhash64("url"), "url")
        .limit(most_labelled)
        .select("url", (F.col("verdict") == BLOCK).cast("double").alias("label"))
        .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    )
    labels = cut(lexical_features(by_url))
    bad, overall = suffix_badness(labels)
    sample = cut(
        labels.join(shares, "_suffix", "left")
        .join(bad, "_suffix")
        .fillna(0.0, ["suffix_share"])
        .select(*_LEXICAL, "label", "url")
        .orderBy(F.xxhash64("url"), "url")
    )
    return sample, bad, overall


def judge_urls(
    pages: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """Host, path, rule and verdict of each page.

    The longest rule that fits decides. Where none does, gradient-boosted trees on
    lexical features do: lengths, depth, digit ratio, entropy, parameters, and of the
    suffix (last host label) its share of the pages and of bad labelled URLs. They are
    trained from labelled URLs: ``labelled`` with ``url`` and ``verdict``, which need not
    be among the pages, or else the pages that a rule decides; ``most_labelled`` of them
    at most, taken by a hash of the URL, so that a rerun takes the same.

    Returns a row per row of ``pages``: ``_id``, ``host``, ``path``, ``rule`` (like
    ``net/``, else null) and ``verdict``. A null URL or one without ``://`` has empty
    host and path and fits no rule. Where the labelled URLs all have one verdict, the
    others get it; without any labelled URL they are allowed. A very long URL is counted
    whole, once per sign of the entropy. An empty table gives an empty table.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    places = {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    parts = rows.withColumns(places)
    rule, decided = longest_rule(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "_decided": decided})
    lexical = lexical_features(parts)
    shares = suffix_shares(lexical)
    if labelled is None:
        named = parts.filter("_decided is not null").select("url", F.col("_decided").alias("verdict"))
    else:
        named = labelled.select("url", "verdict")
    sample, bad, overall = labelled_sample(named, shares, most_labelled)
    kinds = sorted(r["label"] for r in sample.select("label").distinct().collect())
    if len(kinds) == 2:
        # At most one row per labelled URL, so it may be held by every task.
        suffixes = shares.join(F.broadcast(bad), "_suffix", "left").fillna(overall, ["suffix_bad"])
        assembler = VectorAssembler(inputCols=list(_LEXICAL), outputCol="_features")
        features = lexical.join(suffixes, "_suffix")
        scored = fit_trees(sample).transform(assembler.transform(features))
        blocked = vector_to_array(F.col("probability"))[1] > 0.5
    else:
        scored, blocked = lexical, F.lit(kinds == [1.0])
    learned = F.when(blocked, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(
        "_id", "host", "path", "rule", F.coalesce("_decided", learned).alias("verdict")
    )
