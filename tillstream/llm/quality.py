"""Quality rules whose cutoffs bound the good documents they reject."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import WordHasher, cut, gram_hashes, null_safe, utf8_pieces, word_spans

WINDOW = 8  # words of a window that may repeat
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
MOST_REPEATED = 30  # percent of a text's words

# Share of a stratum's good documents that all rules together may reject, and the
# chance that any of the bounds fails to hold.
RISK, CONFIDENCE_LEFT = 0.02, 0.05

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_FEATURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A text fails if ``value`` is above the cutoff, or below it if ``below``."""

    name: str
    value: str
    cutoffs: tuple[float, ...]
    below: bool = False


# Cutoffs from the strictest to the mildest; they are fixed before any label is seen.
RULES = (
    Rule("symbols", "n_symbols / n_words", (0.02, 0.05, 0.1, 0.2, 0.4, 0.8)),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", (0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),
    Rule("repeats", "n_repeat_words / n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.25)),
    Rule("long_words", "word_chars / n_words", (8.0, 9.0, 10.0, 12.0, 15.0, 20.0)),
    Rule("short_words", "word_chars / n_words", (4.0, 3.5, 3.0, 2.5, 2.0, 1.5), below=True),
)


def _counts(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> list[np.ndarray]:
    """The features of some texts, by prefix sums over their bytes and words."""

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    texts = len(offsets) - 1
    blank = _BLANK[data]
    starts, ends, first_words = word_spans(~blank, offsets)
    n_words = np.diff(first_words)
    word_chars = per_text(~blank & ((data & 0xC0) != 0x80))
    n_symbols = per_text(_SYMBOL[data])

    # Lines are the stretches between line feeds, whole and exact.
    line_starts, line_ends, first_lines = word_spans(data != 10, offsets)
    words_before = np.searchsorted(starts, line_starts)
    has_word = np.searchsorted(starts, line_ends) > words_before
    line_text = np.searchsorted(offsets, line_starts, side="right") - 1
    lines = hasher(data, line_starts, line_ends)
    line_starts, lines, line_text = line_starts[has_word], lines[has_word], line_text[has_word]
    n_lines = np.bincount(line_text, minlength=texts)
    order = np.lexsort((lines, line_text))
    again = np.zeros(len(lines), dtype=bool)
    again[1:] = (lines[order][1:] == lines[order][:-1]) & (
        line_text[order][1:] == line_text[order][:-1]
    )
    n_dup = np.bincount(line_text[order], weights=again, minlength=texts).astype(np.int64)

    words = hasher(data, starts, ends)
    grams = gram_hashes(words, WINDOW)
    of_text = np.searchsorted(first_words, np.arange(len(grams)), side="right") - 1
    whole = np.flatnonzero(first_words[of_text + 1] - np.arange(len(grams)) >= WINDOW)
    order = whole[np.lexsort((grams[whole], of_text[whole]))]
    same = (grams[order][1:] == grams[order][:-1]) & (of_text[order][1:] == of_text[order][:-1])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[order[twice]] += 1
    edges[order[twice] + WINDOW] -= 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(np.cumsum(edges[:-1]) > 0, out=covered[1:])
    n_repeat = covered[first_words[1:]] - covered[first_words[:-1]]
    return [n_words, word_chars, n_symbols, n_lines, n_dup, n_repeat]


def text_features(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang"
) -> DataFrame:
    """Counts of each whole text, with ``_id``, ``_text_hash`` and ``_stratum``."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for first, last, data, offsets in utf8_pieces(batch.column(0)):
                columns = _counts(data, offsets, hasher)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int64)) for c in columns]
                    + [c.slice(first, last - first) for c in batch.columns[1:]],
                    names=[*_FEATURES, *batch.schema.names[1:]],
                )

    kinds = {c: docs.schema[c].dataType.simpleString() for c in (id_col, stratum_col)}
    schema = ", ".join(f"{f} bigint" for f in _FEATURES)
    return docs.select(
        F.col(f"`{text_col}`").alias("_text"),
        F.xxhash64(F.coalesce(f"`{text_col}`", F.lit(""))).alias("_text_hash"),
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{stratum_col}`").alias("_stratum"),
    ).mapInArrow(
        counted, f"{schema}, _text_hash bigint, _id {kinds[id_col]}, _stratum {kinds[stratum_col]}"
    )


def binomial_at_most(found: int, trials: int, rate: float) -> float:
    """Probability of ``found`` or fewer among ``trials``, from the largest term down."""
    if found >= trials:
        return 1.0
    if rate <= 0:
        return 1.0
    log_term = (
        math.lgamma(trials + 1)
        - math.lgamma(found + 1)
        - math.lgamma(trials - found + 1)
        + found * math.log(rate)
        + (trials - found) * math.log1p(-rate)
    )
    total, term, k = 1.0, 1.0, found
    # Above the mean the sum is at least about a half: no bound holds there.
    if found >= trials * rate:
        return 1.0
    while k > 0 and term > 1e-17 * total:
        term *= k / (trials - k + 1) * (1 - rate) / rate
        total += term
        k -= 1
    return min(1.0, math.exp(log_term + math.log(total)))


def _fails(rule: Rule, cutoff: Column) -> Column:
    value = F.expr(rule.value)
    return value < cutoff if rule.below else value > cutoff


def _path(harm: np.ndarray, caught: np.ndarray, steps: list[int]) -> list[tuple[int, int]]:
    """(rule, how many of its cutoffs are taken, mildest first), in the order to test.

    Next comes the rule that has a cutoff ahead with the least harm for what it catches.
    """
    taken, path = [0] * len(steps), []

    def cost(rule: int) -> float:
        low, ahead = taken[rule], slice(taken[rule] + 1, steps[rule] + 1)
        new_harm = harm[rule, ahead] - harm[rule, low]
        return ((1 + new_harm) / (1 + caught[rule, ahead] - caught[rule, low])).min()

    while open_rules := [r for r in range(len(steps)) if taken[r] < steps[r]]:
        rule = min(open_rules, key=lambda r: (cost(r), r))
        taken[rule] += 1
        path.append((rule, taken[rule]))
    return path


def _proven(levels: np.ndarray, counts: np.ndarray, path: list[tuple[int, int]], risk: float, level: float) -> list[int]:
    """Cutoffs taken per rule, up to the first step of ``path`` that cannot be proven.

    ``levels`` has a row per kind of document with the cutoffs it fails per rule, in
    steps from the end of the rule's cutoffs: it falls at the step of that number.
    """
    rules = levels.shape[1]
    step_of = np.full((rules, levels.max(initial=0) + len(path) + 2), len(path))
    for step, (rule, number) in enumerate(path):
        step_of[rule, number] = step
    falls = step_of[np.arange(rules), levels].min(axis=1)
    rejected = np.cumsum(np.bincount(falls, weights=counts, minlength=len(path) + 1)[: len(path)])
    taken = [0] * rules
    for (rule, number), found in zip(path, rejected, strict=True):
        if binomial_at_most(int(found), int(counts.sum()), risk) > level:
            break
        taken[rule] = number
    return taken


def choose_cutoffs(
    good: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    risk: float = RISK,
    confidence_left: float = CONFIDENCE_LEFT,
    bad: DataFrame | None = None,
) -> DataFrame:
    """Per stratum and rule, the strictest cutoff proven to reject few good documents.

    ``good`` holds the features of documents labelled good, ``bad`` of those labelled
    otherwise. In each stratum the cutoffs are taken one by one, mildest first, and each
    step is a test of "the rules taken so far reject, together, more than ``risk`` of the
    stratum's good documents", by the exact binomial probability of rejecting as few as
    were rejected. The first step that is not proven ends the stratum. Each step rejects
    all that the one before did, and their order is reckoned from the documents labelled
    bad and the good ones of *other* strata only, so steps need no correction among
    themselves. Strata share ``confidence_left``; those whose labels are too few to prove
    anything, were none rejected, are not tested and take no share. So with probability
    1 - ``confidence_left`` no stratum breaks its bound. A cutoff not reached is null and
    the rule rejects nothing.

    Counts are aggregated over all rows by stratum and cutoffs failed; strata are tested
    where they are.
    """
    levels = [f"_level{k}" for k in range(len(rules))]
    steps = [len(r.cutoffs) for r in rules]

    def kinds(rows: DataFrame, is_good: int) -> DataFrame:
        # Of n cutoffs a document that fails f falls at step n - f + 1; n + 1 is never.
        fallen = [
            (len(r.cutoffs) + 1 - sum(F.coalesce(_fails(r, F.lit(c)), F.lit(False)).cast("int") for c in r.cutoffs)).alias(v)
            for r, v in zip(rules, levels, strict=True)
        ]
        return rows.select("_stratum", *fallen, F.lit(is_good).alias("_good"))

    rows = kinds(good, 1) if bad is None else kinds(good, 1).unionByName(kinds(bad, 0))
    cells = cut(
        rows.groupBy("_stratum", *levels).agg(
            F.sum("_good").alias("_good"), F.count_if(F.col("_good") == 0).alias("_bad")
        )
    )
    places = [(r, k) for r in range(len(rules)) for k in range(1, steps[r] + 1)]
    total = cells.agg(
        *[
            F.coalesce(F.sum(F.when(F.col(levels[r]) <= k, F.col(c))), F.lit(0)).alias(f"{c}{r}_{k}")
            for r, k in places
            for c in ("_good", "_bad")
        ]
    ).first()
    harm, caught = np.zeros((2, len(rules), max(steps, default=0) + 1))
    for r, k in places:
        harm[r, k], caught[r, k] = total[f"_good{r}_{k}"], total[f"_bad{r}_{k}"]

    # The fewest strata, as a power of two, that suffice for all that can prove something
    # when so many share the level; those found then share it.
    def can_prove(level: float) -> Column:
        return F.col("_n") * math.log1p(-risk) <= math.log(level)

    sizes = cells.groupBy("_stratum").agg(F.sum("_good").alias("_n"))
    able = sizes.agg(*[F.count_if(can_prove(confidence_left / 2**k)).alias(f"n{k}") for k in range(48)]).first()
    shares = next(k for k in range(48) if able[f"n{k}"] <= 2**k)
    least = confidence_left / 2**shares
    level = confidence_left / max(able[f"n{shares}"], 1)

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[float | None]] = []
            for row in batch.column(1).to_pylist():
                own = np.array([c[:-1] for c in row], dtype=np.int64).reshape(-1, len(rules))
                counts = np.array([c[-1] for c in row], dtype=np.int64)
                taken = [0] * len(rules)
                if counts.sum() * math.log1p(-risk) <= math.log(least):
                    elsewhere = harm.copy()
                    for r, k in places:
                        elsewhere[r, k] -= counts[own[:, r] <= k].sum()
                    taken = _proven(own, counts, _path(elsewhere, caught, steps), risk, level)
                found.append([r.cutoffs[-n] if n else None for r, n in zip(rules, taken, strict=True)])
            columns = [pa.array([f[r] for f in found], pa.float64()) for r in range(len(rules))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["_stratum", *[r.name for r in rules]]
            )

    kind = good.schema["_stratum"].dataType.simpleString()
    schema = f"_stratum {kind}, " + ", ".join(f"{r.name} double" for r in rules)
    return (
        cells.groupBy("_stratum")
        .agg(F.collect_list(F.array(*[F.col(v).cast("long") for v in levels], "_good")).alias("_cells"))
        .mapInArrow(chosen, schema)
    )


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    rules: tuple[Rule, ...] = RULES,
    risk: float = RISK,
    confidence_left: float = CONFIDENCE_LEFT,
) -> DataFrame:
    """Features of each document, ``base_failed``, the rules it fails, and ``kept``.

    Base: fewer than ``MIN_WORDS`` words, or more than ``MOST_REPEATED`` percent of the
    words in repeated windows. The cutoffs of ``rules`` come from ``choose_cutoffs``
    over all labelled documents, by ``stratum_col``. A document labelled more than once
    is good if its least label is 1; null labels and ids label nothing. A null stratum
    is a stratum. Null or empty text has no words and fails the base. Empty labels
    leave all rules without cutoffs. A row per row of ``docs`` comes back.
    """
    features = cut(text_features(docs, id_col, text_col, stratum_col))
    n_words = F.col("n_words")
    base_failed = (n_words < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * n_words
    )
    judged = features.withColumn("base_failed", base_failed)
    labelled = (
        labels.select(F.col(f"`{label_id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_label"))
        .filter("_id is not null and _label is not null")
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
    )
    # Copies of a row are one document, and one trial of the tests.
    known = judged.filter("not base_failed").join(labelled, "_id")
    known = known.dropDuplicates(["_id", "_text_hash"])
    cutoffs = cut(
        choose_cutoffs(
            known.filter("_label = 1"), rules, risk, confidence_left, known.filter("_label <> 1")
        )
    )
    joined = judged.join(cutoffs, null_safe(judged, cutoffs, "_stratum"), "left")
    failed = F.array_compact(
        F.array(*[F.when(_fails(r, F.col(r.name)), F.lit(r.name)) for r in rules])
    )
    return joined.select(
        "_id",
        "_text_hash",
        judged["_stratum"].alias("_stratum"),
        *_FEATURES,
        "base_failed",
        F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(failed).alias("failed_rules"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
