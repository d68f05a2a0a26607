"""License scans: MinHash bands retrieve notices, shingle containment verifies them."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import cut, lower_ascii
from tillstream.llm.license_texts import NOTICES

SHINGLE = 5  # words
CONTAINED = 0.8
# Chance that the bands miss a window that holds enough of a notice.
MISS = 1e-6
# Notices are a short table that every task holds; more words than this are refused.
MOST_NOTICE_WORDS = 20_000
# Matches are compared within stretches of so many words, so none meets a whole text's.
STRETCH = 64
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Scale:
    """Windows for notices of up to ``words`` words: any such run lies within one."""

    words: int
    stride: int
    window: int
    bands: int


def notice_words(text: str) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(WORD, lowered)


def _shingles(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[k : k + SHINGLE]) for k in range(max(len(words) - SHINGLE + 1, 0))}


def scale_words(words: int) -> int:
    """Notices are scanned for with those of like length: the next power of two, 8 at least."""
    return max(8, 1 << (words - 1).bit_length())


def scales(
    notices: Mapping[str, str], miss: float = MISS, contained: float = CONTAINED
) -> dict[int, Scale]:
    """Windows and bands for each length of notice.

    Windows overlap so that a run of ``words`` words lies in one. A window that holds
    enough of a notice has a known least share of shingles in common with it; each band
    is one minimum, equal with that probability, so the number of bands bounds the
    chance that all differ.
    """
    found: dict[int, Scale] = {}
    for text in notices.values():
        words = notice_words(text)
        if len(words) < SHINGLE:
            continue
        size = scale_words(len(words))
        stride = size // 4
        own = len(_shingles(words))
        needed = math.ceil(contained * own)
        alike = needed / (size + stride - SHINGLE + 1 + own - needed)
        bands = math.ceil(math.log(miss) / math.log1p(-alike)) if alike < 1 else 1
        known = found.get(size)
        found[size] = Scale(size, stride, size + stride, max(bands, known.bands if known else 1))
    return found


def anchor_words(notices: Mapping[str, str], contained: float = CONTAINED) -> list[str]:
    """Words one of which every text with enough of any notice must hold.

    Per notice, words are added until fewer shingles lack one than the notice needs.
    Long words go first: they are rarer.
    """
    found: set[str] = set()
    for text in notices.values():
        rest = _shingles(notice_words(text))
        needed = math.ceil(contained * len(rest))
        while rest and len(rest) >= needed:
            words = sorted({w for s in rest for w in s})
            best = max(words, key=lambda w: (min(len(w), 7), sum(w in s for s in rest), w))
            found.add(best)
            rest = {s for s in rest if best not in s}
    return sorted(found)


def _hashes(words: str) -> Column:
    """Hash of the shingle at each place; none where there are too few words."""
    last = F.size(words) - SHINGLE
    own = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]),
    )
    return F.when(last >= 0, own).otherwise(F.array().cast("array<bigint>"))


def _minima(hashes: Column, bands: int) -> Column:
    """The least of the hashes under each of ``bands`` hash functions."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda band: F.array_min(F.transform(hashes, lambda h: F.xxhash64(band, h))),
    )


def _notice_table(spark: SparkSession, notices: Mapping[str, str]) -> DataFrame:
    """Each notice's scale and distinct shingle hashes, from literals."""
    rows = [
        F.struct(
            F.lit(name).alias("license"),
            F.lit(scale_words(len(words))).alias("scale"),
            F.array(*[F.lit(w) for w in words]).alias("words"),
        )
        for name, text in notices.items()
        if len(words := notice_words(text)) >= SHINGLE
    ]
    return (
        spark.range(1)
        .select(F.inline(F.array(*rows)))
        .select("license", "scale", F.array_distinct(_hashes("words")).alias("shingles"))
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    notices: Mapping[str, str] = NOTICES,
    contained: float = CONTAINED,
    miss: float = MISS,
    overlapping: bool = False,
) -> DataFrame:
    """License notices in each text, by name.

    Words are runs of digits, letters (A-Z lower-cased) and non-ASCII characters. A
    window holds a notice if at least ``contained`` of the notice's distinct five-word
    shingles stand in it. Overlapping windows suited to the length of each notice get
    MinHash bands, enough to miss one with probability ``miss`` at most; notices with an
    equal band are candidates, and exact containment decides. Texts without any word
    that all holders must have, and windows without any shingle of a notice, cannot
    hold one and are left out before.

    Licenses share much of their wording. A match is left out if another notice's match that
    overlaps it has every shingle it has, and more (as many: the higher containment, then
    the first name, is kept), unless ``overlapping``. A match spans its first to its last
    shingle in the window. So a text names each notice as itself, also next to its relatives.

    Returns a row per text and notice found: ``_id``, ``_row`` (its row), ``license``,
    ``containment`` (the most in any window) and ``first_word`` (start of the first such
    window). Notices of fewer than five words have no shingle and are never found. Null
    or short texts hold none; empty tables give an empty one. Equal rows are rows of their
    own. A very long text costs an array of its words and one of their hashes.
    """
    spark = docs.sparkSession
    total = sum(len(notice_words(t)) for t in notices.values())
    if total > MOST_NOTICE_WORDS:
        raise ValueError(f"{total} words of notices; {MOST_NOTICE_WORDS} can be held at most")
    by_scale = scales(notices, miss, contained)
    # Bounded by MOST_NOTICE_WORDS, so it may be held by every task.
    table = cut(_notice_table(spark, notices)) if by_scale else None
    kind = docs.schema[id_col].dataType.simpleString()
    result = f"_id {kind}, _row bigint, license string, containment double, first_word bigint"
    if table is None:
        return spark.createDataFrame([], result)
    known = [r[0] for r in table.select(F.explode("shingles")).distinct().collect()]

    text = F.col("_text")
    anchors = "|".join(anchor_words(notices, contained))
    hashed = (
        docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
        .filter(text.rlike(f"(?i)(?:{anchors})"))
        .select("_id", F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0)).alias("_words"))
        .select("_id", _hashes("_words").alias("_hashes"))
    )
    places = F.filter(
        F.transform("_hashes", lambda h, i: F.when(h.isin(known), i)), lambda i: i.isNotNull()
    )
    # Row numbers are fixed by the scan's splits, so a recomputed task gives the same.
    # No filter moves below a step that numbers rows: words and hashes above are made
    # once per text, not again for each filter on them.
    touched = hashed.select(
        "_id", F.monotonically_increasing_id().alias("_row"), "_hashes", places.alias("_places")
    ).filter(F.size("_places") > 0)

    def windows_of(scale: Scale) -> Column:
        """Numbers of the windows that hold any of the places."""
        around = F.transform(
            "_places",
            lambda p: F.sequence(
                F.greatest(
                    F.lit(0), F.ceil((p - (scale.window - SHINGLE)) / scale.stride).cast("int")
                ),
                F.floor(p / scale.stride).cast("int"),
            ),
        )
        return F.transform(
            F.array_distinct(F.flatten(around)),
            lambda n: F.struct(F.lit(scale.words).alias("scale"), (n * scale.stride).alias("start")),
        )

    size = F.lit(0)
    for scale in by_scale.values():
        size = F.when(F.col("_w.scale") == scale.words, scale.window - SHINGLE + 1).otherwise(size)
    windows = cut(
        touched.select(
            "_id",
            "_row",
            "_hashes",
            F.explode(F.concat(*[windows_of(s) for s in by_scale.values()])).alias("_w"),
        ).select(
            "_id",
            "_row",
            F.col("_w.scale").alias("scale"),
            F.col("_w.start").alias("start"),
            F.slice("_hashes", F.col("_w.start") + 1, size).alias("held"),
        )
    )

    def banded(rows: DataFrame, hashes: str, *keep: str) -> DataFrame:
        minima = F.lit(None).cast("array<bigint>")
        for scale in by_scale.values():
            minima = F.when(
                F.col("scale") == scale.words, _minima(F.col(hashes), scale.bands)
            ).otherwise(minima)
        return rows.select(*keep, "scale", F.posexplode(minima).alias("band", "least"))

    signatures = banded(table, "shingles", "license")
    candidates = (
        banded(windows, "held", "_row", "start")
        .join(F.broadcast(signatures), ["scale", "band", "least"])
        .select("_row", "scale", "start", "license")
        .distinct()
    )
    shared = F.array_intersect("held", "shingles")
    known_at = F.transform("held", lambda h, i: F.when(F.array_contains("shingles", h), i))
    verified = (
        windows.join(candidates, ["_row", "scale", "start"])
        .join(F.broadcast(table), ["license", "scale"])
        .select(
            "_id",
            "_row",
            "license",
            F.col("start").cast("bigint").alias("start"),
            shared.alias("shared"),
            (F.size(shared) / F.size("shingles")).alias("containment"),
            (F.col("start") + F.array_min(known_at)).alias("first"),
            (F.col("start") + F.array_max(known_at) + SHINGLE - 1).alias("last"),
        )
        .filter(F.col("containment") >= contained)
    )
    if not overlapping:
        verified = _named(cut(verified))
    return verified.groupBy("_id", "_row", "license").agg(
        F.max("containment").alias("containment"), F.min("start").alias("first_word")
    )


def _named(found: DataFrame) -> DataFrame:
    """The matches whose shingles are not all another overlapping notice's as well.

    Matches meet within stretches of a text. A stretch lies in few windows of each scale,
    so its number of matches is bounded by the notices, whatever the text's length.
    """
    stretches = F.sequence(F.floor(F.col("first") / STRETCH), F.floor(F.col("last") / STRETCH))
    spans = found.withColumn("stretch", F.explode(stretches))
    own, other = spans.alias("own"), spans.alias("other")
    rank = [F.struct(F.size(f"{s}.shared"), F.col(f"{s}.containment")) for s in ("own", "other")]
    first_name = F.col("other.license") < F.col("own.license")
    explained = (
        (F.col("own._row") == F.col("other._row"))
        & (F.col("own.stretch") == F.col("other.stretch"))
        & (F.col("own.license") != F.col("other.license"))
        & (F.col("other.first") <= F.col("own.last"))
        & (F.col("own.first") <= F.col("other.last"))
        & ((rank[1] > rank[0]) | ((rank[1] == rank[0]) & first_name))
        & (F.size(F.array_except("own.shared", "other.shared")) == 0)
    )
    keys = ["_row", "license", "start"]
    return found.join(own.join(other, explained, "left_semi").select(*keys), keys, "left_anti")
