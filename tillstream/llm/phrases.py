"""Phrase collocations: Rabin-Karp fingerprints, verified against the text, then scored."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.llm.common import mix, scratch_path, utf8_pieces, word_spans

MAX_WORDS = 4
MIN_COUNT = 30
COVERED_PCT = 80
TOP = 2000
SCORE_SCALE = 2_000_000
NO_LANGUAGE = "und"

# Bits of the filters that tasks hold. Their size is fixed: with very many entries they
# let more through, which is counted and thrown away later.
FILTER_BITS = 1 << 25
# Words that are hashed at a time, whatever the length of their text.
CHUNK_WORDS = 1 << 18

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A") : ord("Z") + 1] += 32
_IS_SPLIT = np.zeros(256, dtype=bool)
_IS_SPLIT[list(b".,;:!?\n\x0b\x0c\r")] = True
_IN_WORD = ~_IS_SPLIT
_IN_WORD[list(b" \t")] = False

_COUNTED = "print bigint, check bigint, count bigint, pointer bigint"
# A pointer is 31 bits of its document's key and 32 of the place of its first word.
_KEY_MASK = (1 << 31) - 1
_LENGTH_BITS = 2  # of a fingerprint: the number of words less one


class RollingHash:
    """Polynomial hash modulo 2**64 of any range of bytes, from prefix sums."""

    def __init__(self, seed: int) -> None:
        codes = mix(np.arange(1, 258, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self._codes, self._base = codes[:256], int(codes[256]) | 1
        self._forward = self._backward = np.ones(1, dtype=np.uint64)

    def _powers(self, base: int, count: int) -> np.ndarray:
        steps = np.full(count, base % (1 << 64), dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        if len(self._forward) < len(data) + 1:
            count = 1 << len(data).bit_length()
            self._forward = self._powers(self._base, count)
            self._backward = self._powers(pow(self._base, -1, 1 << 64), count)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self._codes[data] * self._forward[: len(data)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self._backward[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of a few texts, in a copy of them with single spaces between words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        data = _LOWERED[data]
        member = _IN_WORD[data]
        starts, ends, first_words = word_spans(member, offsets)
        self.rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first_words))
        self.places = np.arange(len(starts)) - first_words[:-1][self.rows]
        # Whether a word and the next one are in one piece of one text.
        splits = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(_IS_SPLIT[data], out=splits[1:])
        self.joined = (splits[ends[:-1]] == splits[starts[1:]]) & (self.rows[:-1] == self.rows[1:])
        # Of the bytes between words the first is kept, as a space.
        kept = member.copy()
        kept[1:] |= member[:-1]
        self.data = np.where(member, data, np.uint8(32))[kept]
        before = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(kept, out=before[1:])
        self.starts = before[starts]
        self.ends = self.starts + (ends - starts)

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, first: int, count: int) -> str:
        return self.data[self.starts[first] : self.ends[first + count - 1]].tobytes().decode()

    def same(self, one: np.ndarray, other: np.ndarray, count: int) -> bool:
        """Whether the phrases of ``count`` words at each pair of places are equal."""
        if len(one) == 0:
            return True
        ids = self._ids()
        return all(np.array_equal(ids[one + k], ids[other + k]) for k in range(count))

    def _ids(self) -> np.ndarray:
        """A number for each distinct word, by comparing words themselves."""
        if not hasattr(self, "_word_ids"):
            lengths = self.ends - self.starts
            ends = np.cumsum(lengths)
            inside = np.ones(len(self.data), dtype=bool)
            inside[self.ends[self.ends < len(self.data)]] = False
            # A text that ends in a word has no space behind it.
            inside[self.starts] = True
            offsets = np.concatenate([[0], ends]).astype(np.int64)
            words = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(),
                len(lengths),
                [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.data[inside]))],
            )
            self._word_ids = np.asarray(words.dictionary_encode().indices)
        return self._word_ids


class Fingerprints:
    """Fingerprints of phrases: a 64-bit key that holds their length, and a second hash."""

    def __init__(self, bits: int = 64) -> None:
        self._mask = np.uint64(((1 << bits) - 1) << (64 - bits) & ~((1 << _LENGTH_BITS) - 1))
        self._one, self._two = RollingHash(1), RollingHash(2)

    def of(
        self, words: Words, low: int, high: int, lengths: Iterable[int], tags: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, first words, prints, checks) of the phrases that start in low..high.

        ``tags`` are hashes of the words' languages, so equal phrases of two languages
        differ.
        """
        last = min(high + MAX_WORDS - 1, len(words))
        base = words.starts[low]
        data = words.data[base : words.ends[last - 1]]
        sums = self._one.prefixes(data), self._two.prefixes(data)
        for count in lengths:
            firsts = np.arange(low, min(high, last - count + 1))
            for k in range(count - 1):
                firsts = firsts[words.joined[firsts + k]]
            if len(firsts) == 0:
                continue
            starts, ends = words.starts[firsts] - base, words.ends[firsts + count - 1] - base
            tag = tags[words.rows[firsts]]
            prints = mix(self._one.ranges(sums[0], starts, ends) ^ tag) & self._mask
            checks = mix(self._two.ranges(sums[1], starts, ends) + tag)
            yield count, firsts, prints | np.uint64(count - 1), checks


def _filter_places(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    spread, mask = mix(values), np.uint64(bits - 1)
    return spread & mask, (spread >> np.uint64(32)) & mask


def _held(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values the filter may hold."""
    found = np.ones(len(values), dtype=bool)
    for place in _filter_places(values, 64 * len(packed)):
        found &= (packed[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found


def bit_filter(values: DataFrame, bits: int) -> np.ndarray:
    """A filter over the one bigint column; at most bits / 64 rows come to the driver."""

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column(0)).astype(np.int64, copy=False).view(np.uint64)
            places = np.unique(np.concatenate(_filter_places(own, bits)))
            yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int64))], names=["place"])

    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    rows = (
        values.mapInArrow(placed, "place bigint")
        .groupBy(F.shiftright("place", 6).alias("at"))
        .agg(F.bit_or(bit).alias("bits"))
        .toPandas()
    )
    packed = np.zeros(bits // 64, dtype=np.uint64)
    if len(rows):
        packed[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return packed


def _column(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def _counted(
    words: Words, count: int, firsts: np.ndarray, prints: np.ndarray, checks: np.ndarray, keys: np.ndarray
) -> pa.RecordBatch:
    """One row per phrase: how often it occurs here and one occurrence.

    Occurrences that share their fingerprints are compared word by word.
    """
    order = np.lexsort((checks, prints))
    prints, checks, firsts = prints[order], checks[order], firsts[order]
    again = (prints[1:] == prints[:-1]) & (checks[1:] == checks[:-1])
    if not words.same(firsts[:-1][again], firsts[1:][again], count):
        raise ValueError("two phrases share both fingerprints; choose other seeds")
    begins = np.concatenate([[0], np.flatnonzero(~again) + 1])
    pointers = (keys[words.rows[firsts]] << np.int64(32)) | words.places[firsts]
    return pa.RecordBatch.from_arrays(
        [
            _column(prints[begins]),
            _column(checks[begins]),
            pa.array(np.diff(np.append(begins, len(prints)))),
            pa.array(np.minimum.reduceat(pointers, begins)),
        ],
        names=["print", "check", "count", "pointer"],
    )


def _phrase_counts(
    rows: DataFrame,
    lengths: tuple[int, ...],
    parts: int,
    packed: np.ndarray | None,
    bits: int,
) -> DataFrame:
    """Occurrences of phrases of so many words: ``print``, ``check``, ``a``, ``pointer``.

    With a filter only phrases are counted of which all parts of ``parts`` words are in
    it. Without one a row per language is added, with its hash as ``check`` and the
    length code of `MAX_WORDS`: the number of its words.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints_of = Fingerprints(bits)
        for batch in batches:
            all_keys = np.asarray(batch.column(0)).astype(np.int64, copy=False)
            all_tags = np.asarray(batch.column(1)).astype(np.int64, copy=False).view(np.uint64)
            for first, last, data, offsets in utf8_pieces(batch.column(2)):
                words = Words(data, offsets)
                keys, tags = all_keys[first:last], all_tags[first:last]
                for low in range(0, len(words), CHUNK_WORDS):
                    high = min(low + CHUNK_WORDS, len(words))
                    yield from chunk(prints_of, words, low, high, keys, tags)

    def chunk(
        prints_of: Fingerprints, words: Words, low: int, high: int, keys: np.ndarray, tags: np.ndarray
    ) -> Iterator[pa.RecordBatch]:
        if packed is None:
            found, amounts = np.unique(tags[words.rows[low:high]], return_counts=True)
            code = np.uint64(MAX_WORDS - 1)
            total = [(found & ~code) | code, found, amounts.astype(np.uint64), np.zeros_like(found)]
            yield pa.RecordBatch.from_arrays([_column(c) for c in total], names=_COUNTED_NAMES)
            frequent = None
        else:
            # Phrases of the last words of the chunk need the words behind it.
            frequent = np.zeros(min(high + MAX_WORDS, len(words)) + 1, dtype=bool)
            ahead = min(high + MAX_WORDS - parts, len(words))
            for _, firsts, prints, _ in prints_of.of(words, low, ahead, (parts,), tags):
                frequent[firsts] = _held(packed, prints)
        for count, firsts, prints, checks in prints_of.of(words, low, high, lengths, tags):
            if frequent is not None:
                kept = reduce(np.logical_and, (frequent[firsts + k] for k in range(count - parts + 1)))
                firsts, prints, checks = firsts[kept], prints[kept], checks[kept]
            if len(firsts):
                yield _counted(words, count, firsts, prints, checks, keys)

    partial = rows.mapInArrow(counted, _COUNTED)
    return partial.groupBy("print", "check").agg(
        F.sum("count").alias("a"), F.min("pointer").alias("pointer")
    )


_COUNTED_NAMES = ["print", "check", "count", "pointer"]


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_POINTED = "lang string, phrase string, words int, a bigint"


def _phrases_at(rows: DataFrame, frequent: DataFrame, filter_bits: int, bits: int) -> DataFrame:
    """The text of each frequent fingerprint, read at its pointer and hashed again.

    Only documents that a pointer may mean are shuffled, each once. A document's pointers
    are no more than its phrases.
    """
    pointers = frequent.select(
        F.shiftright("pointer", 32).alias("_key"),
        F.struct(
            "print", "check", "a", F.col("pointer").bitwiseAND((1 << 32) - 1).alias("place")
        ).alias("_at"),
    )
    packed = bit_filter(pointers.select("_key"), filter_bits)

    def meant(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0)).astype(np.int64, copy=False).view(np.uint64)
            yield batch.filter(pa.array(_held(packed, keys)))

    texts = rows.select("_key", "_tag", "_text", "_lang", "_whole_key")
    # Repeated rows leave each task once.
    texts = texts.mapInArrow(meant, texts.schema).groupBy("_whole_key", "_key", "_tag", "_lang").agg(
        F.any_value("_text").alias("_text")
    )
    pointers = pointers.groupBy("_key").agg(F.collect_list("_at").alias("_at"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints_of = Fingerprints(bits)
        for batch in batches:
            for row in range(batch.num_rows):
                _, _, data, offsets = next(utf8_pieces(batch.column(1).slice(row, 1)))
                words = Words(data, offsets)
                tag = np.asarray(batch.column(0).slice(row, 1)).astype(np.int64, copy=False).view(np.uint64)
                at = batch.column(3).slice(row, 1).flatten()
                wanted = [np.asarray(at.field(k)).astype(np.int64, copy=False) for k in range(4)]
                found = _read_at(prints_of, words, tag, *wanted)
                lang = batch.column(2).slice(row, 1)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.concat_arrays([lang] * len(found)),
                            pa.array([f[0] for f in found]),
                            pa.array([f[1] for f in found], pa.int32()),
                            pa.array([f[2] for f in found], pa.int64()),
                        ],
                        names=["lang", "phrase", "words", "a"],
                    )

    joined = texts.join(pointers, "_key").select("_tag", "_text", "_lang", "_at")
    return joined.mapInArrow(read, _POINTED).groupBy("lang", "phrase", "words").agg(F.max("a").alias("a"))


def _read_at(
    prints_of: Fingerprints,
    words: Words,
    tag: np.ndarray,
    prints: np.ndarray,
    checks: np.ndarray,
    amounts: np.ndarray,
    places: np.ndarray,
) -> list[tuple[str, int, int]]:
    """(phrase, words, occurrences) of the pointers whose text has the wanted hashes."""
    found: list[tuple[str, int, int]] = []
    counts = (prints & ((1 << _LENGTH_BITS) - 1)) + 1
    for low in range(0, len(words), CHUNK_WORDS):
        high = min(low + CHUNK_WORDS, len(words))
        for count, firsts, own, own_checks in prints_of.of(
            words, low, high, range(1, MAX_WORDS + 1), tag
        ):
            asked = np.flatnonzero((counts == count) & (places >= low) & (places < high))
            at = np.searchsorted(firsts, places[asked])
            inside = at < len(firsts)
            asked, at = asked[inside], at[inside]
            right = (
                (firsts[at] == places[asked])
                & (own[at].view(np.int64) == prints[asked])
                & (own_checks[at].view(np.int64) == checks[asked])
            )
            found += [
                (words.text(int(places[k]), count), count, int(amounts[k])) for k in asked[right]
            ]
    return found


def frequent_phrases(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    filter_bits: int = FILTER_BITS,
    bits: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """Phrases of one to four words that occur ``min_count`` times in a language, and sizes.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` and then into words at
    blanks and tabs; occurrences overlap and stay within a piece. Returns (``lang``,
    ``phrase``, ``words``, ``a``) and (``lang_hash``, ``n`` words).

    Prefix polynomials hash every phrase; tasks send a count and a pointer per fingerprint
    (126 bits), so phrases are materialised only where they are frequent. Within a task
    all occurrences of a fingerprint are compared as words; the text that a pointer leads
    to is hashed again. A phrase can be frequent only if its parts are: words are counted
    first, then pairs of frequent words, then phrases of frequent pairs. Filters of fixed
    size hold these; a full one lets more through and changes no result. ``bits`` shortens
    the fingerprints, for tests.

    A null language is ``und``, a null text has no words. Repeated rows count each time.
    A long text is hashed in pieces of words; tasks hold some 15 bytes for each of its
    bytes besides. Empty tables give empty tables.
    """
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    whole_key = F.xxhash64(F.col(f"`{id_col}`"), text)
    rows = docs.select(
        whole_key.bitwiseAND(_KEY_MASK).alias("_key"),
        F.xxhash64(lang).alias("_tag"),
        text.alias("_text"),
        lang.alias("_lang"),
        whole_key.alias("_whole_key"),
    )
    texts = rows.select("_key", "_tag", "_text")
    code = F.col("print").bitwiseAND((1 << _LENGTH_BITS) - 1)

    words = _phrase_counts(texts, (1,), 1, None, bits)
    words = _stored(words.filter((F.col("a") >= min_count) | (code == MAX_WORDS - 1)), "words")
    sizes = words.filter(code == MAX_WORDS - 1).select(F.col("check").alias("lang_hash"), F.col("a").alias("n"))
    single = words.filter(code == 0)
    found, shorter = [single], single
    for lengths in ((2,), tuple(range(3, MAX_WORDS + 1))):
        packed = bit_filter(shorter.select("print"), filter_bits)
        counted = _phrase_counts(texts, lengths, lengths[0] - 1, packed, bits)
        shorter = _stored(counted.filter(F.col("a") >= min_count), f"phrases{lengths[0]}")
        found.append(shorter)
    frequent = reduce(DataFrame.unionByName, found)
    return _phrases_at(rows, frequent, filter_bits, bits), sizes


def _scored_cuts(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each candidate: its ``score``, ``l`` and ``r``."""
    words = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "a", words.alias("_w")).select(
        "*", F.explode(F.sequence(F.lit(1), F.size("_w") - 1)).alias("_cut")
    )

    def part(start: Column, count: Column) -> Column:
        return F.array_join(F.slice("_w", start, count), " ")

    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "_cut",
        part(F.lit(1), F.col("_cut")).alias("_left"),
        part(F.col("_cut") + 1, F.size("_w") - F.col("_cut")).alias("_right"),
    )
    for side, name in (("_left", "l"), ("_right", "r")):
        counts = phrases.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
        cuts = cuts.join(counts, ["lang", side])
    a, parts = (c.cast("decimal(20,0)") for c in (F.col("a"), F.col("l") + F.col("r")))
    score = F.call_function("div", F.lit(SCORE_SCALE).cast("decimal(10,0)") * a, parts)
    lowest = F.min(F.struct(score.alias("score"), "_cut", "l", "r"))
    return (
        cuts.groupBy("lang", "phrase", "a")
        .agg(lowest.alias("_lowest"))
        .select("lang", "phrase", "a", "_lowest.score", "_lowest.l", "_lowest.r")
    )


def _covers(candidates: DataFrame) -> DataFrame:
    """How often the commonest longer candidate around each shorter one occurs."""
    words = F.split("phrase", " ")
    inner = candidates.filter("words > 2").select("lang", "a", "words", words.alias("_w"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("_count"))
    inner = inner.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_count") + 1)).alias("_start")
    )
    part = F.array_join(F.slice("_w", F.col("_start"), F.col("_count")), " ")
    return inner.groupBy("lang", part.alias("phrase")).agg(F.max("a").alias("_longer"))


def collocations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    covered_pct: int = COVERED_PCT,
    top: int = TOP,
    filter_bits: int = FILTER_BITS,
    bits: int = 64,
) -> DataFrame:
    """The ``top`` phrases of each language by how much their parts keep together.

    A phrase of two to four words is scored by its lowest-scoring cut into two parts,
    ``2000000 * a / (l + r)``, exactly. One that lies inside a longer frequent phrase with
    at least ``covered_pct`` percent of its occurrences is left out. Ties go by ``a``, then
    by the phrase's bytes. Columns: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``,
    ``n``, ``score``. See `frequent_phrases` for nulls, long texts and memory.
    """
    phrases, sizes = frequent_phrases(docs, id_col, text_col, lang_col, min_count, filter_bits, bits)
    phrases = _stored(phrases, "phrases")
    candidates = phrases.filter("words > 1")
    scored = _scored_cuts(candidates, phrases).join(_covers(candidates), ["lang", "phrase"], "left")
    kept = scored.filter(
        F.col("_longer").isNull() | (100 * F.col("_longer") < covered_pct * F.col("a"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    ranked = ranked.withColumn("lang_hash", F.xxhash64("lang"))
    return ranked.join(sizes, "lang_hash").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
