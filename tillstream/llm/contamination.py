"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import (
    WordHasher,
    cut,
    gram_hashes,
    mix,
    null_safe,
    utf8_pieces,
    word_spans,
)

WINDOW = 13  # words of a window
GRAM = 5  # words of a hashed gram; a window holds WINDOW - GRAM + 1 of them
# Bits of the filter that documents are held against before the join. Its size is
# fixed; with a very large benchmark it lets more through, and the join decides.
FILTER_BITS = 1 << 23

# Bytes of words once A-Z are lower-cased: digits, a-z and all of a non-ASCII character.
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[ord("0") : ord("9") + 1] = _IN_WORD[ord("a") : ord("z") + 1] = _IN_WORD[128:] = True

_PRINTS = "array<struct<start:int,length:int,print:bigint,left:array<bigint>,right:array<bigint>>>"


def _last_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` neighbours, the last of equal ones, by doubling."""
    done, places = 1, np.arange(len(values))
    while done < width:
        step = min(done, width - done)
        one, two = places[: len(places) - step], places[step:]
        places = np.where(values[two] <= values[one], two, one)
        done += step
    return places


class _Winnower:
    """Fingerprints of texts: of each window the least gram hash, with the words around it."""

    def __init__(self, window: int, gram: int) -> None:
        self.window, self.gram = window, gram
        self.hasher = WordHasher()

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = _LOWERED[data]
        starts, ends, first_words = word_spans(_IN_WORD[data], offsets)
        return self.hasher(data, starts, ends), first_words

    def select(self, words: np.ndarray, first_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places that any window within one text keeps, each once, and their gram hashes.

        A window's place depends on its own words only, so equal windows keep the same one.
        """
        if len(words) < self.window:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        hashes = gram_hashes(words, self.gram)
        places = _last_least(hashes, self.window - self.gram + 1)
        starts = np.arange(len(places))
        ends = first_words[np.searchsorted(first_words, starts, side="right")]
        places = np.unique(places[ends - starts >= self.window])
        return places, hashes[places]

    @staticmethod
    def short(words: np.ndarray, length: int) -> np.ndarray:
        """An item shorter than a window is one fingerprint, which names its length."""
        return mix(gram_hashes(words, length) + np.uint64(length))

    def around(
        self, words: np.ndarray, first_words: np.ndarray, places: np.ndarray, length: int
    ) -> tuple[pa.Array, pa.Array]:
        """Hashes of the words before each place, nearest first, and from it on.

        They reach as far as a window around the place can, within its text.
        """
        row = np.searchsorted(first_words, places, side="right") - 1
        before = self.window - self.gram if length == self.window else 0
        sides = (
            (np.minimum(before, places - first_words[row]), places - 1, -1),
            (np.minimum(length, first_words[row + 1] - places), places, 1),
        )
        lists = []
        for counts, first, step in sides:
            ends = np.concatenate([[0], np.cumsum(counts)])
            within = np.arange(ends[-1]) - np.repeat(ends[:-1], counts)
            own = words[np.repeat(first, counts) + step * within]
            lists.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), _signed(own)))
        return lists[0], lists[1]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _filter_places(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (prints & mask).astype(np.int64), ((prints >> np.uint64(32)) & mask).astype(np.int64)


def benchmark_prints(
    benchmark: DataFrame,
    id_col: str = "item_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """Fingerprints of every item: ``item``, ``length`` of the window, ``print``, the words
    ``left`` and ``right`` of its place, and its places in the filter."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Winnower(window, gram)
        for batch in batches:
            for first, _, data, offsets in utf8_pieces(batch.column(1)):
                words, first_words = of.words(data, offsets)
                found = [(window, *of.select(words, first_words))]
                counts = np.diff(first_words)
                for length in np.unique(counts[(counts > 0) & (counts < window)]).tolist():
                    places = first_words[:-1][counts == length]
                    found.append((length, places, of.short(words, length)[places]))
                for length, places, prints in found:
                    row = np.searchsorted(first_words, places, side="right") - 1
                    left, right = of.around(words, first_words, places, length)
                    one, two = _filter_places(prints, bits)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(first + row)),
                            pa.array(np.full(len(places), length, dtype=np.int32)),
                            _signed(prints),
                            left,
                            right,
                            pa.array(one),
                            pa.array(two),
                        ],
                        names=["item", "length", "print", "left", "right", "one", "two"],
                    )

    items = benchmark.select(
        F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text")
    )
    return items.mapInArrow(
        hashed,
        "item string, length int, print bigint, left array<bigint>, right array<bigint>, "
        "one bigint, two bigint",
    )


def _packed_filter(prints: DataFrame, bits: int) -> tuple[np.ndarray, list[int]]:
    """The bit filter over all fingerprints, and the lengths of windows.

    Spark gathers the bits by 64; at most bits / 64 rows come to the driver.
    """
    places = prints.select(F.explode(F.array("one", "two")).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    rows = (
        places.groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toPandas()
    )
    packed = np.zeros(bits // 64, dtype=np.uint64)
    if len(rows):
        packed[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    lengths = prints.agg(F.collect_set("length")).first()[0] or []
    return packed, sorted(lengths)


def _document_prints(
    packed: np.ndarray, lengths: list[int], window: int, gram: int, bits: int
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document: its words, and the fingerprints that pass the filter."""

    def passes(prints: np.ndarray) -> np.ndarray:
        found = np.ones(len(prints), dtype=bool)
        for place in _filter_places(prints, bits):
            found &= (packed[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
        return found

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Winnower(window, gram)
        for batch in batches:
            for first, last, data, offsets in utf8_pieces(batch.column(0)):
                words, first_words = of.words(data, offsets)
                starts, sizes, prints, lefts, rights = [], [], [], [], []
                for length in lengths:
                    if length == window:
                        at, own = of.select(words, first_words)
                    else:
                        own = of.short(words, length)
                        at = np.arange(len(own))
                        text = np.searchsorted(first_words, at, side="right")
                        at = at[first_words[text] - at >= length]
                        own = own[at]
                    passed = passes(own)
                    at, own = at[passed], own[passed]
                    left, right = of.around(words, first_words, at, length)
                    starts.append(at)
                    sizes.append(np.full(len(at), length, np.int32))
                    prints.append(own)
                    lefts.append(left)
                    rights.append(right)
                at = np.concatenate([np.zeros(0, np.int64), *starts])
                order = np.argsort(at, kind="stable")
                at = at[order]
                row = np.searchsorted(first_words, at, side="right") - 1
                ends = np.searchsorted(row, np.arange(last - first + 1))
                none = pa.array([], pa.list_(pa.int64()))
                found = pa.StructArray.from_arrays(
                    [
                        pa.array((at - first_words[row]).astype(np.int32)),
                        pa.array(np.concatenate([np.zeros(0, np.int32), *sizes])[order]),
                        _signed(np.concatenate([np.zeros(0, np.uint64), *prints])[order]),
                        pa.concat_arrays([none, *lefts]).take(pa.array(order)),
                        pa.concat_arrays([none, *rights]).take(pa.array(order)),
                    ],
                    names=["start", "length", "print", "left", "right"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.diff(first_words).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), found),
                        *[c.slice(first, last - first) for c in batch.columns[1:]],
                    ],
                    names=["n_words", "prints", *batch.schema.names[1:]],
                )

    return hashed


def _in_common(one: str, two: str) -> Column:
    """How many words two lists begin with alike; null where one is null."""
    alike = F.zip_with(one, two, lambda x, y: x.eqNullSafe(y))
    differs = F.array_position(alike, False)
    return F.when(differs == 0, F.size(alike)).when(differs > 0, (differs - 1).cast("int"))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    hits_in: int = 20,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """Words of each document that lie in a window of a benchmark item.

    Words are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters. A window
    is ``window`` consecutive words of an item, or the whole of a shorter one. Winnowing
    selects in each window the place of the least hash of its ``gram``-word grams, the
    same wherever the window stands, so every shared span of ``window`` words has a
    selected place in common. Selected places of documents and benchmark join on the
    gram's hash alone; from there the match is extended word by word to both sides, as
    far as a window around the place reaches, and counts if it is as long as a window.
    The spans so found cover all words of shared windows and no others. The documents'
    side is first held against a bit filter of fixed size made from all benchmark
    fingerprints, so only places that may match are shuffled, and texts never are.

    Returns a row per row of ``docs``: ``_id``, ``_text_hash``, ``n_words``, ``n_hit``,
    ``n_items``, ``items`` (ids as sorted strings) and ``contaminated`` (``hits_in`` *
    n_hit >= n_words and n_hit > 0). Null or empty text has no words and is clean.
    Items without words have no windows, repeated items count once, a null item id is
    left out of ``items``. Empty tables give no rows, or clean ones. A very long text is
    hashed as a whole: its task holds some dozens of bytes for each of its words.
    """
    # Items are gathered once per fingerprint and words around it; what goes on to the
    # documents is the name of that set of items, not the set.
    key = ["print", "length", "left", "right", "one", "two"]
    places = cut(
        benchmark_prints(benchmark, item_id_col, item_text_col, window, gram, bits)
        .groupBy(F.struct(*key).alias("_key"))
        .agg(F.array_sort(F.collect_set("item")).alias("_items"))
        .select("_key.*", "_items", F.md5(F.to_json("_items")).alias("_set"))
    )
    packed, lengths = _packed_filter(places, bits)
    sets = places.groupBy("_set").agg(F.first("_items").alias("_items"))
    of_items = places.select(
        "print",
        F.col("length").alias("_length"),
        F.col("left").alias("_left"),
        F.col("right").alias("_right"),
        "_set",
    )
    schema = f"n_words bigint, prints {_PRINTS}, _row bigint, _text_hash bigint"
    ids = docs.schema[id_col].dataType.simpleString()
    hashed = (
        docs.select(
            F.col(f"`{text_col}`").alias("_text"),
            # Fixed by the scan's splits, so a recomputed task numbers its rows alike.
            F.monotonically_increasing_id().alias("_row"),
            F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_text_hash"),
            F.col(f"`{id_col}`").alias("_id"),
        )
        .mapInArrow(_document_prints(packed, lengths, window, gram, bits), f"{schema}, _id {ids}")
        .select("_row", "_id", "_text_hash", "n_words", F.explode_outer("prints").alias("_p"))
        # Documents without fingerprints keep one row that matches none, dealt by number.
        .select(
            "_row", "_id", "_text_hash", "n_words", "_p.*", F.coalesce("_p.print", "_row").alias("_print")
        )
        .drop("print")
        .withColumnRenamed("_print", "print")
    )
    extended = (
        hashed.join(of_items, "print", "left")
        .withColumn("_before", _in_common("left", "_left"))
        .withColumn("_behind", _in_common("right", "_right"))
    )
    shared = (F.col("length") == F.col("_length")) & (
        F.col("_before") + F.col("_behind") >= F.col("length")
    )
    match = F.struct(
        (F.col("start") - F.col("_before")).alias("_start"),
        (F.col("_before") + F.col("_behind")).alias("length"),
    )
    of_document = ["_id", "_text_hash", "n_words"]
    per_set = (
        extended.groupBy("_row")
        .agg(
            *[F.first(c).alias(c) for c in of_document],
            F.array_sort(F.collect_set(F.when(shared, match))).alias("_matches"),
            F.collect_set(F.when(shared, F.col("_set"))).alias("_sets"),
        )
        .withColumn("_set", F.explode_outer("_sets"))
        .join(sets, "_set", "left")
    )
    per_document = per_set.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in [*of_document, "_matches"]],
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("items"),
    )
    # Matches in order of start: each adds the words behind the furthest end so far.
    nothing = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "_matches",
        nothing,
        lambda so_far, x: F.struct(
            (
                so_far.hit
                + F.greatest(
                    F.lit(0),
                    x["_start"] + x.length - F.greatest(so_far.end, x["_start"]),
                )
            ).alias("hit"),
            F.greatest(so_far.end, x["_start"] + x.length).alias("end"),
        ),
        lambda so_far: so_far.hit.cast("bigint"),
    )
    return per_document.select(
        "_id", "_text_hash", "n_words", covered.alias("n_hit"), "items"
    ).select(
        "*",
        F.size("items").cast("bigint").alias("n_items"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * hits_in >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options: int | str,
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = find_contamination(docs, benchmark, id_col, text_col, **options)
    goes = found.filter("contaminated").select("_id", "_text_hash").distinct()
    packed = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_text_hash"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    kept = packed.join(goes, null_safe(packed, goes, "_id", "_text_hash"), "left_anti")
    return kept.select("_row.*")
