"""Finding the few rows of a large table that a small one is about."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of 64 bits of an id filter: 8 MB at most, enough for some six million ids at
# which three in a hundred others pass. A filter of more ids lets more pass.
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 20
_WORDS_PER_ID = 8


def filter_words(ids: int) -> int:
    """How many words a filter of so many ids has."""
    wanted = 1 << max(ids // _WORDS_PER_ID, 1).bit_length()
    return min(max(wanted, LEAST_WORDS), MOST_WORDS)


def _places(key: str | Column, words: int) -> list[Column]:
    hashed = F.xxhash64(key)
    return [F.pmod(h, F.lit(64 * words).cast("bigint")) for h in (hashed, F.shiftright(hashed, 32))]


def id_filter(ids: DataFrame, key: str, words: int) -> DataFrame:
    """One row with a Bloom filter over ``key`` as an array of ``words`` numbers.

    Tasks set the bits of their ids by word; only words are shuffled.
    """
    place = F.explode(F.array(*_places(key, words))).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    held = ids.select(place).groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits"))
    # As many rows as the filter has words, whatever the number of ids.
    every = ids.sparkSession.range(words).join(held, F.col("id") == F.col("at"), "left")
    word = F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    return every.agg(
        F.transform(F.array_sort(F.collect_list(word)), lambda w: w["bits"]).alias("words")
    )


def likely_in(table: DataFrame, ids: DataFrame, key: str, count: int) -> DataFrame:
    """Rows whose ``key`` is among the ids, and a few others.

    Held against a filter of the ids while the table is read, so that what is certainly
    not among them is never shuffled.
    """
    words = filter_words(count)
    found = id_filter(ids, key, words).scalar()
    passes = F.lit(True)
    for place in _places(key, words):
        word = F.get(found, F.shiftright(place, 6).cast("int"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
        passes = passes & (word.bitwiseAND(bit) != 0)
    return table.filter(passes)


def partition_key(columns: Sequence[str]) -> Column:
    """The partition a row is in, as text that no two partitions share."""
    parts = [F.concat_ws("", F.lit("="), F.to_json(F.struct(c))) for c in columns]
    return F.concat_ws("/", *parts)


def in_partitions(table: DataFrame, partitions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table's rows in the listed partitions.

    A join on the partition columns, so Spark finds the partitions while the query runs
    and reads no others, however long the list is.
    """
    listed = partitions.select(partition_key(columns).alias("_partition")).filter(
        F.col("_partition") > ""
    )
    return table.join(listed, partition_key(columns) == F.col("_partition"), "left_semi")
