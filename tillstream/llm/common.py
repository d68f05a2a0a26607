"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"

# Texts are worked on in pieces of about this many bytes, which bounds the arrays.
PIECE_BYTES = 1 << 21


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the fast built-in."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names, which all executors share.

    A folder of our own is set only where the session names none and runs in one
    process, as in tests; a cluster must name one.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not re.match(r"local($|\[)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tillstream-")
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; later reads survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def null_safe(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality on columns of both sides, where null equals null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def utf8_pieces(
    column: pa.Array, piece_bytes: int = PIECE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The bytes of a string column, a few whole texts at a time.

    Yields (first row, row after the last, bytes, offsets of the rows in them). Null
    texts have no bytes. One text is never split, so a piece is as long as the longest
    text at most, or ``piece_bytes``.
    """
    rows = len(column)
    if rows == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(data_buffer or b"", dtype=np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + piece_bytes, side="right")) - 1
        last = min(max(last, first + 1), rows)
        low, high = offsets[first], offsets[last]
        yield first, last, data[low:high], offsets[first : last + 1] - low
        first = last


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that each input bit affects all output bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(max(count, 1), base % (1 << 64), dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class WordHasher:
    """64-bit hashes of byte ranges, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self) -> None:
        self._forward = self._backward = np.ones(1, dtype=np.uint64)

    def _grow(self, count: int) -> None:
        if len(self._forward) < count:
            count = 1 << (count - 1).bit_length()
            self._forward = _powers(BASE, count)
            self._backward = _powers(pow(BASE, -1, 1 << 64), count)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[data] * self._forward[: len(data)], out=sums[1:])
        words = (sums[ends] - sums[starts]) * self._backward[starts]
        return mix(words + (ends - starts).astype(np.uint64))


def word_spans(
    member: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as runs of member bytes, never across texts.

    Returns starts, ends and, per text, the index of its first word (one more at the end).
    """
    size = len(member)
    edge = np.zeros(size + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(size + 1, dtype=bool)
    before[1:] = member
    here = np.zeros(size + 1, dtype=bool)
    here[:size] = member
    starts = np.flatnonzero(here & (~before | edge))
    ends = np.flatnonzero(before & (~here | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words, by its first word's position."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(length):
        total = total * np.uint64(BASE) + words[k : k + count]
    return mix(total + np.uint64(length))
