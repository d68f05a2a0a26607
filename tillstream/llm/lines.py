"""Line dedup: drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import BLANKS, lower_ascii, null_safe


def _line_keys(rows: DataFrame, min_chars: int) -> DataFrame:
    """One row per line long enough to count: its place and 128 bits of its key."""
    lines = rows.select(
        "_id", "_text_hash", F.posexplode(F.split("_text", "\n")).alias("_place", "_line")
    )
    trimmed = lines.select(
        "_id", "_text_hash", "_place", F.btrim("_line", F.lit(BLANKS)).alias("_line")
    ).filter(F.char_length("_line") >= min_chars)
    key = lower_ascii(F.col("_line"))
    return trimmed.select(
        "_id",
        "_text_hash",
        "_place",
        F.xxhash64(key).alias("_h1"),
        F.xxhash64(F.lit(1), key).alias("_h2"),
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
) -> DataFrame:
    """The documents with shared lines taken out of ``text_col``.

    A line's key is the line stripped of blanks at both ends, A-Z lower-cased. A key of
    at least ``min_chars`` code points found in ``min_docs`` documents loses all its
    lines, except in the document with the largest id that holds it.

    Lines are exploded and hashed; distinct documents are counted per hash; the places
    of dropped lines come back to their document, which is put together again by place.
    Only hashes and places are shuffled for the count; texts are shuffled once.

    All columns of ``docs`` come back, with ``n_lines`` and ``n_dropped`` (long) behind
    them; columns of those names are replaced. A null text counts as one empty line and
    stays null. Rows with the same id are one document; a null id is a document of its
    own that is smaller than all others. An empty table gives an empty table.
    """
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    original = F.struct(*[F.col(f"`{c}`") for c in kept_columns if c != text_col])
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text")
    ).withColumn("_text_hash", F.xxhash64("_text"))
    keys = _line_keys(rows, min_chars)

    # The key is grouped as a struct, so the join below deals both sides out anew and
    # adaptive execution can split a line that a third of all documents hold.
    shared = (
        keys.groupBy(F.struct("_h1", "_h2").alias("_key"))
        .agg(
            F.count_distinct(F.struct("_id")).alias("_docs"),
            F.max(F.struct("_id")).alias("_keeper"),
        )
        .filter(F.col("_docs") >= min_docs)
        .select(
            F.col("_key._h1").alias("_h1"),
            F.col("_key._h2").alias("_h2"),
            F.col("_keeper._id").alias("_keeper"),
        )
    )
    dropped = (
        keys.join(shared, ["_h1", "_h2"])
        .filter(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_id", "_text_hash")
        .agg(F.collect_set("_place").alias("_dropped"))
    )

    # Lines are split below the join, so picking by place does not split again.
    whole = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_text_hash"),
        F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "\n").alias("_lines"),
        F.col(f"`{text_col}`").isNull().alias("_absent"),
        original.alias("_row"),
    )
    joined = whole.join(dropped, null_safe(whole, dropped, "_id", "_text_hash"), "left").select(
        "_row", "_lines", "_absent", "_dropped"
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    text = (
        F.when(F.col("_absent"), F.lit(None).cast("string"))
        .when(F.col("_dropped").isNull(), F.array_join("_lines", "\n"))
        .otherwise(F.array_join(F.transform(places, lambda i: F.col("_lines")[i]), "\n"))
    )
    return joined.select(
        *[
            (text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in kept_columns
        ],
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
