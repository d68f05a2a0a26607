"""Rows that every text operator must cope with, and plain versions to compare with."""

import random
import re

from pyspark.sql import types as T

BLANK = " \t\n\x0b\x0c\r"
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        *[
            T.StructField(name, T.StringType())
            for name in ("_id", "_text", "_text_hash", "_row", "n_lines", "n_words", "size", "copy")
        ],
    ]
)


def words(rng, count, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


def corpus(seed=1, count=60):
    """(doc_id, text, lang, source) with shared lines, copies, near copies and edge cases."""
    rng = random.Random(seed)
    shared = [" ".join(words(rng, 8)) for _ in range(6)]
    rows = []
    for doc_id in range(count):
        lines = [" ".join(words(rng, rng.randint(1, 30))) for _ in range(rng.randint(1, 5))]
        lines += rng.sample(shared, rng.randint(0, 3))
        rng.shuffle(lines)
        rows.append((doc_id, "\n".join(lines), rng.choice(["en", "de"]), f"src{rng.randint(0, 3)}"))
    # Near copies need many words for one to change few bits.
    base = words(rng, 3000, 3000)
    for k in range(5):
        near = list(base)
        near[k * 17] = "changed"
        rows.append((100 + k, " ".join(near), "en", "src0"))
    rows += [(200 + k, rows[3][1], "de", "src1") for k in range(4)]
    long_text = " ".join(words(rng, 60_000, 5000))
    rows += [
        (300, None, None, None),
        (301, "", "en", None),
        (302, " \t\n\r\n ", None, "src2"),
        (303, long_text, "en", "src2"),
        (None, "a null id and its own text here", "en", "src3"),
        (304, "Ümlaut ÉCOLE Straße İstanbul 日本語 текст emoji 😀😀", "de", "src3"),
        (305, "\n\n\n", "en", "src0"),
        (306, rows[3][1].upper() + "\x0b", None, "src1"),
        (307, rows[0][1], "en", "src1"),
        (307, rows[0][1], "en", "src1"),  # repeated
    ]
    return rows


def frame(spark, rows):
    full = [
        (d, t, lang, s, None if t is None else len(t), *["x"] * (len(SCHEMA) - 5))
        for d, t, lang, s in rows
    ]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def order(rows):
    return sorted(rows, key=repr)
