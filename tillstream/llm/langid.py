"""Language identification by sparse logistic regression on character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.common import utf8_pieces

NO_LANGUAGE = "und"
ORDERS = (1, 2, 3)  # characters of an n-gram
BUCKETS = 1 << 16  # n-grams are hashed to so many features
# The classifier is fitted on a sample dealt evenly over all languages: so many documents,
# or so many of each language where there are very many.
MOST_DOCS, DOCS_PER_LANGUAGE = 2400, 12
EPOCHS = 4
SCALE = 10.0  # brings feature vectors near unit length

_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@cache
def _letters() -> np.ndarray:
    """Each code point's lower-case letter, or 32 for all that is no letter."""
    folded = np.full(0x110000, 32, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            small = char.lower()
            folded[code] = ord(small) if len(small) == 1 else code
    return folded


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of some texts, and where each text begins in them."""
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    firsts = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=firsts[1:])
    return _letters()[codes], firsts[offsets]


def _grams(chars: np.ndarray, order: int) -> np.ndarray:
    """Feature of the n-gram that begins at each character."""
    count = len(chars) - order + 1
    total = np.full(max(count, 0), order, dtype=np.uint32)
    for k in range(order):
        total = (total ^ chars[k : k + count]) * _MULTIPLIERS[k]
    return (total ^ (total >> np.uint32(15))) & np.uint32(BUCKETS - 1)


def _documents(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Pieces of a text column: first row, text bounds, characters, n-grams by order."""
    for first, _, data, offsets in utf8_pieces(column, 1 << 20):
        chars, bounds = _characters(data, offsets)
        yield first, bounds, chars, [_grams(chars, order) for order in ORDERS]


def _own_grams(grams: list[np.ndarray], low: int, high: int) -> np.ndarray:
    """All n-grams within one text."""
    return np.concatenate(
        [g[low : max(low, high - n + 1)] for n, g in zip(ORDERS, grams, strict=True)]
    )


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Texts that hold each feature, and texts, over all rows of the one column.

    Tasks count over their texts, so the driver gets ``BUCKETS`` sums whatever the input.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts_seen = np.zeros(BUCKETS, dtype=np.int64), 0
        seen = np.zeros(BUCKETS, dtype=bool)
        for batch in batches:
            for _, bounds, _, grams in _documents(batch.column(0)):
                for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                    seen[:] = False
                    seen[_own_grams(grams, low, high)] = True
                    held += seen
            texts_seen += batch.num_rows
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(at, -1).astype(np.int32)),
                pa.array(np.append(held[at], texts_seen)),
            ],
            names=["bucket", "texts"],
        )

    sums = (
        texts.mapInArrow(counted, "bucket int, texts bigint")
        .groupBy("bucket")
        .agg(F.sum("texts").alias("texts"))
        .toPandas()
    )
    held = np.zeros(BUCKETS + 1, dtype=np.int64)
    held[sums["bucket"].to_numpy(np.int64)] = sums["texts"].to_numpy(np.int64)
    return held[:BUCKETS], int(held[BUCKETS])


def _sample(labelled: DataFrame, languages: dict[str, int], most_docs: int) -> list:
    """Feature counts of a bounded sample, the same number from each language.

    Documents are taken by a hash of id and text, so a rerun takes the same, and many
    copies of one text count as any other documents do.
    """
    each = max(8, most_docs // max(len(languages), 1))
    place = F.pmod(F.xxhash64(F.lit(7), "_id", "text"), F.lit(1 << 30))
    shares = []
    for language, count in languages.items():
        shares += [F.lit(language), F.lit(int(min(1.0, 1.2 * each / count) * (1 << 30)))]
    share = F.try_element_at(F.create_map(*shares), F.col("lang"))

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, counts = [], []
            for _, bounds, _, grams in _documents(batch.column(2)):
                for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                    at, n = np.unique(_own_grams(grams, low, high), return_counts=True)
                    buckets.append(at.astype(np.int32))
                    counts.append(n.astype(np.int32))
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (buckets, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *lists], names=["place", "lang", "at", "n"]
            )

    rows = (
        labelled.select(place.alias("place"), "lang", "text")
        .filter(F.col("place") < share)
        .mapInArrow(counted, "place bigint, lang string, at array<int>, n array<int>")
        .orderBy("place", "lang", F.size("at"))
        .limit(2 * most_docs + 8 * len(languages))
        .toArrow()
    )
    at, n = rows.column("at"), rows.column("n")
    return [
        (place, lang, np.asarray(at[k].values), np.asarray(n[k].values))
        for k, (place, lang) in enumerate(
            zip(rows.column("place").to_pylist(), rows.column("lang").to_pylist(), strict=True)
        )
    ]


def _softmax(logits: np.ndarray) -> np.ndarray:
    top = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return top / top.sum(axis=-1, keepdims=True)


def _train(
    rows: list,
    languages: list[str],
    idf: np.ndarray,
    l1: float = 0.02,
    l2: float = 0.02,
    alpha: float = 0.5,
    beta: float = 1.0,
) -> tuple[np.ndarray, float]:
    """Weights by follow-the-regularised-leader, and a temperature.

    Elastic net: a weight stays zero until its gradients outweigh ``l1``, and ``l2``
    shrinks it. A quarter of the sample is held back and sets the temperature that
    makes the scores of unseen texts most likely.
    """
    code = {lang: k for k, lang in enumerate(languages)}
    vectors = [
        (place % 4 == 3, code[lang], at, SCALE * n / max(n.sum(), 1) * idf[at])
        for place, lang, at, n in rows
        if len(at)
    ]
    z = np.zeros((BUCKETS, len(languages)))
    squares = np.zeros_like(z)

    def weights(at: np.ndarray) -> np.ndarray:
        rate = (beta + np.sqrt(squares[at])) / alpha + l2
        return -np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0) / rate

    for _ in range(EPOCHS):
        for held_back, label, at, x in vectors:
            if held_back:
                continue
            own = weights(at)
            miss = _softmax(x @ own)
            miss[label] -= 1
            slope = np.outer(x, miss)
            step = (np.sqrt(squares[at] + slope**2) - np.sqrt(squares[at])) / alpha
            z[at] += slope - step * own
            squares[at] += slope**2
    final = weights(np.arange(BUCKETS))
    held = [(label, x @ final[at]) for back, label, at, x in vectors if back]
    if not held:
        return final, 1.0
    labels, logits = np.array([h[0] for h in held]), np.array([h[1] for h in held])
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    # A pinch of smoothing: a sample without errors would ask for boundless certainty.
    likely = [
        np.log(0.999 * _softmax(logits / t)[np.arange(len(labels)), labels] + 0.001 / len(languages)).mean()
        for t in grid
    ]
    return final, float(grid[int(np.argmax(likely))])


def _mean(table: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Mean of the table's rows over the n-grams of a text."""
    if len(grams) > BUCKETS:
        sums = np.bincount(grams, minlength=BUCKETS).astype(np.float32) @ table
    else:
        sums = np.ones(len(grams), dtype=np.float32) @ table[grams]
    return sums.astype(np.float64) / len(grams)


def is_held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most_docs: int = MOST_DOCS,
    docs_per_language: int = DOCS_PER_LANGUAGE,
) -> DataFrame:
    """Predicted language of each text.

    Features are hashed n-grams of one to three characters, letters lower-cased and all
    else as blanks, by share of the text times inverse document frequency. The latter
    counts all documents that may be learned from: those with a language and a text that
    ``is_held_out`` leaves. Every language is learned. The classifier is fitted on at most
    ``most_docs`` of them, evenly by language, or ``docs_per_language`` of each where that
    is more. It takes 1.3 MB for each language on the driver, and 0.3 MB in a task.

    Returns a row per row of ``docs``: ``_id``, ``_text_hash``, ``held_out``,
    ``lang_pred``, ``score`` (probability, 0 to 1) and ``has_letter``. A null text or one
    without a letter is ``und`` with score 0, as is all where there is nothing to learn
    from. Texts are
    used whole; language and id are no input of a prediction. All columns of ``docs``
    come along as the struct ``_row``.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        is_held_out(F.col(f"`{id_col}`")).alias("held_out"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_rest"),
    )
    labelled = rows.filter("not held_out and lang is not null and text is not null")
    # One row per language.
    frequent = labelled.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in frequent)
    if languages:
        held, texts = document_frequencies(labelled.select("text"))
        idf = np.log((1 + texts) / (1 + held)) + 1
        wanted = max(most_docs, docs_per_language * len(languages))
        sample = _sample(labelled, {r["lang"]: r["count"] for r in frequent}, wanted)
        trained, temperature = _train(sample, languages, idf)
        # Scale, frequency and temperature are folded in: a text's logits are the mean
        # of these over its n-grams.
        table = (trained * (SCALE / temperature) * idf[:, None]).astype(np.float32)
    else:
        table = np.zeros((BUCKETS, 0), dtype=np.float32)
    names = pa.array([*languages, NO_LANGUAGE], pa.string())

    def predicted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = np.full(batch.num_rows, len(languages), dtype=np.int32)
            score = np.zeros(batch.num_rows)
            lettered = np.zeros(batch.num_rows, dtype=bool)
            for first, bounds, chars, grams in _documents(batch.column(0)):
                letters = np.zeros(len(chars) + 1, dtype=np.int64)
                np.cumsum(chars != 32, out=letters[1:])
                for row, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    lettered[first + row] = letters[high] > letters[low]
                    if languages and lettered[first + row]:
                        share = _softmax(_mean(table, _own_grams(grams, low, high)))
                        best[first + row] = share.argmax()
                        score[first + row] = share.max()
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(best)), pa.array(score), pa.array(lettered), *batch.columns],
                names=["lang_pred", "score", "has_letter", *batch.schema.names],
            )

    carried = {f.name: f.dataType for f in rows.schema.fields if f.name not in ("text", "lang")}
    schema = T.StructType(
        [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("has_letter", T.BooleanType()),
            T.StructField("text", T.StringType()),
            *[T.StructField(name, kind) for name, kind in carried.items()],
        ]
    )
    row = F.struct(
        *[
            (F.col("text") if c == text_col else F.col(f"_rest.`{c}`")).alias(c)
            for c in docs.columns
        ]
    )
    return (
        rows.select("text", *carried)
        .mapInArrow(predicted, schema)
        .select(
            "_id",
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_hash"),
            "held_out",
            "lang_pred",
            "score",
            "has_letter",
            row.alias("_row"),
        )
    )


def keep_identified(docs: DataFrame, text_col: str = "text", **columns: str) -> DataFrame:
    """The documents whose text has a letter, however sure the language; others are ``und``."""
    return identify_languages(docs, text_col=text_col, **columns).filter("has_letter").select("_row.*")
