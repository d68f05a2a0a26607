"""From raw documents to a training mixture, stage by stage.

Each stage takes the documents its predecessor kept and applies one operator to all of
them. Stages are written as Parquet to the shared folder and read again, so a lost
executor costs work of one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import contamination, langid, lines, mixture, simhash
from tillstream.llm.common import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter in their text, however sure their language; others go."""
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others share; ``n_chars`` is kept up."""
    deduped = lines.dedup_lines(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return deduped
    kind = docs.schema["n_chars"].dataType
    return deduped.withColumn("n_chars", F.char_length("text").cast(kind))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, with their source's target."""
    return mixture.take_mixture(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix),
]

# Learned languages, XXH64 fingerprints and hashed chances have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
