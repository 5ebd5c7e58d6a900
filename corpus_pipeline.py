"""The corpus pipeline: language ID, line dedup, near dedup, decontamination, mixing to target weights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.llm import decontaminate, language, lines, mixing, neardup
from stormledger.llm.common import table
from stormledger.storage import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what is not written in any of the languages learned from the documents' own labels."""
    return language.kept_languages(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the earliest of equal or nearly equal lines; documents whose every line stands elsewhere go."""
    changed = lines.deduplicated(docs, emptied=False)
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group."""
    return neardup.deduplicated(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item, verbatim or with other values in its slots."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that words of sources, languages and topics approach their target shares."""
    return mixing.sampled(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

# Language profiles and templates have no SQL form; a test compares the whole with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written once and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
