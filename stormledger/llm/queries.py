"""The queries of the text operators over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, lines, mixing, neardup, negatives, pii, quality, search, suffixes, toxicity, urls, warc
from .common import fold, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder, directory = warc.write_warc(spark, pages)
    return warc.lookup(pages, folder, directory)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return found.select("doc_id", "n_lines", "n_removed", kept.alias("kept_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, F.col("lang").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(table(spark, sf_dir, "documents"))

    def line(kind, span):
        return F.concat_ws(":", kind, span["start"], span["end"])

    kinds = F.array(*map(F.lit, pii.KINDS))
    base = F.transform("base", lambda b: line(kinds[b["kind"]], b))
    more = F.transform("more", lambda m: line(F.lit("other"), m))
    counts = [F.size(F.filter("base", lambda b, k=k: b["kind"] == k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, more), ",").alias("spans")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scores(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_restored")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.hard_negatives(rows, vec_id % 50 == 0)


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The host rules of the contract.
URL_RULES = (
    urls.HostRule("allow", "org", "/"),
    urls.HostRule("block", "example.org", "/es/"),
    urls.HostRule("block", "example.org", "/en/1"),
    urls.HostRule("allow", "com", "/fr/"),
    urls.HostRule("block", "com", "/de/"),
)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), URL_RULES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
