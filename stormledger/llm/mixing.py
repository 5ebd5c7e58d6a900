"""Mixing sources to target weights by iterative proportional fitting.

Words are counted per cell of source, language and topic. The cells' weights are raked: in turn for each
of the three, they are scaled so that every value gets its target share, and again until all hold. A
document is then sampled with the probability its cell's weight calls for, decided by a hash of its id.
Everything is DataFrame expressions. Only cells, which are sums, take part in the iteration.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.storage import stored

from .common import numbered, words

MARGINS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Settings:
    # A value's target share grows as its share of words to this power: 1 keeps the mix, 0 makes all equal.
    source_power: float = 0.5
    lang_power: float = 0.7
    topic_power: float = 0.7
    rounds: int = 8
    # Part of all words to sample.
    share: float = 0.6
    # Steps of scaling the sample to that part, as cells cannot give more words than they have.
    scalings: int = 12
    seed: int = 7

    def power(self, margin: str) -> float:
        return getattr(self, f"{margin}_power")


def topic_of(text: Column, n_words: Column) -> Column:
    """The form a text has: a table, a list of short lines, or prose."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return F.when(bars * 20 > n_words, "table").when(breaks * 10 > n_words, "list").otherwise("prose")


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, n_words); a null source or language is the value ''."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("source", "lang")],
        text.alias("t"),
        F.size(words(F.col("text").cast("string"))).cast("long").alias("n_words"),
    )
    return made.select("doc_id", "source", "lang", topic_of(F.col("t"), F.col("n_words")).alias("topic"), "n_words")


def raked(cells: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Add `weight`: words of each cell (source, lang, topic, n_words) under the target shares, summing to all words."""
    total = cells.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    targets = {}
    for margin in MARGINS:
        sums = cells.groupBy(margin).agg(F.pow(F.sum("n_words"), F.lit(cfg.power(margin))).alias("part")).where("part > 0")
        all_parts = sums.agg(F.coalesce(F.sum("part"), F.lit(1.0))).first()[0]
        targets[margin] = stored(sums.select(margin, (F.col("part") / all_parts * total).alias("target")), f"target_{margin}")
    weights = cells.withColumn("weight", F.col("n_words").cast("double"))
    for _ in range(cfg.rounds):
        for margin in MARGINS:
            now = weights.groupBy(margin).agg(F.sum("weight").alias("now")).join(targets[margin], margin)
            factor = now.where("now > 0").select(margin, (F.col("target") / F.col("now")).alias("factor"))
            scaled = weights.join(factor, margin, "left")
            weights = scaled.withColumn("weight", F.col("weight") * F.coalesce("factor", F.lit(1.0))).drop("factor")
        # One file per round keeps the plan short; it holds cells only.
        weights = stored(weights.select(*MARGINS, "n_words", "weight"), "weights")
    return weights


def probabilities(weights: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Add `probability`, so that the expected sample has the wanted words in proportion to the weights.

    A cell gives all its words at most; the others are scaled up until the sum is right.
    """
    wanted = weights.agg(F.coalesce(F.sum("n_words"), F.lit(0)) * F.lit(cfg.share)).first()[0]
    scale = float(cfg.share)
    for _ in range(cfg.scalings):
        given = weights.agg(F.sum(F.least(F.col("n_words").cast("double"), F.lit(scale) * F.col("weight")))).first()[0]
        scale = scale * wanted / given if given else scale
    chance = F.when(F.col("n_words") > 0, F.least(F.lit(1.0), F.lit(scale) * F.col("weight") / F.col("n_words"))).otherwise(F.lit(1.0))
    # Sums of doubles depend on their order in the last digits.
    return weights.withColumn("probability", F.round(chance, 9))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on the id and seed only."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mixed(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, source, lang, topic, n_words, probability, kept), one row per input row.

    A null or empty text has no words and shares the probability of its cell; a cell without words has
    probability 1. Rows that repeat an id are kept or not together if their cells have one probability.
    An empty table gives an empty result. Other columns are ignored.
    """
    rows = stored(measured(docs), "measured")
    cells = stored(rows.groupBy(*MARGINS).agg(F.sum("n_words").alias("n_words")), "cells")
    chances = stored(probabilities(raked(cells, cfg), cfg).select(*MARGINS, "probability"), "chances")
    # A source may hold a third of all rows: the small side is broadcast while its size allows, else
    # adaptive execution splits the large partition.
    joined = rows.join(chances, list(MARGINS))
    return joined.withColumn("kept", uniform(F.col("doc_id"), cfg.seed) < F.col("probability")).select(
        "doc_id", *MARGINS, "n_words", "probability", "kept"
    )


def sampled(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The sampled documents with all their columns.

    The cell is found anew from each row, so no join by id is needed and repeated ids do no harm.
    """
    rows, col = numbered(docs)
    own = measured(rows.select(*[col[c].alias(c) for c in ("doc_id", "source", "lang", "text")]))
    cells = stored(own.groupBy(*MARGINS).agg(F.sum("n_words").alias("n_words")), "cells")
    chances = stored(probabilities(raked(cells, cfg), cfg).select(*[F.col(m).alias(f"cell_{m}") for m in MARGINS], "probability"), "chances")
    text = col["text"].cast("string")
    own = rows.select(
        "*",
        *[F.coalesce(col[c].cast("string"), F.lit("")).alias(f"cell_{c}") for c in ("source", "lang")],
        topic_of(F.coalesce(text, F.lit("")), F.size(words(text)).cast("long")).alias("cell_topic"),
    )
    kept = own.join(chances, [f"cell_{m}" for m in MARGINS]).where(uniform(col["doc_id"].cast("long"), cfg.seed) < F.col("probability"))
    return kept.select(*rows.columns).toDF(*docs.columns)
