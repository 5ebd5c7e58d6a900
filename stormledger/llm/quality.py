"""Quality rules whose cutoffs are risk-controlled on labelled documents.

Four base counts are taken from each text, and from them ratios that grow as a text gets worse. For each
stratum and ratio the strictest cutoff is chosen that provably rejects few good documents: going from
lenient to strict cutoffs, the hypothesis "more than the allowed share of good documents is rejected" is
tested with the exact binomial distribution on the labelled ones, and the walk stops at the first cutoff
where it cannot be dismissed. Walking a fixed order needs no correction for the number of cutoffs; the
number of strata and ratios is corrected for by splitting the error level among them (Bonferroni), and
the allowed share is split among the ratios, so that all rules together respect it.

Everything is DataFrame expressions; no text is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_CLASS, BLANKS, words

SYMBOLS = "#*$%&|<>"
# Ratio: numerator, denominator. All grow with the share of junk.
RATIOS = {
    "symbol_ratio": ("n_symbols", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
}
# Cutoffs tried, strict to lenient: i / step for i = 1 .. last.
GRIDS = {"symbol_ratio": (100, 400), "dup_line_ratio": (100, 100), "repeat_ratio": (100, 100), "word_length": (2, 100)}
# Low bits of a packed window number; a text of 2^28 words is beyond Spark's limit for a string in one row.
PLACE_BITS = 28


@dataclass(frozen=True)
class Risk:
    """At most `share` of the good documents of any stratum is rejected, with probability 1 - `error`."""

    share: float = 0.04
    error: float = 0.05


def _repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are first packed as (hash, place) numbers and sorted, so equal windows become neighbours.
    Only the places found that way are compared once more by a full hash, since the packed one is short.
    The windows are then counted from left to right: each adds the words the one before has not covered.
    """
    mask = (1 << PLACE_BITS) - 1
    places = F.sequence(F.lit(0), F.size(w) - 3)

    def window(j: Column) -> Column:
        return F.xxhash64(w[j], w[j + 1], w[j + 2])

    packed = F.array_sort(
        F.transform(places, lambda j: window(j).bitwiseAND(F.lit(~mask)).bitwiseOR(j.cast("long")))
    )

    def neighbours(ordered: Column, same) -> Column:
        """The items of an ordered array that are the same as the item before or after."""
        return F.filter(
            ordered,
            lambda x, i: ((i > 0) & same(x, ordered[F.greatest(i - 1, F.lit(0))]))
            | ((i < F.size(ordered) - 1) & same(x, ordered[F.least(i + 1, F.size(ordered) - 1)])),
        )

    def short_same(a: Column, b: Column) -> Column:
        return a.bitwiseAND(F.lit(~mask)) == b.bitwiseAND(F.lit(~mask))

    def full(candidates: Column) -> Column:
        exact = F.array_sort(
            F.transform(
                candidates,
                lambda p: F.struct(
                    window(p.bitwiseAND(F.lit(mask)).cast("int")).alias("h"), p.bitwiseAND(F.lit(mask)).cast("int").alias("j")
                ),
            )
        )
        return _let(exact, lambda e: neighbours(e, lambda a, b: a["h"] == b["h"]))

    def covered(found: Column) -> Column:
        starts = F.array_sort(F.transform(found, lambda x: x["j"]))
        return _let(
            starts,
            lambda s: F.aggregate(
                s,
                F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                lambda acc, j: F.struct(
                    (acc["n"] + F.least(F.lit(3), j - acc["last"])).alias("n"), j.alias("last")
                ),
                lambda acc: acc["n"].cast("long"),
            ),
        )

    repeated = _let(packed, lambda p: neighbours(p, short_same))
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(
        _let(repeated, lambda r: F.when(F.size(r) == 0, F.lit(0).cast("long")).otherwise(covered(full(r))))
    )


def _let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once: a one-element array holds it."""
    return F.transform(F.array(value), body)[0]


def base_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, counts, base_failed), one row per input row; all counts are 0 for a null or empty text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    counted = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), text.alias("t"), words(text).alias("w"), lines.alias("l")
    ).select(
        "doc_id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", f"{BLANK_CLASS}+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size("l").cast("long").alias("n_lines"),
        _repeat_words(F.col("w")).alias("n_repeat_words"),
    )
    few = F.col("n_words") < 50
    return counted.withColumn("base_failed", few | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


def allowed_rejections(n: Column, share: float, error: Column) -> Column:
    """The largest k with P(Binomial(n, share) <= k) <= error, or -1: so few rejections dismiss a risk over `share`.

    The distribution is summed upwards from 0 as logarithms, one term from the one before, until it
    passes `error`, so that many labels neither underflow nor need a table.
    """
    from math import log

    odds = log(share) - log(1 - share)
    start = F.struct(
        (n * F.lit(log(1 - share))).alias("term"), (n * F.lit(log(1 - share))).alias("sum"), F.lit(-1).cast("long").alias("k")
    )

    def step(acc: Column, i: Column) -> Column:
        # acc.sum holds log P(X <= i); it is accepted as k = i if still within the error.
        fits = (acc["sum"] <= F.log(error)) & (acc["k"] == i - 1)
        term = acc["term"] + F.log((n - i) / (i + 1)) + F.lit(odds)
        top = F.greatest(acc["sum"], term)
        total = top + F.log(F.exp(acc["sum"] - top) + F.exp(term - top))
        return F.struct(
            F.when(fits, term).otherwise(acc["term"]).alias("term"),
            F.when(fits, total).otherwise(acc["sum"]).alias("sum"),
            F.when(fits, i).otherwise(acc["k"]).alias("k"),
        )

    # Above the mean the distribution exceeds one half, so no k beyond it can fit.
    steps = F.sequence(F.lit(0).cast("long"), F.floor(n * F.lit(share)).cast("long"))
    return F.when(n > 0, F.aggregate(steps, start, step, lambda acc: acc["k"])).otherwise(F.lit(-1).cast("long"))


def cutoffs(counts: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """(stratum, ratio, n_good, allowed, cutoff): documents above the cutoff are rejected; null rejects none.

    Good documents are those labelled quality 1 which pass the base rules; a document labelled twice
    counts once and is good only if every label says so. The stratum is the language; a null language is
    a stratum of its own. A stratum with too few labels for any guarantee has null cutoffs.
    """
    good = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
    )
    once = counts.dropDuplicates(["doc_id"])
    held = once.where(~F.col("base_failed")).join(good.select("doc_id"), "doc_id", "left_semi")
    ratios = F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), _ratio(r).alias("value")) for r in RATIOS]))
    rows = held.select(F.coalesce("lang", F.lit("")).alias("stratum"), ratios.alias("r")).select("stratum", "r.*")
    # The strictest grid point a document still passes; the last one for values beyond the grid plus one.
    step = F.create_map(*[F.lit(x) for r, (s, _) in GRIDS.items() for x in (r, s)])
    last = F.create_map(*[F.lit(x) for r, (_, n) in GRIDS.items() for x in (r, n)])
    point = F.least(F.greatest(F.ceil(F.col("value") * step[F.col("ratio")]), F.lit(1)), last[F.col("ratio")] + 1)
    histogram = rows.groupBy("stratum", "ratio", point.cast("long").alias("point")).agg(F.count(F.lit(1)).alias("n"))
    # A stratum has at most as many rows here as the grids have points, whatever the number of labels.
    per_stratum = histogram.groupBy("stratum", "ratio").agg(
        F.sum("n").alias("n_good"), F.collect_list(F.struct("point", "n")).alias("points")
    )
    tests = max(1, histogram.select("stratum", "ratio").distinct().count())
    each = per_stratum.withColumn("error", F.lit(risk.error / tests))
    allowed = each.withColumn("allowed", allowed_rejections(F.col("n_good"), risk.share / len(RATIOS), F.col("error")))
    # Rejected at cutoff g: documents whose strictest point is above g. Rejections grow as g falls, so the
    # walk from lenient to strict stops at the smallest g that still fits.
    return allowed.select(
        "stratum",
        "ratio",
        "n_good",
        "allowed",
        F.aggregate(
            F.sequence(F.lit(1).cast("long"), last[F.col("ratio")].cast("long")),
            F.lit(None).cast("long"),
            lambda best, g: F.coalesce(
                best,
                F.when(
                    F.aggregate(
                        F.col("points"), F.lit(0).cast("long"), lambda a, p: a + F.when(p["point"] > g, p["n"]).otherwise(0)
                    )
                    <= F.col("allowed"),
                    g,
                ),
            ),
            lambda g: g / step[F.col("ratio")],
        ).alias("cutoff"),
    )


def apply_rules(counts: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add `kept`: passes the base rules and no ratio exceeds the cutoff of the document's stratum."""
    # One row per language: small, yet joined as its size says.
    wide = cuts.groupBy("stratum").pivot("ratio", list(RATIOS)).agg(F.first("cutoff"))
    joined = counts.withColumn("stratum", F.coalesce("lang", F.lit(""))).join(wide, "stratum", "left")
    passes = ~F.col("base_failed")
    for name in RATIOS:
        step = GRIDS[name][0]
        above = F.ceil((_ratio(name)) * F.lit(step)) / F.lit(step) > F.col(name)
        passes = passes & ~F.coalesce(above, F.lit(False))
    return joined.withColumn("kept", passes).drop("stratum", *RATIOS)


def quality_rules(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Counts, `base_failed` and `kept` of each document, one row per input row.

    A null or empty text has zero counts and fails the base rules. Ties with a cutoff pass. Without any
    labels only the base rules decide. Repeated rows are judged alike; other columns are ignored. The
    texts are read once: the counts, a few numbers per document, are stored and used for both steps.
    """
    from stormledger.storage import stored

    counts = stored(base_counts(docs), "quality")
    return apply_rules(counts, cutoffs(counts, labels, risk))
