"""URL verdicts by given rules and, where none fits, by association rules mined from labelled urls.

A url becomes a set of tokens: pieces of its host, path, query and fragment. FP-growth finds the sets of
tokens that are frequent among labelled urls, with and without a label; a set whose urls mostly have one
label is a rule for that label. Rules are kept from a least support and confidence on, and go where a part
of theirs does as well. To judge urls, rules are listed under their rarest token; each distinct set of
tokens meets the rules of its own tokens only, and the most confident rule that it has whole decides.

Tokens that occur in the same labelled urls are one item when sets are mined, so a long url with many copies
does not make a set of each choice of its tokens. The rules are the same as without.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.storage import stored

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Settings:
    # Part of the labelled urls that a set of tokens with its label must have, and of its urls that have the label.
    least_support: float = 0.01
    least_confidence: float = 0.7
    # Verdict where no rule holds.
    default: str = ALLOW
    # Copies of one set of tokens that are written out together.
    copies: int = 1_000


@dataclass(frozen=True)
class HostRule:
    """A verdict for a host, its subdomains and all paths that start so."""

    verdict: str
    host: str
    path: str


def split_url(url: Column) -> dict[str, Column]:
    """host, path, query and fragment of a url; all empty for a null one or one without `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return {
        "host": F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, lower),
        "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
        "query": F.regexp_extract(rest, "^[^?#]*\\?([^#]*)", 1),
        "fragment": F.regexp_extract(rest, "^[^#]*#([\\s\\S]*)", 1),
    }


def tokens(url: dict[str, Column]) -> Column:
    """The distinct tokens of a url, sorted; of a run of digits the first is kept."""

    def pieces(part: str, separators: str) -> Column:
        found = F.filter(F.split(url[part], separators), lambda t: t != "")
        return F.transform(found, lambda t: F.concat(F.lit(f"{part[0]}:"), F.regexp_replace(t, "([0-9])[0-9]*", "$1#")))

    each = [pieces("host", "[.:@-]+"), pieces("path", "[/._-]+"), pieces("query", "&+"), pieces("fragment", "#+")]
    return F.array_sort(F.array_distinct(F.concat(*each)))


def fitting_rule(host: Column, path: Column, rules: Sequence[HostRule]) -> Column:
    """(size, rule, verdict) of the longest rule that fits, of equally long ones the last by name; null if none does."""
    each = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(len(r.host + r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    none = F.lit(None).cast("struct<size: int, rule: string, verdict: string>")
    return F.greatest(none, none, *each)


def same_items(bags: DataFrame, least: int) -> DataFrame:
    """(token, item, n): tokens in at least so many labelled urls, and the first token that is in just the same ones.

    `bags` has tokens, label and n, the number of urls of each; a set of bags is told by 128 bits.
    """
    each = bags.select(F.explode("tokens").alias("token"), F.xxhash64("tokens", "label").alias("a"), F.xxhash64(F.lit(1), "label", "tokens").alias("b"), "n")
    held = each.groupBy("token").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("n").alias("n")).where(F.col("n") >= least)
    first = held.groupBy("a", "b", "n").agg(F.min("token").alias("item"))
    return held.join(first, ["a", "b", "n"]).select("token", "item", "n")


def _as_items(bags: DataFrame, items: DataFrame, *key: str) -> DataFrame:
    """(key, items): distinct items of each bag's tokens; bags without any are left out."""
    each = bags.select(*key, F.explode("tokens").alias("token")).join(items.select("token", "item"), "token")
    return each.groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items"))


def mined(labelled: DataFrame, cfg: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Rules (items, verdict, support, confidence) from (tokens, label) rows, and the items of tokens (token, item, n)."""
    spark = labelled.sparkSession
    bags = stored(labelled.groupBy("tokens", "label").agg(F.count(F.lit(1)).alias("n")), "bags")
    total = bags.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(1, -int(-cfg.least_support * total // 1))
    items = stored(same_items(bags, least), "items")
    sets = _as_items(bags, items, "tokens", "label").join(bags, ["tokens", "label"])
    sets = sets.groupBy("items", "label").agg(F.sum("n").alias("n"))
    marked = sets.select(F.concat("items", F.array(F.concat(F.lit("="), "label"))).alias("items"), "n")
    # Copies are dealt over tasks before they are written out, so a third of all urls may be one.
    dealt = marked.select("items", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / cfg.copies))).alias("k"))
    dealt = dealt.repartition(spark.sparkContext.defaultParallelism)
    one = dealt.select("items", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(cfg.copies), F.col("n") - F.col("k") * cfg.copies))).alias("c"))
    schema = "items array<string>, verdict string, support long, confidence double"
    if marked.isEmpty():
        return spark.createDataFrame([], schema), items
    # The part counts against all labelled urls, those without frequent items too.
    n_sets = sets.agg(F.sum("n")).first()[0]
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n_sets)).fit(one.select("items"))
    frequent = stored(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "frequent")
    verdict = F.filter("items", lambda i: i.startswith("="))
    labels = frequent.withColumn("verdict", verdict)
    parts = labels.where("size(verdict) = 0").select("items", F.col("freq").alias("n"))
    whole = labels.where("size(verdict) = 1 and size(items) > 1").select(
        F.array_except("items", "verdict").alias("items"), F.substr(F.col("verdict")[0], F.lit(2)).alias("verdict"), F.col("freq").alias("support")
    )
    rules = whole.join(parts, "items").withColumn("confidence", F.col("support") / F.col("n")).drop("n")
    return stored(rules.where(F.col("confidence") >= cfg.least_confidence), "rules"), items


def pruned(rules: DataFrame) -> DataFrame:
    """Rules without those that do no better than a rule with one item less, which holds wherever they do."""
    less = F.transform("items", lambda i: F.array_except("items", F.array(i)))
    each = rules.where("size(items) > 1").select("items", "verdict", "confidence", F.explode(less).alias("part"))
    part = rules.select(F.col("items").alias("part"), "verdict", F.col("confidence").alias("as_good"))
    worse = each.join(part, ["part", "verdict"]).where("as_good >= confidence").select("items", "verdict").distinct()
    return rules.join(worse, ["items", "verdict"], "left_anti")


def learned_verdicts(bags: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """(tokens, best): for each bag of tokens that some rule holds for, the most confident one's verdict.

    Equal confidence is decided by support, then for `block`. Rules are found under their rarest item.
    """
    rarity = items.where("token = item").select("item", "n")
    listed = rules.withColumn("item", F.explode("items")).join(rarity, "item")
    listed = listed.groupBy("items", "verdict", "support", "confidence").agg(F.min(F.struct("n", "item"))["item"].alias("item"))
    held = stored(_as_items(bags, items, "tokens"), "held")
    met = held.select("tokens", F.col("items").alias("own"), F.explode("items").alias("item")).join(listed, "item")
    fit = met.where(F.size(F.array_except("items", "own")) == 0)
    order = F.struct("confidence", "support", (F.col("verdict") == BLOCK).alias("block"), "verdict")
    return fit.groupBy("tokens").agg(F.max(order).alias("best"))


def judged(urls: DataFrame, rules: Sequence[HostRule], labelled: DataFrame | None = None, cfg: Settings = Settings()) -> DataFrame:
    """(page_id, host, path, rule, verdict, learned, support, confidence), one row per input row with page_id and url.

    Host rules decide where one fits. The others are judged by association rules, learned from `labelled`
    (url, label) rows or, without them, from the urls that host rules decide; where none of them holds the
    verdict is the default. `learned`, `support` and `confidence` are those of the rule mined, else null and 0.
    A null url, one without `://` or an empty one has no tokens and gets the default. A null label takes no
    part. Repeated rows are judged alike and count each time; other columns are ignored; an empty table gives
    an empty result.
    """
    url = split_url(F.col("url").cast("string"))
    rows = urls.select(F.col("page_id").cast("long").alias("page_id"), url["host"].alias("host"), url["path"].alias("path"), tokens(url).alias("tokens"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = stored(rows.select("page_id", "host", "path", "tokens", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("given")), "urls")
    if labelled is None:
        known = rows.where("given is not null").select("tokens", F.col("given").alias("label"))
    else:
        known = labelled.where("label is not null").select(tokens(split_url(F.col("url").cast("string"))).alias("tokens"), F.col("label").cast("string"))
    found, items = mined(known, cfg)
    bags = rows.where("given is null").select("tokens").distinct()
    best = stored(learned_verdicts(bags, stored(pruned(found), "pruned"), items), "verdicts")
    # Rows that a host rule decides ask for no bag, so they take no part in the join.
    open_ = F.when(F.col("given").isNull(), F.col("tokens"))
    met = rows.withColumn("asked", open_).join(best.withColumnRenamed("tokens", "asked"), "asked", "left")
    return met.select(
        "page_id", "host", "path", "rule", F.coalesce("given", "best.verdict", F.lit(cfg.default)).alias("verdict"),
        F.col("best.verdict").alias("learned"), F.coalesce("best.support", F.lit(0)).alias("support"), F.coalesce("best.confidence", F.lit(0.0)).alias("confidence"),
    )
