"""Personal data by fixed shapes and, beyond them, by contexts learned from those.

Four shapes (email, ip, card, phone) are found everywhere and are the seeds. The words around a seed form
lexical patterns: two before, two after, or one on either side. Patterns and the instances they surround
are a graph. In each round a pattern's score is how reliably its instances are known identifiers or were
accepted so far, and an instance's score is the chance that at least one of its patterns is right; both
are joined and aggregated by Spark, until no pattern is added and scores hold. Unseen instances of high-confidence patterns are reported as spans of kind `other`.
An instance is a stretch without blanks that holds a digit: plain words are never reported.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormledger.storage import stored

from .common import mapped

KINDS = ("email", "ip", "card", "phone")
# What follows the local part of an address; the local part itself is read backwards from the sign.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Runs of digits are taken whole, so that a long one is read once. The results are those of the plain patterns.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# A match begins where its run does and never looks back, so that a long run without a digit is read once.
INSTANCE = re.compile(r"(?<![^\s\"'<>(){}\[\],;|])[^0-9\s\"'<>(){}\[\],;|]*+[0-9][^\s\"'<>(){}\[\],;|]*+")
TOKEN = re.compile(r"[^\W_]+|[^\w\s]")


@dataclass(frozen=True)
class Settings:
    # A pattern is trusted from this score on, and only with this many distinct instances known or accepted.
    least_score: float = 0.8
    least_known: int = 3
    # Rounds end when no pattern is added and no score changes by more.
    tolerance: float = 1e-6
    # Characters of context looked at on either side of an instance.
    reach: int = 80
    # Shorter instances, such as single numbers, are not identifiers.
    shortest: int = 6


def at_most_255(part: str) -> bool:
    # Zeros in front count for nothing, however many; Python refuses to read numbers of thousands of digits.
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start: leftmost matches of each kind that do not overlap and pass its check."""
    found = []
    if "@" in text:
        end = 0
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                found.append((0, start, m.end()))
                end = m.end()
    for m in IP.finditer(text):
        if all(map(at_most_255, m.group().split("."))):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def contexts(text: str, start: int, end: int, reach: int) -> list[str]:
    """The lexical patterns around text[start:end]."""
    before = TOKEN.findall(text[max(0, start - reach) : start].lower())[-2:]
    after = TOKEN.findall(text[end : end + reach].lower())[:2]
    if start > reach and len(before) > 1 and text[start - reach - 1 : start - reach].strip():
        before = before if len(TOKEN.findall(text[start - reach : start])) > 2 else before[-1:]
    made = []
    if len(before) == 2:
        made.append(f"{before[0]} {before[1]} _")
    if len(after) == 2:
        made.append(f"_ {after[0]} {after[1]}")
    if before and after:
        made.append(f"{before[-1]} _ {after[0]}")
    return made


def _scan(batch: pa.RecordBatch, cfg: Settings) -> dict:
    base, seen = [], []
    for text in batch.column(1).to_pylist():
        text = text or ""
        spans = base_spans(text)
        base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
        taken = sorted((s, e) for _, s, e in spans)
        mine, k = [], 0
        for s, e in dict.fromkeys(taken):
            mine.append({"start": s, "end": e, "known": True, "instance": text[s:e], "patterns": contexts(text, s, e, cfg.reach)})
        for m in INSTANCE.finditer(text):
            s, e = m.start(), m.end()
            while e > s and text[e - 1] in ".:!?":
                e -= 1
            while k < len(taken) and taken[k][1] <= s:
                k += 1
            if e - s >= cfg.shortest and not any(a < e and s < b for a, b in taken[max(0, k - 3) : k + 3]):
                mine.append({"start": s, "end": e, "known": False, "instance": text[s:e], "patterns": contexts(text, s, e, cfg.reach)})
        seen.append(mine)
    return {"doc_id": batch.column(0), "base": base, "seen": seen}


SCANNED = (
    "doc_id long, base array<struct<kind: int, start: int, end: int>>, "
    "seen array<struct<start: int, end: int, known: boolean, instance: string, patterns: array<string>>>"
)


def trusted_patterns(links: DataFrame, cfg: Settings) -> DataFrame:
    """(pattern, score) of the trusted ones, from the graph's links (pattern, instance, known).

    Known instances score 1 for good. A pattern's score is the mean of its instances' scores, shrunk by
    one unknown instance; an instance's the chance that not all of its trusted patterns are wrong, and
    an instance of a trusted pattern is accepted. An accepted instance supports its other patterns in
    the next round as a known one does, so scores only grow and the rounds end.
    """
    size = links.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    # No round can support a pattern of fewer instances.
    links = stored(links.join(size.where(F.col("n") >= cfg.least_known).select("pattern"), "pattern", "left_semi"), "links")
    worth, before = links.withColumn("worth", F.col("known").cast("double")), (0, 0.0)
    while True:
        score = worth.groupBy("pattern").agg(
            (F.sum("worth") / (F.count(F.lit(1)) + 1)).alias("score"), F.count(F.when(F.col("worth") > 0, 1)).alias("support")
        )
        trusted = (F.col("score") >= cfg.least_score) & (F.col("support") >= cfg.least_known)
        score = stored(score.where(trusted).select("pattern", "score"), "patterns")
        now = tuple(score.agg(F.count(F.lit(1)), F.coalesce(F.sum("score"), F.lit(0.0))).first())
        # Scores only grow, so no single one has changed by more than their sum.
        if now[0] == before[0] and now[1] - before[1] <= cfg.tolerance:
            return score
        before = now
        doubt = F.sum(F.log(1 - F.col("score") + 1e-9))
        found = links.join(score, "pattern").groupBy("instance").agg((1 - F.exp(doubt)).alias("found"))
        worth = links.join(found, "instance", "left").withColumn(
            "worth", F.when(F.col("known"), F.lit(1.0)).otherwise(F.coalesce("found", F.lit(0.0)))
        )


def extract(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, base, more): base spans by kind and start, and those found by context; one row per input row.

    Offsets are code points, ends exclusive. A null or empty text has none. A context span never overlaps
    a base span. Repeated rows get the same spans; other columns are ignored. The texts are read once:
    spans and contexts, which are rare, are stored, and only they are shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    scanned = stored(mapped(rows, lambda batch: _scan(batch, cfg), SCANNED), "spans").withColumn("row", F.monotonically_increasing_id())
    scanned = stored(scanned, "spans")
    each = scanned.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    links = each.select(F.explode("patterns").alias("pattern"), "instance", "known").groupBy("pattern", "instance").agg(F.max("known").alias("known"))
    patterns = trusted_patterns(links, cfg)
    open_ = each.where("not known").select("row", "start", "end", F.explode("patterns").alias("pattern"))
    found = open_.join(patterns, "pattern").groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("more"))
    none = F.array().cast("array<struct<start: int, end: int>>")
    return scanned.join(found, "row", "left").select("doc_id", "base", F.coalesce("more", none).alias("more"))
