"""Removal of lines that repeat an earlier line, up to one edit.

Equal lines meet by their hash. Lines within one edit meet by what is left when a part is deleted: if
both lose the part with the edit, the rests are equal. Deleting is refined in steps. First a half is
deleted from every line, then quarters of those halves, then quarters of these parts, and at last single
characters; each step only goes on with parts whose rest some other line shares, which no line within
one edit can fail. So only few lines emit the rests of all their characters, and none is left out.

Rests are hashed and grouped, never paired: of the lines that agree but for one character at one place
the earliest is found as a minimum. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormledger.storage import stored

from .common import BLANKS, numbered


@dataclass(frozen=True)
class Settings:
    # Lines of fewer characters only count as repeated if they are equal.
    least_fuzzy: int = 20
    # Parts that a deleted part is divided into, and how often, before single characters are deleted.
    parts: int = 4
    refinements: int = 2


NO_ID = -(1 << 63)
PLACE = ["doc_id", "no", "text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): the columns that name a row, without nulls."""
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )


def _lines(keyed: DataFrame) -> DataFrame:
    """(doc_id, no, text_hash, line, a, b): all lines with more than blanks, and a hash of 128 bits in two numbers."""
    rows = keyed.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    full = rows.where(F.btrim("line", F.lit(BLANKS)) != "")
    return full.select(*PLACE, "line", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def _rest(line: Column, length: Column, common: Column, start: Column, end: Column) -> Column:
    """Hash of a line without the part from `start` to `end`.

    `common` is the shorter length of the two lines that may meet; places after the part count from the
    end, so a line that is one longer loses one character more.
    """
    tail = F.substr(line, length - (common - end) + 1)
    return F.xxhash64(common, start, end, F.substr(line, F.lit(1), start), F.lit("\n"), tail)


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (key, a, ...) whose key some other line has too."""
    several = rows.groupBy("key").agg(F.min("a").alias("x"), F.max("a").alias("y")).where("x != y").select("key")
    return rows.join(several, "key", "left_semi")


def _roles(length: Column) -> Column:
    """Both shorter lengths that a line may share with another: its own, or one less."""
    return F.array(length, length - 1)


def _halves(rows: DataFrame, least: int) -> DataFrame:
    """(key, a, b, common, start, end): the rests of all lines without either half."""
    fuzzy = rows.where(F.length("line") >= least).select("a", "b", "line", F.length("line").alias("length"))
    roles = fuzzy.select("*", F.explode(_roles(F.col("length"))).alias("common"))
    half = F.floor(F.col("common") / 2).cast("int")
    ends = F.array(F.struct(F.lit(0).alias("start"), half.alias("end")), F.struct(half.alias("start"), F.col("common").alias("end")))
    each = roles.select("*", F.explode(ends).alias("part"))
    key = _rest(F.col("line"), F.col("length"), F.col("common"), F.col("part.start"), F.col("part.end"))
    return each.select(key.alias("key"), "a", "b", "common", "part.start", "part.end")


def _refined(parts: DataFrame, texts: DataFrame, cfg: Settings) -> DataFrame:
    """The shared parts (a, b, common, start, end), each divided into smaller ones that are still shared."""
    size = F.greatest(F.ceil((F.col("end") - F.col("start")) / cfg.parts).cast("int"), F.lit(1))
    starts = F.sequence(F.col("start"), F.greatest(F.col("start"), F.col("end") - 1), size)
    cut = parts.select("a", "b", "common", F.col("end").alias("stop"), size.alias("size"), F.explode(starts).alias("start"))
    cut = cut.withColumn("end", F.least(F.col("start") + F.col("size"), F.col("stop"))).join(texts, ["a", "b"])
    key = _rest(F.col("line"), F.length("line"), F.col("common"), F.col("start"), F.col("end"))
    return _shared(cut.select(key.alias("key"), "a", "b", "common", "start", "end")).drop("key")


def _close_pairs(parts: DataFrame, texts: DataFrame, firsts: DataFrame) -> DataFrame:
    """(a, b, other_a, other_b): lines within one edit of an earlier line, by deleting single characters."""
    rows = parts.join(texts, ["a", "b"]).withColumn("length", F.length("line"))
    at = F.explode(F.sequence("start", F.when(F.col("length") > F.col("common"), F.col("end")).otherwise(F.col("end") - 1))).alias("at")
    place = F.struct(*PLACE, "a", "b")
    rests = rows.select("a", "b", *PLACE, "length", "common", "line", at)
    without = F.concat(F.substr("line", F.lit(1), F.col("at")), F.substr("line", F.col("at") + 2))
    # One character replaced: equal rests by the same place. There is one line per character at most.
    same = rests.where("length = common").select(F.xxhash64("at", "common", without).alias("key"), "a", "b", place.alias("place"))
    order = Window.partitionBy("key")
    replaced = same.distinct().withColumn("first", F.min("place").over(order)).where(
        (F.col("first.a") != F.col("a")) | (F.col("first.b") != F.col("b"))
    ).select("a", "b", F.col("first.a").alias("other_a"), F.col("first.b").alias("other_b"))
    # One character more: the rest equals a whole line. The later of the two goes.
    longer = rests.where("length > common").select(F.xxhash64(without).alias("rest_a"), F.xxhash64(F.lit(1), without).alias("rest_b"), place.alias("long"))
    short = firsts.select(F.col("a").alias("rest_a"), F.col("b").alias("rest_b"), place.alias("short"))
    met = longer.distinct().join(short, ["rest_a", "rest_b"]).select(F.greatest("long", "short").alias("late"), F.least("long", "short").alias("early"))
    added = met.select("late.a", "late.b", F.col("early.a").alias("other_a"), F.col("early.b").alias("other_b"))
    return replaced.union(added).distinct()


def repeated(keyed: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, text_hash, gone): the numbers of each row's lines that repeat an earlier one."""
    rows = _lines(keyed)
    every = rows.groupBy("a", "b").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n"))
    every = stored(every.select("a", "b", "first.*", "n"), "lines")
    # Equal lines: all occurrences after the first. Only lines seen twice are joined.
    twice = every.where("n > 1").select("a", "b", F.struct(*PLACE).alias("first"))
    again = rows.select(*PLACE, "a", "b").join(twice, ["a", "b"]).where(F.struct(*PLACE) > F.col("first")).select(*PLACE)
    # Lines within one edit: first occurrences only.
    parts = stored(_shared(_halves(rows, cfg.least_fuzzy)).drop("key").distinct(), "halves")
    wanted = every.join(parts.select("a", "b").distinct(), ["a", "b"], "left_semi")
    numbers = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("no", "a", "b")).alias("wanted"))
    found = keyed.join(numbers, ["doc_id", "text_hash"]).select("doc_id", "text_hash", F.split("text", "\n").alias("l"), F.explode("wanted").alias("w"))
    texts = stored(found.select("w.a", "w.b", "doc_id", "w.no", "text_hash", F.expr("l[w.no]").alias("line")).distinct(), "near_lines")
    words_only = texts.select("a", "b", "line")
    for _ in range(cfg.refinements):
        parts = stored(_refined(parts, words_only, cfg).distinct(), "parts")
    pairs = stored(_close_pairs(parts, texts, every), "pairs")
    checked = (
        pairs.join(texts, ["a", "b"])
        .join(texts.select(F.col("a").alias("other_a"), F.col("b").alias("other_b"), F.col("line").alias("other")), ["other_a", "other_b"])
        .where(F.levenshtein("line", "other", 1) >= 0)
        .select(*PLACE)
    )
    return again.union(checked).groupBy("doc_id", "text_hash").agg(F.collect_set("no").alias("gone"))


def deduplicated(docs: DataFrame, cfg: Settings = Settings(), counts: bool = False, emptied: bool = True) -> DataFrame:
    """The documents, with all their columns, without lines that repeat an earlier line.

    A line is removed if an equal line, or one within one edit where both have `least_fuzzy` characters
    or more, stands earlier in the order of doc_id and line; earlier lines count whether or not they stay
    themselves. Lines of blanks are neither removed nor repeated. Rows that repeat an id and text have
    the same places, so a line they share is the earliest in each of them and stays; a null id is
    smaller than all others. A null text stays null. A line break before the first kept line goes with
    the lines removed. With `counts` there are also n_lines, of those with more than blanks, and n_removed.
    Without `emptied`, documents that lost all their lines are left out.
    """
    plain, col = numbered(docs)
    text, doc_id = col["text"].cast("string"), col["doc_id"].cast("long")
    gone = stored(repeated(_keyed(plain.select(doc_id.alias("doc_id"), text.alias("text"))), cfg), "gone")
    keyed = plain.select("*", F.coalesce(doc_id, F.lit(NO_ID)).alias("key_id"), F.xxhash64(text).alias("key_hash"))
    met = keyed.join(gone.toDF("key_id", "key_hash", "gone"), ["key_id", "key_hash"], "left")
    lines = F.split(text, "\n")
    full = F.filter(lines, lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    if not emptied:
        met = met.where(F.col("gone").isNull() | (F.size("gone") < F.size(full)))
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")))
    kept = F.when(F.col("gone").isNull(), text).otherwise(
        F.transform(F.array(lines), lambda held: F.array_join(F.transform(stay, lambda i: held[i]), "\n"))[0]
    )
    columns, names = [kept if c == "text" else F.col(f"c{i}") for i, c in enumerate(docs.columns)], list(docs.columns)
    if counts:
        columns += [F.coalesce(F.size(full), F.lit(0)).cast("long"), F.coalesce(F.size("gone"), F.lit(0)).cast("long")]
        names += ["n_lines", "n_removed"]
    return met.select(*columns).toDF(*names)
