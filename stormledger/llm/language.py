"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams, most frequent first. A document is compared
to the profile of each language by the out-of-place distance: for each of the document's n-grams the
difference of its two ranks, or the profile length where the language's profile lacks it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from stormledger.storage import stored

from .common import mapped, numbered, pieces

UNKNOWN = "und"
# Profiles travel with the tasks: `length` short rows per language, and no more languages than this.
MOST_LANGUAGES = 2_000
PIECE = 1 << 18
# Up to so many n-grams of an alphabet are counted in a table; beyond, by sorting.
TABLE = 1 << 19


@dataclass(frozen=True)
class Settings:
    length: int = 400


_is_letter: list[np.ndarray] = []


def _letters(points: np.ndarray) -> np.ndarray:
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _is_letter[0][points]


@dataclass
class Grams:
    """The n-grams of one to three letters of a list of texts, as numbers.

    Words are bounded by `_`, which counts as a letter of theirs at either end. In the alphabet of these
    texts `_` is 0 and letters follow by code point, so numbers sort by length and then by characters.
    """

    alphabet: np.ndarray
    codes: np.ndarray
    bounds: np.ndarray

    @property
    def size(self) -> int:
        return len(self.alphabet)

    def number(self, gram: str) -> int:
        """The number of an n-gram, or -1 where one of its letters does not occur."""
        points = np.array([0 if c == "_" else ord(c) for c in gram], dtype=np.uint32)
        ids = np.minimum(np.searchsorted(self.alphabet, points), self.size - 1)
        if (self.alphabet[ids] != points).any():
            return -1
        code = 0
        for i in ids:
            code = code * self.size + int(i)
        return code + sum(self.size**n for n in range(1, len(gram)))

    def gram(self, code: int) -> str:
        n = 1
        while code >= self.size**n:
            code, n = code - self.size**n, n + 1
        letters = []
        for _ in range(n):
            code, i = divmod(code, self.size)
            letters.append("_" if i == 0 else chr(self.alphabet[i]))
        return "".join(reversed(letters))

    def counted(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct numbers and how often each occurs."""
        if self.size + self.size**2 + self.size**3 <= TABLE:
            counts = np.bincount(codes)
            found = np.flatnonzero(counts)
            return found, counts[found]
        return np.unique(codes, return_counts=True)


def grams(texts: list[str | None]) -> Grams:
    lowered = [f" {(t or '').lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) for t in lowered])])
    letter = _letters(points)
    # One boundary between words; each text begins and ends with one of its own.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[at[:-1]] = True
    at = np.concatenate([[0], np.cumsum(keep)])[at]
    points = np.where(letter, points, 0)[keep]
    alphabet, ids = np.unique(np.concatenate([[np.uint32(0)], points]), return_inverse=True)
    ids, n = ids[1:].astype(np.int64), len(alphabet)
    # Three n-grams begin at each place at most; -1 where there is none.
    codes = np.full((len(ids), 3), -1, dtype=np.int64)
    codes[:, 0] = np.where(ids > 0, ids, -1)
    two = ids[:-1] * n + ids[1:]
    codes[:-1, 1] = np.where((ids[:-1] > 0) | (ids[1:] > 0), n + two, -1)
    codes[:-2, 2] = np.where(ids[1:-1] > 0, n + n * n + two[:-1] * n + ids[2:], -1)
    # None reaches into the next text, which begins with a boundary as this one ends with one.
    real = codes >= 0
    return Grams(alphabet, codes[real], np.concatenate([[0], np.cumsum(real.sum(axis=1))])[at])


def profiles(docs: DataFrame, lang: str = "lang", cfg: Settings = Settings()) -> DataFrame:
    """(lang, gram, rank from 0) of each language, counted over every whole text with a language."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch, "text", PIECE):
            by_name: dict[str, list[str]] = {}
            for name, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                by_name.setdefault(name, []).append(text)
            for name, texts in by_name.items():
                found = grams(texts)
                codes, counts = found.counted(found.codes)
                yield {"lang": [name] * len(codes), "gram": [found.gram(int(c)) for c in codes], "n": counts}

    known = docs.select(F.col(lang).cast("string").alias("lang"), F.col("text").cast("string")).where("lang is not null and text is not null")
    counts = mapped(known, count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A language has as many n-grams as its alphabet allows, however many documents there are.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.length("gram"), "gram")
    best = counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < cfg.length)
    return best.select("lang", "gram", "rank")


def collected(profile_rows: DataFrame) -> dict[str, list[str]]:
    """Profiles as lists, after a check that there are no more than tasks may carry."""
    rows = stored(profile_rows, "profiles")
    if (n := rows.select("lang").distinct().count()) > MOST_LANGUAGES:
        raise ValueError(f"{n} languages; profiles are made for {MOST_LANGUAGES} at most")
    found: dict[str, list[str]] = {}
    for row in sorted(rows.collect(), key=lambda r: (r["lang"], r["rank"])):
        found.setdefault(row["lang"], []).append(row["gram"])
    return found


class Matcher:
    """Out-of-place distances of texts to every profile."""

    def __init__(self, known: dict[str, list[str]], cfg: Settings):
        self.cfg, self.names = cfg, sorted(known)
        self.grams = sorted({g for grams in known.values() for g in grams})
        row = {g: i for i, g in enumerate(self.grams)}
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, dtype=np.int32)
        for k, name in enumerate(self.names):
            for rank, gram in enumerate(known[name]):
                self.ranks[row[gram], k] = rank

    def match(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found, length = grams(texts), self.cfg.length
        numbers = np.array([found.number(g) for g in self.grams], dtype=np.int64)
        order = np.argsort(numbers, kind="stable")
        numbers = numbers[order]
        out = []
        for start, end in zip(found.bounds[:-1], found.bounds[1:]):
            if start == end or not self.names:
                out.append((UNKNOWN, 0.0))
                continue
            codes, counts = found.counted(found.codes[start:end])
            # Most frequent first; equal counts in the order of the numbers.
            own = codes[np.argsort(-counts, kind="stable")[:length]]
            place = np.minimum(np.searchsorted(numbers, own), len(numbers) - 1)
            theirs = self.ranks[np.where(numbers[place] == own, order[place], -1)]
            far = np.where(theirs < 0, length, np.abs(theirs - np.arange(len(own))[:, None])).sum(axis=0)
            best = int(far.argmin())
            out.append((self.names[best], 1.0 - float(far[best]) / (len(own) * length)))
        return out


def identify(docs: DataFrame, learn: Column | None = None, cfg: Settings = Settings()) -> DataFrame:
    """Predict the language of each document: (doc_id, lang_pred, score), one row per input row.

    `learn` marks the rows whose `lang` may be learned from (all by default); a prediction looks at the
    text only. The score is 1 minus the distance over the largest one possible. A text that is null,
    empty or without letters gets `und` and score 0, and so does every text when nothing could be
    learned. Equal distances go to the language whose name sorts first. Repeated rows are predicted
    alike; other columns of any name are ignored. Reads the texts twice, shuffles n-gram counts only.
    """
    chosen = docs if learn is None else docs.where(F.coalesce(learn, F.lit(False)))
    known = collected(profiles(chosen, cfg=cfg))

    def predict(batch: pa.RecordBatch) -> dict:
        matcher = Matcher(known, cfg)
        found = [f for piece in pieces(batch, "text", PIECE) for f in matcher.match(piece.column("text").to_pylist())]
        return {"doc_id": batch.column(0), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return mapped(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), predict, "doc_id long, lang_pred string, score double")


def cutoffs(judged: DataFrame, quantile: float) -> DataFrame:
    """(lang, cutoff): the score that all but a part `quantile` of a language's documents reach, from (lang, score) rows.

    Scores are cut to four digits and counted, so a language has as many counts as there are such
    scores, however many documents there are.
    """
    counts = judged.select("lang", (F.floor(F.col("score") * 10_000) / 10_000).alias("cut")).groupBy("lang", "cut").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("lang")
    upto = F.sum("n").over(own.orderBy("cut").rowsBetween(Window.unboundedPreceding, 0))
    reached = counts.withColumn("upto", upto).withColumn("total", F.sum("n").over(own)).where(F.col("upto") > F.col("total") * quantile)
    return reached.groupBy("lang").agg(F.min("cut").alias("cutoff"))


def kept_languages(
    docs: DataFrame, learn: Column | None = None, least: float = 0.1, cfg: Settings = Settings(), quantile: float = 0.005
) -> DataFrame:
    """Documents in a recognisable language, with all their columns.

    Rejected are texts without letters and texts that score below `least` or below what all but a part
    `quantile` of the learned documents of the predicted language reach: not written in any of the
    learned languages. Only learned documents predicted as labelled count for that. A document whose
    `lang` is null or mistaken stays. Texts are read for the profiles and for scoring; scored documents
    are stored, as cutoffs are known after all scores.
    """
    chosen = docs if learn is None else docs.where(F.coalesce(learn, F.lit(False)))
    rows, col = numbered(docs.select("*", F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))))
    lang, text, last = col["lang"].cast("string"), col["text"].cast("string"), F.col(rows.columns[-1])
    known = collected(profiles(chosen.select(F.col("lang"), F.col("text")), cfg=cfg))
    rows = rows.withColumn("learned", F.when(last, lang)).withColumn("read", text).drop(rows.columns[-1])
    kept_names = rows.columns[: len(docs.columns)]
    made = StructType([*rows.select(*kept_names, "learned").schema, StructField("lang", StringType()), StructField("score", DoubleType())])

    def judge(batches):
        matcher = Matcher(known, cfg)
        for batch in batches:
            # Pieces leave as they are made, so a task holds one batch of whole rows only.
            for piece in pieces(batch, "read", PIECE):
                found = matcher.match(piece.column("read").to_pylist())
                judged = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *judged], names=made.names)

    judged = stored(rows.mapInArrow(judge, made).where((F.col("lang") != UNKNOWN) & (F.col("score") >= least)), "judged")
    found = {r["lang"]: r["cutoff"] for r in cutoffs(judged.where("learned = lang"), quantile).collect()}  # one row per language
    # Tasks carry a number per language, so no text is shuffled for it.
    cut = F.create_map(*[F.lit(x) for pair in sorted(found.items()) for x in pair])[F.col("lang")] if found else F.lit(None)
    return judged.where(F.col("score") >= F.coalesce(cut, F.lit(least))).select(*kept_names).toDF(*docs.columns)
