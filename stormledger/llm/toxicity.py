"""Toxicity scores after undoing disguises of words.

Writers of abuse hide words behind digits and signs, spread them over spaces and stretch letters. Each
suspicious stretch of a text is a noisy message: a lattice offers, for every sign, the letters it may
stand for, for a repeated letter one, two or all of its repeats, and for a gap between single letters
nothing or the end of a word. Viterbi decoding picks the path that is likeliest under a character model
of the corpus and a channel that charges for every disguise. The restored text is then scored by words
learned from labels. Words broken into parts that are plain letters, too, are found by following the
parts through the beginnings of the learned words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.storage import stored

from .common import mapped, packed, unpacked

# Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou",
}
ALPHABET = "_abcdefghijklmnopqrstuvwxyz"
CODE = {c: i for i, c in enumerate(ALPHABET)}
OTHER = len(ALPHABET)  # letters outside a-z

WORD = re.compile(r"[^\W\d_]+")
# Signs that may surround a word, and those of them that never stand for its first or last letter.
AROUND = ".,;:?\"'`()[]{}<>#%&^~=/\\_-!*|+…“”„«»¡¿"
OUTSIDE = "".join(c for c in AROUND if c not in SIGNS)
THRICE = re.compile(r"([^\W\d_])\1\1")
STRETCHED = re.compile(r"[^\W\d_]*?([^\W\d_])\1\1[^\W\d_]*")
# Three or more single letters or signs with up to three blanks, dots, hyphens or underscores between each.
# This and PART read texts whose underscores were made blanks.
SPACED = re.compile(r"(?<![^\s\"'(\[{])[\w@$!|+(*](?:[\s.-]{1,3}[\w@$!|+(*]){2,}(?![\w@$!|+(*])")
GAP, WIDE = re.compile(r"[\s.-]+"), re.compile(r"[\s.-]{2,3}")
# One word written with marks between its parts, and what parts of words may stand between.
BROKEN = re.compile(r"[\w@$!|+(*]+(?:[._\-~*'’/·][\w@$!|+(*]+)+")
PART = re.compile(r"[\w@$!|+(*][\w@$!|+(*'’]*")
# Single letters that are words of their own.
LONE = frozenset("aeiouy")
# A letter written more than three times is written three times.
LONG_REPEAT = re.compile(r"(.)\1{3,}")
# Lengths of word beginnings that are features of their own.
STEMS = (4, 5, 6)
# Disguised words, with repeats folded, are no longer than this; longer runs of letters and digits are
# codes and addresses. Longer rows of single letters are read in overlapping stretches of this length.
LONGEST = 40
# Tokens without signs that a task remembers at a time.
PLAIN_HELD = 400_000


@dataclass(frozen=True)
class Settings:
    # Words in the classifier at most, and toxic documents that a word must be seen in.
    most_words: int = 4_000
    least_documents: int = 3
    # Chance that any word at all enters by luck.
    error: float = 0.05
    # Least odds of a word, of which the best is chosen on one part in `parts` of the labelled documents: words of
    # copied texts pass any test without telling anything of others.
    least_odds: tuple[float, ...] = (0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0)
    parts: int = 4
    # Cost, as a log probability, of a disguised letter and of a letter stretched over three or more.
    sign_cost: float = -1.0
    repeat_cost: float = -0.5
    # Cost of reading two equal letters, which plain words have too, as one.
    double_cost: float = -4.0
    # Cost of reading parts of words as one word, against the odds that the word adds. Parts meet by chance too.
    gap_cost: float = -4.0
    # Added to counts of documents with a word.
    smoothing: float = 0.5
    # Distinct words a task holds before it passes on its counts.
    held: int = 100_000


def pair_counts(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(a, b, n): how often letter b follows a, over all words of all whole texts (0 bounds a word, 27: other letter)."""

    def count(batch: pa.RecordBatch) -> dict:
        table = np.zeros((OTHER + 1, OTHER + 1), dtype=np.int64)
        lookup = np.full(128, OTHER, dtype=np.int64)
        for c, i in CODE.items():
            lookup[ord(c)] = i
        for text in batch.column(0).to_pylist():
            spaced = re.sub(r"[\W\d_]+", "_", f"_{text.lower()}_")
            points = np.frombuffer(spaced.encode("utf-32-le"), dtype=np.uint32)
            codes = np.where(points < 128, lookup[np.minimum(points, 127)], OTHER)
            table += np.bincount(codes[:-1] * (OTHER + 1) + codes[1:], minlength=table.size).reshape(table.shape)
        a, b = np.nonzero(table)
        return {"a": a, "b": b, "n": table[a, b]}

    counted = mapped(docs.select("text").where("text is not null"), count, "a int, b int, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame, cfg: Settings = Settings()) -> np.ndarray:
    """log P(b | a) as a 28 x 28 table, one count added to each pair."""
    table = np.ones((OTHER + 1, OTHER + 1))
    for a, b, n in pair_counts(docs, cfg).collect():  # at most 28 * 28 rows
        table[a, b] += n
    return np.log(table / table.sum(axis=1, keepdims=True))


class Restorer:
    """Most likely plain spelling of disguised words."""

    def __init__(self, model: np.ndarray, cfg: Settings):
        self.model, self.cfg = model, cfg
        self.decode = lru_cache(50_000)(self._decode)
        self.token = lru_cache(100_000)(self._token)
        self.plain: set[str] = set()

    def _steps(self, token: str) -> list[list[tuple[str, float]]]:
        """For each run of one sign: the spellings it may stand for, with their costs."""
        steps = []
        for run in re.finditer(r"(.)\1*", token):
            sign, n = run.group(1), len(run.group())
            if sign == " ":
                steps.append([("", 0.0), ("_", 0.0)])
                continue
            letters = SIGNS.get(sign, sign if sign.isalpha() else "")
            cost = 0.0 if sign.isalpha() else self.cfg.sign_cost
            choices = [
                (c * k, cost * n + (0.0 if k == n else self.cfg.double_cost if n == 2 else self.cfg.repeat_cost))
                for c in letters
                for k in ({n} if n == 1 else {1, 2})
            ]
            if choices:
                steps.append(choices)
        return steps

    def _decode(self, token: str) -> str:
        # States are last letters; each keeps its best spelling so far.
        best: dict[str, tuple[float, str]] = {"_": (0.0, "")}
        code, model = CODE, self.model
        for choices in self._steps(token):
            after: dict[str, tuple[float, str]] = {}
            for last, (score, spelt) in best.items():
                for letters, cost in choices:
                    total, at = score + cost, code.get(last, OTHER)
                    for c in letters:
                        to = code.get(c, OTHER)
                        total += model[at, to]
                        at = to
                    end = letters[-1] if letters else last
                    held = after.get(end)
                    if held is None or total > held[0]:
                        after[end] = (total, spelt + letters)
            best = after
        end = [(score + model[code.get(last, OTHER), 0], spelt) for last, (score, spelt) in best.items()]
        return max(end, key=lambda x: (x[0], x[1]))[1] if end else ""

    def readings(self, text: str | None) -> tuple[set[str], dict[str, set[str]]]:
        """The distinct lower-case words of a text with restored ones, and what each restored one is made of.

        The parts of a restored word are the plain words that are read in its place otherwise. Signs at
        the ends of a word are read as letters and as what only surrounds it, marks within it as nothing.
        """
        if not text:
            return set(), {}
        low = text.lower()
        found, parts = set(WORD.findall(low)), {}

        def add(token: str, plain: str) -> None:
            word = self.decode(token)
            if word and word not in found:
                parts.setdefault(word, set()).update(WORD.findall(plain))

        # Most tokens are plain words, seen before; they leave at once by a difference of sets.
        fresh = set(low.split()) - self.plain
        signs = [(raw, t) for raw in fresh if not raw.isalpha() and not (t := raw.strip(OUTSIDE)).isalpha()]
        thrice = [raw for raw in fresh if THRICE.search(raw)] if THRICE.search(" ".join(fresh)) else []
        for _, t in signs:
            for word, plain in self.token(t):
                if word not in found:
                    parts.setdefault(word, set()).update(plain)
        for raw in thrice:
            for m in STRETCHED.finditer(raw):
                token = LONG_REPEAT.sub(r"\1\1\1", m.group())
                if len(token) <= LONGEST:
                    add(token, token)
        self.plain.update(fresh.difference(thrice, [raw for raw, _ in signs]))
        if len(self.plain) > PLAIN_HELD:
            self.plain.clear()
        for m in SPACED.finditer(low.replace("_", " ")):
            if any(map(str.isalpha, m.group())):
                self._spaced(m.group(), add, parts)
        found.update(parts)
        return found, parts

    def _token(self, t: str) -> tuple[tuple[str, tuple[str, ...]], ...]:
        """Restored words of a token with signs or marks, each with the plain words read otherwise."""
        t = LONG_REPEAT.sub(r"\1\1\1", t)
        if not 1 < len(t) <= LONGEST or not any(map(str.isalpha, t)):
            return ()
        tokens = {t} if BROKEN.fullmatch(t) else set()
        if not SIGNS.keys().isdisjoint(t):
            for left in {t, t.lstrip(AROUND)}:
                tokens |= {x for x in (left, left.rstrip(AROUND)) if len(x) > 1 and not x.isalpha() and not SIGNS.keys().isdisjoint(x)}
        plain = tuple(WORD.findall(t))
        return tuple((word, plain) for word in {self.decode(x) for x in tokens} if word)

    def _spaced(self, run: str, add: Callable[[str, str], None], parts: dict[str, set[str]]) -> None:
        """Single letters in a row: as one word, as words at the wide gaps, and as words where the model ends them."""
        for stretch in {run, *WIDE.split(run)}:
            letters = GAP.split(stretch)
            for k in range(0, max(1, len(letters) - LONGEST // 2), LONGEST // 2):
                some = letters[k : k + LONGEST]
                if len(some) > 1:
                    words = self.decode(" ".join(some)).split("_")
                    for word in words:
                        if len(word) > 1:
                            parts.setdefault(word, set())
                    add("".join(some), " ".join(words))

    def words(self, text: str | None) -> set[str]:
        """The distinct lower-case words of a text, with restored ones added."""
        return self.readings(text)[0]


def features(words: set[str]) -> set[str]:
    """The words and, marked by a star, their beginnings: inflected forms share those."""
    return words.union(*[{w[:n] + "*" for w in words if len(w) > n} for n in STEMS])


class Evidence:
    """Summed log odds of the telling words of a text; a word counts once, by its most telling form.

    `ordinary` are plain words that telling words are made of: parts that are all such are taken as they stand.
    A word that is broken into parts adds its odds less `gap_cost`; words that add nothing then aren't sought.
    """

    def __init__(self, odds: dict[str, float], ordinary: set[str] = frozenset(), gap_cost: float = 0.0):
        self.odds, self.ordinary = odds, ordinary | LONE
        self.whole = {f for f in odds if not f.endswith("*")}
        self.stems = [(n, {f[:-1] for f in odds if f.endswith("*") and len(f) == n + 1}) for n in STEMS]
        # What all these begin with: other words have none of them.
        self.heads = {stem[: STEMS[0]] for _, stems in self.stems for stem in stems}
        # Those of words that are sought in parts.
        self.broken = {f: o + gap_cost for f, o in odds.items() if o + gap_cost > 0}
        self.broken_stems = [(n, {f[:-1] for f in self.broken if f.endswith("*") and len(f) == n + 1}) for n in STEMS]
        # Beginnings of these, the words themselves among them.
        self.begun = {f.rstrip("*")[:n] for f in self.broken for n in range(1, len(f) + 1)}
        self.through, self.telling = lru_cache(100_000)(self._through), lru_cache(50_000)(self._telling)
        self.closed: set[str] = set()
        self.first, self.goes_on = lru_cache(100_000)(self._first), lru_cache(100_000)(self._goes_on)

    def hits(self, words: set[str], parts: dict[str, set[str]] | None = None) -> dict[str, float]:
        found = {w: self.odds[w] for w in words & self.whole}
        some = [w for w in words if w[: STEMS[0]] in self.heads]
        for n, stems in self.stems if some else ():
            for w in some:
                if len(w) > n and w[:n] in stems:
                    found[w] = max(found.get(w, 0.0), self.odds[w[:n] + "*"])
        # The words that a restored one stands for, or that one, whichever tell more.
        for w in sorted(found.keys() & (parts or {}).keys()):
            others = (parts[w] & found.keys()) - {w}
            if others and w in found:
                for gone in others if found[w] > sum(found[o] for o in others) else [w]:
                    del found[gone]
        return found

    def _telling(self, word: str) -> float:
        """The odds of a word by itself or by its beginnings, 0 if it tells nothing."""
        own = [self.broken.get(word, 0.0)]
        own += [self.broken[word[:n] + "*"] for n, stems in self.broken_stems if len(word) > n and word[:n] in stems]
        return max(own)

    def joined(self, text: str) -> dict[str, float]:
        """Telling words that a text breaks into parts, with signs for letters or letters repeated in them.

        From every part on, all spellings that begin a telling word are followed over the next parts for
        as long as there are any, so a word may be broken anywhere and any number of times.
        """
        found: dict[str, float] = {}
        tokens = PART.findall(text.lower().replace("_", " "))
        begun, through, first, goes_on, plain_ones = self.begun, self.through, self.first, self.goes_on, self.ordinary
        # Few tokens begin a telling word; the others, once known, leave by a difference of sets.
        fresh = set(tokens) - self.closed
        open_ = {t for t in fresh if first(t)}
        self.closed.update(fresh - open_)
        if len(self.closed) > PLAIN_HELD:
            self.closed.clear()
        if not open_:
            return found
        for i in [i for i, t in enumerate(tokens[:-1]) if t in open_]:
            token = tokens[i]
            if not goes_on(token, tokens[i + 1][:3]):
                continue
            states = first(token)
            plain, single, mine = token in plain_ones, len(token) == 1, {}
            for k in range(i + 1, len(tokens)):
                token = tokens[k]
                after = {x for s in states for x in through(s, token)}
                if not after:
                    break
                plain &= token in plain_ones
                single &= len(token) == 1
                if k > i + 1 if single else not plain:
                    mine.update((word, odds) for word in after if (odds := self.telling(word)))
                states = after & begun
            if mine:
                word = max(mine, key=lambda w: (mine[w], w))
                found[word] = mine[word]
        return found

    def _first(self, token: str) -> frozenset[str]:
        """Beginnings of telling words that a part may stand for; none if it tells by itself."""
        head = token[:4]
        # A part of plain letters without repeats begins with its own first letters only.
        if head not in self.begun and len(set(head)) == len(head) and token.isalpha():
            return frozenset()
        states = self._through("", token) & self.begun
        return frozenset() if any(map(self.telling, states)) else states

    def _goes_on(self, token: str, signs: str) -> bool:
        return any(self.through(s, signs) for s in self.first(token))

    def _through(self, state: str, token: str) -> frozenset[str]:
        """Spellings of `state` and a part after it that begin a telling word, or go on after a telling beginning."""
        states = {state}
        for c in token:
            after = set()
            for s in states:
                for letter in SIGNS.get(c, c if c.isalpha() else ""):
                    longer = s + letter
                    if longer in self.begun or (len(s) >= STEMS[0] and any(len(s) >= n and s[:n] in stems for n, stems in self.broken_stems)):
                        after.add(longer)
                    if s.endswith(letter):
                        after.add(s)
                if c in AROUND:
                    after.add(s)
            states = after
            if not states:
                break
        return frozenset(states)


def lexicon(docs: DataFrame, labels: DataFrame, model: np.ndarray, cfg: Settings = Settings()) -> tuple[float, dict[str, float], set[str]]:
    """Log odds of a toxic label to begin with, those that each telling word adds, and ordinary words within those.

    A word's odds come from the numbers of labelled toxic and other documents that have it, once each,
    in restored form. Kept are words more frequent in toxic documents than chance allows, by the
    likelihood-ratio test with its error split among all words tried; the most telling come first,
    `most_words` at most.
    """

    def rows(counts: dict[str, list[int]]) -> pa.RecordBatch:
        columns = [list(counts), [c[0] for c in counts.values()], [c[1] for c in counts.values()]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["word", "clean", "toxic"])

    def task(batches):
        restorer, counts = Restorer(model, cfg), {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in features(restorer.words(unpacked(text))):
                    counts.setdefault(w, [0, 0])[toxic] += 1
                if len(counts) > cfg.held:
                    yield rows(counts)
                    counts = {}
        yield rows(counts)

    marked = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"))
    marked = marked.agg(F.max((F.col("toxic") > 0).cast("int")).alias("is_toxic"))
    # Labels grow with the documents, so texts are brought to them by the same plan at every size.
    texts = packed(docs.select(F.col("doc_id").cast("long").alias("label_id"), "text"), "text")
    apart = F.pmod(F.xxhash64("label_id"), cfg.parts) == 0
    texts = stored(texts.join(marked.hint("merge"), "label_id").select("text", "is_toxic", apart.alias("apart")), "labelled")
    totals = texts.groupBy().agg(*[
        F.coalesce(F.sum(F.when(c, 1)), F.lit(0)) for c in (F.col("is_toxic") == 1, F.col("is_toxic") == 0, F.expr("is_toxic = 1 and not apart"), F.expr("is_toxic = 0 and not apart"))
    ]).first()
    if not totals[0] or not totals[1]:
        return (math.inf if totals[0] else -math.inf), {}, set()
    # So few documents that a part has only one label: all are counted, and no least odds are chosen.
    split = totals[2] > 0 and totals[3] > 0
    n_toxic, n_clean = (totals[2], totals[3]) if split else (totals[0], totals[1])
    counting = texts.where("not apart") if split else texts
    s, share = cfg.smoothing, n_toxic / (n_toxic + n_clean)
    counted = counting.select("text", "is_toxic").mapInArrow(task, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    tried = stored(counted.where(F.col("toxic") >= cfg.least_documents), "words")
    t, c = F.col("toxic"), F.col("clean")
    ratio = t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0)
    odds = F.log((t + s) / (n_toxic + 2 * s)) - F.log((c + s) / (n_clean + 2 * s))
    telling = (
        tried.withColumn("odds", odds).withColumn("ratio", ratio)
        .where((F.col("odds") > 0) & (F.col("ratio") > math.log(max(1, tried.count()) / cfg.error)))
        .orderBy(F.desc("ratio"), "word").limit(cfg.most_words).select("word", "odds")
    )
    odds = {r["word"]: r["odds"] for r in telling.collect()}
    prior = math.log(totals[0] / totals[1])
    if split:
        least = _least_odds(texts.where("apart").select("text", "is_toxic"), model, prior, odds, cfg)
        odds = {w: o for w, o in odds.items() if o >= least}
    # No more of them than telling words have stretches of letters.
    within = {w[i:k] for w in (f.rstrip("*") for f in odds) for i in range(len(w)) for k in range(i + 2, len(w) + 1)}
    stretches = docs.sparkSession.createDataFrame([(w,) for w in sorted(within)], "word string")
    ordinary = {r["word"] for r in tried.join(stretches, "word", "left_semi").collect()}
    return prior, odds, ordinary


def _least_odds(texts: DataFrame, model: np.ndarray, prior: float, odds: dict[str, float], cfg: Settings) -> float:
    """The least odds under which labelled texts, (text, is_toxic), are likeliest; of equal ones the smallest."""

    def task(batches):
        restorer = Restorer(model, cfg)
        tries = [Evidence({w: o for w, o in odds.items() if o >= least}) for least in cfg.least_odds]
        loss = np.zeros(len(tries))
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, parts = restorer.readings(unpacked(text))
                for k, evidence in enumerate(tries):
                    total = prior + sum(evidence.hits(words, parts).values())
                    loss[k] += np.logaddexp(0.0, -total if toxic else total)
        yield pa.RecordBatch.from_arrays([pa.array(cfg.least_odds, pa.float64()), pa.array(loss)], names=["least", "loss"])

    losses = texts.mapInArrow(task, "least double, loss double").groupBy("least").agg(F.round(F.sum("loss"), 6).alias("loss"))
    best = losses.orderBy("loss", "least").first()
    return best["least"] if best else cfg.least_odds[0]


def scores(docs: DataFrame, labels: DataFrame, learn: Column | None = None, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, score, predicted, n_restored): probability of a toxic label, one row per input row.

    `learn` marks the documents whose labels may be used (all by default). The score is the prior odds
    plus the evidence of each telling word present. Null and empty texts have no evidence and get the
    prior; without labels of both kinds every score is 0 or 1 as the labels say, or 0 if there are none.
    A document labelled twice is toxic if any label says so. Repeated rows score alike; other columns
    are ignored. Texts are read for the character counts, for the labelled words and for scoring; only
    counts and labelled texts are shuffled.
    """
    chosen = docs if learn is None else docs.where(F.coalesce(learn, F.lit(False)))
    model = character_model(docs, cfg)
    prior, odds, ordinary = lexicon(chosen, labels, model, cfg)

    def task(batches):
        restorer = Restorer(model, cfg)
        evidence = Evidence(odds, ordinary, cfg.gap_cost)
        for batch in batches:
            score, restored = [], []
            for text in batch.column(1).to_pylist():
                hits = evidence.hits(*restorer.readings(text))
                for w, o in evidence.joined(text or "").items():
                    if not any(h.startswith(w) or w.startswith(h) for h in hits):
                        hits[w] = o
                total = prior + sum(hits.values())
                score.append(1 / (1 + math.exp(-total)) if total > -700 else 0.0)
                plain = set(WORD.findall(text.lower())) if hits else ()
                restored.append(sum(w not in plain for w in hits))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(restored, pa.int64())], names=["doc_id", "score", "n_restored"])

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, score double, n_restored long")
    return made.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
