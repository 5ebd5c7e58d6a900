"""Ranked lexical search that scores each bag of words once.

For a set of items, a document matters only by how often it has each of the items' terms, and by a number
`m` that depends on its length. Texts are read once and become such bags: sorted term numbers with their
frequencies. Documents of the same bag and m form a class: bags meet by a hash and are compared in full.
A class is scored once against all items, keeping for each item the best classes, equal ones by their
first document; the members of these few classes are then listed by doc_id.

Items come in blocks of a bounded vocabulary, which tasks carry; documents are read once for each block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormledger.storage import stored

from .common import pieces

# Bytes of a term are digits, letters and all bytes of characters beyond ASCII; A-Z are lowered.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
# A null doc_id counts as the smallest number there is.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Settings:
    best: int = 10
    # The length part of a score, in percent, and how fast repeats of a term saturate.
    length_percent: int = 75
    saturation: int = 8
    # Items of a block, and bytes of its distinct terms; a single item's terms may be more.
    items: int = 4_096
    vocabulary: int = 1 << 23
    # Terms of a document counted at a time, in bytes, and scores of one piece of classes.
    piece: int = 1 << 20
    scores: int = 1 << 20


def terms(text: bytes, most: int) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists from about `most` bytes each."""
    spaced = text.translate(TERM_BYTES)
    start = 0
    while start < len(spaced):
        end = len(spaced) if len(spaced) - start <= most else spaced.find(b" ", start + most)
        end = len(spaced) if end < 0 else end
        yield spaced[start:end].split()
        start = end


@dataclass
class ItemBlock:
    """Items of one block: ids, each item's term numbers with how often it has them, and the terms by number."""

    ids: list[int | None]
    counts: list[dict[int, int]]
    vocabulary: list[bytes]


def item_blocks(items: DataFrame, cfg: Settings) -> Iterator[ItemBlock]:
    """Items in blocks of bounded vocabulary, one row at a time through the driver; of repeated ids the least text."""
    once = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    once = once.groupBy("item_id").agg(F.min("text").alias("text")).where("text is not null")
    block, numbers, size = ItemBlock([], [], []), {}, 0
    for row in stored(once, "items").toLocalIterator():
        found = Counter(t for some in terms(row["text"].encode(), cfg.piece) for t in some)
        if not found:
            continue
        new = [t for t in found if t not in numbers]
        if block.ids and (len(block.ids) == cfg.items or size + sum(map(len, new)) > cfg.vocabulary):
            yield block
            block, numbers, size = ItemBlock([], [], []), {}, 0
            new = list(found)
        for t in new:
            numbers[t] = len(block.vocabulary)
            block.vocabulary.append(t)
        size += sum(map(len, new))
        block.ids.append(row["item_id"])
        block.counts.append({numbers[t]: n for t, n in found.items()})
    if block.ids:
        yield block


BAGS = "doc_id long, n long, bag binary"


def bags(docs: DataFrame, block: ItemBlock, cfg: Settings) -> DataFrame:
    """(doc_id, n, bag): all terms of each document with any, and the block's terms in it as (number, frequency) pairs."""
    vocabulary = block.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            for piece in pieces(batch, "text", cfg.piece):
                n, made = [], []
                for text in piece.column("text").cast(pa.binary()).to_pylist():
                    total, counts = 0, Counter()
                    for some in terms(text, cfg.piece):
                        total += len(some)
                        counts.update(some)
                    pairs = np.array([(numbers[t], c) for t, c in counts.items() if t in numbers], dtype=np.int64).reshape(-1, 2)
                    n.append(total)
                    made.append(pairs[np.argsort(pairs[:, 0])].astype("<i4").tobytes())
                columns = [piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "bag"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.where("text is not null").mapInArrow(run, BAGS).where("n > 0")


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a batch of bags, and the row each belongs to."""
    held = batch.column("bag")
    sizes = pa.compute.binary_length(held).to_numpy(zero_copy_only=False) // 8
    pairs = np.frombuffer(b"".join(held.to_pylist()), dtype="<i4").reshape(-1, 2)
    return pairs, np.repeat(np.arange(len(sizes)), sizes)


def document_counts(held: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents have each of the block's terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_pairs(batch)[0][:, 0], minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["term", "df"])

    found = np.zeros(n_terms, dtype=np.int64)
    counted = held.select("bag").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in counted.collect():  # one row per term of the block
        found[row["term"]] = row["df"]
    return found


def weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


class Scorer:
    """Scores of bags against the items of a block, by the items that each term is in."""

    def __init__(self, block: ItemBlock, weights: list[int], cfg: Settings):
        self.cfg, self.n_items = cfg, len(block.ids)
        entries = sorted((t, i, weights[t] * c) for i, counts in enumerate(block.counts) for t, c in counts.items())
        self.item = np.array([e[1] for e in entries], dtype=np.int64)
        self.worth = np.array([e[2] for e in entries], dtype=np.int64)
        self.start = np.searchsorted(np.array([e[0] for e in entries]), np.arange(len(weights) + 1))
        # A term adds less than 1,000,000 times its weight. Sums below 2^53 are exact in doubles.
        most = max((sum(weights[t] * c for t, c in counts.items()) for counts in block.counts), default=0)
        self.doubles = most * 1_000_000 < 1 << 53

    def scores(self, batch: pa.RecordBatch) -> np.ndarray:
        """Rows by items."""
        pairs, row = _pairs(batch)
        term, tf = pairs[:, 0], pairs[:, 1].astype(np.int64)
        m = batch.column("m").to_numpy()
        part = 1_000_000_000 * tf // (1000 * tf + self.cfg.saturation * m[row])
        out = np.zeros(batch.num_rows * self.n_items, dtype=np.int64)
        sizes = self.start[term + 1] - self.start[term]
        ends = np.cumsum(sizes)
        at = 0
        # As many pairs at a time as make about `scores` products.
        while at < len(pairs):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + self.cfg.scores, "right")))
            some = sizes[at:stop]
            place = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some) + np.repeat(self.start[term[at:stop]], some)
            cell = np.repeat(row[at:stop], some) * self.n_items + self.item[place]
            value = np.repeat(part[at:stop], some) * self.worth[place]
            if self.doubles:
                first, last = row[at] * self.n_items, (row[stop - 1] + 1) * self.n_items
                out[first:last] += np.bincount(cell - first, value, minlength=last - first).astype(np.int64)
            else:
                np.add.at(out, cell, value)
            at = stop
        return out.reshape(batch.num_rows, self.n_items)


FOUND = "item int, score long, first long, h long, m long, bag binary"


def best_classes(classes: DataFrame, block: ItemBlock, weights: list[int], cfg: Settings) -> DataFrame:
    """(item, score, first, h, m, bag): for each item the best classes of every task, `best` of them at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(block, weights, cfg)
        n, k = scorer.n_items, cfg.best
        # The best so far: item, score, first document, and where `rows` has the class.
        item, score, first, index = (np.zeros(0, dtype=np.int64) for _ in range(4))
        rows: list[tuple] = []
        least = np.ones(n, dtype=np.int64)
        for batch in batches:
            step = max(1, cfg.scores // n)
            for whole in pieces(batch, "bag", cfg.piece):
                for at in range(0, whole.num_rows, step):
                    some = whole.slice(at, step)
                    found = scorer.scores(some)
                    r, i = np.nonzero(found >= least)
                    if not len(r):
                        continue
                    firsts = some.column("first").to_numpy()
                    new, back = np.unique(r, return_inverse=True)
                    held = some.take(pa.array(new))
                    base = len(rows)
                    rows.extend(zip(*(held.column(c).to_pylist() for c in ("h", "m", "bag"))))
                    item, score = np.concatenate([item, i]), np.concatenate([score, found[r, i]])
                    first, index = np.concatenate([first, firsts[r]]), np.concatenate([index, base + back])
                    # The best of each item so far; what falls behind them is let go.
                    order = np.lexsort((first, -score, item))
                    item, score, first, index = item[order], score[order], first[order], index[order]
                    top = np.arange(len(item)) - np.searchsorted(item, item) < k
                    item, score, first, index = item[top], score[top], first[top], index[top]
                    full = np.flatnonzero(np.bincount(item, minlength=n) == k)
                    least[full] = score[np.searchsorted(item, full, "right") - 1]
                    used, index = np.unique(index, return_inverse=True)
                    rows = [rows[u] for u in used]
        if len(item):
            kept = [rows[x] for x in index]
            columns = [item.astype(np.int32), score, first, *zip(*kept)]
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["item", "score", "first", "h", "m", "bag"])

    return classes.select("h", "m", "bag", "first").mapInArrow(run, FOUND)


def _first(rows: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(item_id, rank, doc_id, score): the `best` documents of each item with a score above 0, equal ones by doc_id.

    Terms are runs of digits, letters and characters beyond ASCII; a null text has none. Every row is a
    document, also rows that repeat an id; a null doc_id comes before all others. Items are told by their
    ids, null among them; of rows that repeat one the least text counts. An item without terms, or whose
    terms no document has, gives no row. Empty tables give an empty result; other columns are ignored.
    """
    spark, found = docs.sparkSession, []
    for block in item_blocks(items, cfg):
        held = stored(bags(docs, block, cfg), "bags")
        totals = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
        weights = [weight(totals["n"], int(df)) for df in document_counts(held, len(block.vocabulary))]
        rest, part = 100 - cfg.length_percent, cfg.length_percent * totals["n"]
        # As decimals the product can't overflow, whatever the sizes are.
        m = F.expr(f"{rest} + cast({part} as decimal(20, 0)) * n div {max(1, totals['l'])}")
        keyed = held.where("length(bag) > 0").select("doc_id", F.xxhash64("bag").alias("h"), m.alias("m"), "bag")
        classes = keyed.groupBy("h", "m", "bag").agg(F.min("doc_id").alias("first"))
        order = [F.desc("score"), F.col("first")]
        top = stored(_first(best_classes(classes, block, weights, cfg), "item", order, cfg.best).drop("rank"), "classes")
        # Members of the classes found: met by hash, told apart by the bag, and no more than can be ranked.
        members = keyed.join(top.select("h", "m").distinct(), ["h", "m"], "left_semi")
        members = members.withColumn("place", F.row_number().over(Window.partitionBy("h", "m", "bag").orderBy("doc_id"))).where(F.col("place") <= cfg.best)
        listed = top.select("item", "score", "h", "m", "bag").join(members, ["h", "m", "bag"])
        ranks = _first(listed, "item", [F.desc("score"), F.col("doc_id"), F.col("place")], cfg.best)
        names = spark.createDataFrame([(i, x) for i, x in enumerate(block.ids)], "item int, item_id long")
        found.append(stored(ranks.select("item", "rank", "doc_id", "score"), "ranks").join(names, "item"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.select("item_id", F.col("rank").cast("int").alias("rank"), F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")
