"""Hard negatives by exact inner products with coordinate pruning.

An anchor's positives are its best rows of the same label; a hard negative is a row of another label whose
score lies a little below a positive's. Both are searches for large inner products, done in two steps:

1. Rows are put into buckets of like length (a bucket's lengths differ by a tenth at most), cut into blocks
   of bounded size. The product of two lengths bounds a score, so an anchor skips all buckets that are too
   short for the least score it still needs.
2. Within a block the rows' directions are held as coordinate lists, sorted. A needed score bounds the angle
   between anchor and row, and so the values that a row may have in each coordinate. For the anchor's
   focus coordinates, those with its largest values, these ranges are cut out of the sorted lists; only
   rows in all of them are multiplied. Where nearly all rows are in range, the ranges are not intersected.

The scores an anchor needs come from a first pass over one block each. Products are of whole numbers and exact.
Anchors and rows meet in a grid of blocks, by an equality join on the cells of that grid: a task holds one
block of anchors and one of rows, whatever the number of either.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormledger.storage import stored


@dataclass(frozen=True)
class Settings:
    # Components are multiplied by this and rounded down.
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    # A negative's score lies between these parts of its positive's, in percent.
    least_percent: int = 50
    most_percent: int = 95
    # Numbers in a block of rows and in one of anchors: 8,192 and 1,024 vectors of 64 components.
    rows: int = 1 << 19
    anchors: int = 1 << 16
    # Greatest ratio of two lengths in one bucket.
    ratio: float = 1.1
    # Coordinates whose ranges are intersected, and the part of a block, in percent, beyond which a range prunes nothing.
    focus: int = 4
    prunes_percent: int = 60


# Whole numbers up to here are exact as doubles; beyond, Python's own are used.
EXACT = float(1 << 53)
FURTHEST = (1 << 62) - 1
# Components beyond count as this much, so that no length overflows.
MOST = 1e140


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products of whole-numbered vectors, exact; beyond 62 bits the largest or smallest number of 62 bits."""
    with np.errstate(over="ignore"):
        most = np.sqrt((anchors * anchors).sum(axis=1).max(initial=0.0)) * np.sqrt((rows * rows).sum(axis=1).max(initial=0.0))
    if most < EXACT / 2:
        return (anchors @ rows.T).astype(np.int64)
    left, right = (np.array([[int(x) for x in v] for v in m], dtype=object).reshape(m.shape) for m in (anchors, rows))
    return np.clip(left @ right.T, -FURTHEST, FURTHEST).astype(np.int64)


class Block:
    """Rows of like length: their directions, and coordinate lists sorted when first needed."""

    def __init__(self, vectors: np.ndarray, lengths: np.ndarray):
        self.vectors, self.lengths = vectors, lengths
        self.longest = lengths.max(initial=0.0)
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows' values in one coordinate of their directions, ascending, and the rows they belong to."""
        if f not in self._lists:
            values = self.vectors[:, f] / np.maximum(self.lengths, 1e-300)
            order = np.argsort(values, kind="stable")
            self._lists[f] = values[order], order
        return self._lists[f]

    def feasible(self, anchor: np.ndarray, length: float, needed: float, cfg: Settings) -> np.ndarray | None:
        """The rows that may score `needed` or more with an anchor; None for all of them."""
        if needed <= 0:
            return None
        cosine = needed / (length * self.longest) if length * self.longest > 0 else 2.0
        # Lengths and angles are rounded, so a little more than the bound is let through.
        if cosine > 1 + 1e-9:
            return np.zeros(0, dtype=np.int64)
        angle = np.arccos(min(1.0, cosine)) + 1e-6
        direction = anchor / length
        found = None
        for f in np.argsort(-np.abs(direction), kind="stable")[: cfg.focus]:
            own = np.arccos(np.clip(direction[f], -1.0, 1.0))
            least, most = np.cos(min(np.pi, own + angle)), np.cos(max(0.0, own - angle))
            values, order = self.coordinate(int(f))
            start, end = np.searchsorted(values, least - 1e-9, "left"), np.searchsorted(values, most + 1e-9, "right")
            if 100 * (end - start) > cfg.prunes_percent * len(values):
                continue
            inside = np.zeros(len(values), dtype=bool)
            inside[order[start:end]] = True
            found = inside if found is None else found & inside
        return None if found is None else np.flatnonzero(found)

    def scores(self, anchors: np.ndarray, lengths: np.ndarray, needed: np.ndarray, cfg: Settings):
        """(anchor, rows or None for all, their scores), for each anchor with any rows left."""
        left, whole = [], []
        for k in range(len(anchors)):
            rows = self.feasible(anchors[k], lengths[k], needed[k], cfg)
            if rows is None:
                whole.append(k)
            elif len(rows):
                left.append((k, rows))
        # A few anchors at a time, so that the table of scores stays small.
        for at in range(0, len(whole), 64):
            some = whole[at : at + 64]
            for k, row in zip(some, products(anchors[some], self.vectors)):
                yield k, None, row
        for k, rows in left:
            yield k, rows, products(anchors[k : k + 1], self.vectors[rows])[0]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def vectors(table: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(vec_id, label, vec, dim, length, band): the rows that take part, one for each id.

    Left out are rows without id, label or vector, and those with a component that is null or not finite.
    Of rows that repeat an id the least by label, then by vector, takes part. `vec` holds whole numbers.
    """
    def whole(x: Column) -> Column:
        # Far beyond 64 bits a double is a whole number already, and floor would saturate.
        big = F.greatest(F.lit(-MOST), F.least(F.lit(MOST), x.cast("double"))) * F.lit(float(cfg.scale))
        return F.when(F.abs(big) < F.lit(EXACT), F.floor(big).cast("double")).otherwise(big)

    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.where("vec_id is not null and label is not null and embedding is not null").where(~bad)
    rows = rows.select("vec_id", F.struct("label", F.transform("embedding", whole).alias("vec")).alias("row"))
    once = rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vec")
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    made = once.withColumn("dim", F.size("vec")).withColumn("length", F.sqrt(square))
    return made.withColumn("band", F.coalesce(F.floor(F.log(F.nullif("length", F.lit(0.0))) / F.log(F.lit(cfg.ratio))).cast("int"), F.lit(-1)))


def _blocks(rows: DataFrame, key: list[str], size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the number of their block within `key`, and (key, n_blocks, longest): blocks hold about `size` numbers."""
    parts = F.ceil(F.count(F.lit(1)) * F.greatest(F.first("dim"), F.lit(1)) / size).cast("int")
    counted = stored(rows.groupBy(*key).agg(parts.alias("n_blocks"), F.max("length").alias("longest")), f"{name}_blocks")
    held = rows.join(counted.drop("longest"), key)
    return held.withColumn("block", F.pmod(F.xxhash64("vec_id"), "n_blocks").cast("int")).drop("n_blocks"), counted


def _matrix(table: pa.Table) -> np.ndarray:
    values = pa.concat_arrays([c.flatten() for c in table.column("vec").chunks])
    return values.to_numpy(zero_copy_only=False).reshape(table.num_rows, table.column("dim")[0].as_py())


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


FOUND = "anchor_id long, positive_id long, positive_score long, other_id long, score long"
HELD = ("vec_id", "label", "vec", "length", "dim")


def _search(anchors: DataFrame, rows: DataFrame, cell: list[str], k: int, cfg: Settings, wanted: bool) -> DataFrame:
    """(anchor_id, [positive_id, positive_score,] other_id, score): the k best of each block for each anchor.

    Anchors bring `needed`, the least score that can still matter. With `wanted` they bring their positives
    too, and the k best within the range of each are found; else the k best other rows of the same label.
    """

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        made: dict[str, list[np.ndarray]] = {n: [] for n in ("anchor_id", "positive_id", "positive_score", "other_id", "score")}
        if left.num_rows and right.num_rows:
            ids, labels, own_ids, own_labels = _numbers(right, "vec_id"), _numbers(right, "label"), _numbers(left, "vec_id"), _numbers(left, "label")
            block = Block(_matrix(right), _numbers(right, "length"))
            mine = left.column("positives").to_pylist() if wanted else []
            for a, some, scores in block.scores(_matrix(left), _numbers(left, "length"), _numbers(left, "needed"), cfg):
                theirs, their_labels = (ids, labels) if some is None else (ids[some], labels[some])
                if wanted:
                    other = their_labels != own_labels[a]
                    searches = [(p["id"], p["score"]) for p in mine[a]]
                else:
                    other = (their_labels == own_labels[a]) & (theirs != own_ids[a])
                    searches = [(0, 0)]
                scores, theirs = scores[other], theirs[other]
                for p_id, p in searches:
                    if wanted:
                        near = np.flatnonzero((scores >= -(-cfg.least_percent * p // 100)) & (scores <= cfg.most_percent * p // 100))
                        near = near[_best(scores[near], theirs[near], k)]
                    else:
                        near = _best(scores, theirs, k)
                    for name, values in (("anchor_id", own_ids[a]), ("positive_id", p_id), ("positive_score", p)):
                        made[name].append(np.full(len(near), values, dtype=np.int64))
                    made["other_id"].append(theirs[near])
                    made["score"].append(scores[near])
        return pa.table({n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in made.items()})

    asking = anchors.select(*dict.fromkeys([*cell, *HELD, "needed", *(["positives"] if wanted else [])])).groupBy(*cell)
    return asking.cogroup(rows.select(*dict.fromkeys([*cell, *HELD])).groupBy(*cell)).applyInArrow(task, FOUND)


def _top(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k highest scores of each, equal ones by smaller other_id, with `rank` from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _spread(anchors: DataFrame, blocks: DataFrame, key: list[str]) -> DataFrame:
    """Anchors at every block of `key` whose longest row may reach the score they need."""
    reach = (F.col("needed") <= 0) | (F.col("length") * F.col("longest") * (1 + 1e-9) >= F.col("needed"))
    met = anchors.join(blocks, key).where(reach)
    return met.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).drop("n_blocks", "longest")


def hard_negatives(table: DataFrame, anchor: Column | None = None, cfg: Settings = Settings()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    `table` has vec_id, label and embedding (see `vectors` for rows that take no part); `anchor` is a
    condition on vec_id and label (all rows by default). Positives and negatives are ordered by score, equal
    ones by vec_id. Rows meet rows with as many components only. A positive without a negative in its range
    gives no row, as does one below 0, whose range is empty. Other columns are ignored; an empty table
    gives an empty result. Components beyond 1e140 count as that, scores beyond 62 bits as the largest such number.
    """
    rows = stored(vectors(table, cfg), "vectors")
    marked = rows if anchor is None else rows.where(anchor)

    # Positives: blocks within a label.
    own, own_blocks = _blocks(rows, ["label", "dim", "band"], cfg.rows, "own")
    chosen, groups = _blocks(marked.drop("band"), ["label", "dim"], cfg.anchors, "anchor")
    chosen = stored(chosen.withColumnRenamed("block", "group"), "anchors")
    meeting = own.join(groups.select("label", "dim", F.col("n_blocks").alias("n_groups")), ["label", "dim"])
    meeting = meeting.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1))).drop("n_groups")
    cell = ["label", "dim", "band", "block", "group"]
    # First one block of the label's longest rows for each anchor, which tells what score its k-th best has at least.
    longest = own_blocks.groupBy("label", "dim").agg(F.max("band").alias("band")).withColumn("block", F.lit(0))
    first = chosen.join(longest, ["label", "dim"]).withColumn("needed", F.lit(0.0))
    seeds = _search(first, meeting.join(longest, cell[:-1], "left_semi"), cell, cfg.positives, cfg, False)
    seeds = seeds.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    needed = F.when(F.col("n") == cfg.positives, F.col("least").cast("double")).otherwise(F.lit(0.0))
    sought = chosen.join(stored(seeds, "seeds"), "vec_id", "left").withColumn("needed", needed)
    found = _search(_spread(sought, own_blocks, ["label", "dim"]), meeting, cell, cfg.positives, cfg, False)
    best = stored(_top(found, ["anchor_id"], cfg.positives), "positives")

    # Negatives: blocks over all labels; an anchor needs the least score that is in any positive's range.
    wanted = best.where("score >= 0").groupBy("anchor_id").agg(
        F.collect_list(F.struct(F.col("other_id").alias("id"), "score")).alias("positives"), (F.min("score") * cfg.least_percent / 100).alias("needed")
    )
    asking = chosen.drop("group").join(wanted.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    asking, groups = _blocks(asking, ["dim"], cfg.anchors, "asking")
    asking = asking.withColumnRenamed("block", "group")
    every, blocks = _blocks(rows, ["dim", "band"], cfg.rows, "every")
    meeting = every.join(groups.select("dim", F.col("n_blocks").alias("n_groups")), ["dim"])
    meeting = meeting.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1))).drop("n_groups")
    cell = ["dim", "band", "block", "group"]
    found = _search(_spread(asking, blocks, ["dim"]), meeting, cell, cfg.negatives, cfg, True)
    ranked = _top(found, ["anchor_id", "positive_id"], cfg.negatives)
    return ranked.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
