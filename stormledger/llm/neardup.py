"""Near-duplicate groups by bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct five-word windows; the k smallest are its sketch.
Documents with equal sets form a class at once. For the rest:

1. Retained values are inverted into lists of classes. Two sets of the wanted similarity share a good
   part of their sketches, so they also meet in the lists of the rarest values of each; common values,
   from passages that many documents share, are left to them.
2. Of the full sets of these classes, the windows that any other has are counted. They bound the size of
   every intersection, and thus the sizes that a partner can have; a class that can have none goes.
3. Within each list a few pivots are paired with every member: the one that shares most, the smallest,
   and others. The sketch of the union, which two sketches give, estimates the similarity of a pair;
   what is clearly below the bound goes, the rest is verified on full sets and joined to components.
4. Members of one list that are still in different components meet new pivots for another turn.
5. What is left is decided by differences. Two members x and y of a list differ in as many windows as their
   differences from the list's pivot do, and similar ones must share a part of these; so they share one of
   the rarest windows by which each differs from the pivot, as many as that part leaves room for. Copies
   that were changed in different places share none, however alike they are, and a list is never expanded
   into its pairs. Where two differences are too small to matter, both are linked without a look at them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormledger.storage import stored

from . import bytehash as B
from .common import mapped, pieces

PIECE = 1 << 18


@dataclass(frozen=True)
class Settings:
    words: int = 5
    # Similarity bound in percent of the union.
    percent: int = 75
    # Values in a sketch. Two sets at the bound share about 0.75 * k of them (standard deviation 3.5 at 64).
    k: int = 64
    # Pairs whose estimate is below are not verified: over six standard deviations under the bound.
    least_percent: int = 40
    # Pivots for each list and turn, and turns before what is left is decided by differences from a pivot.
    pivots: int = 4
    turns: int = 2
    # Lists up to this length have no more pairs than pivots would make, and are paired directly.
    short: int = 8
    # Sizes, and weights of differences, within this ratio fall into one bucket when pairs are sought by them.
    bucket: float = 1.05
    weights: float = 1.25
    # Earlier windows that a row sent to a meeting knows of. Pairs that meet more than once for that are counted once.
    before: int = 8


def _sets(batch: pa.RecordBatch, words: int):
    """Distinct window hashes of each text of a batch, as (texts, values sorted by text and value, bounds)."""
    for piece in pieces(batch, "text", PIECE):
        data, at = B.buffers(piece.column("text"))
        data = B.LOWER[data]
        found = B.find_words(data, at, B.IS_BLANK[data])
        hashes = B.spans(B.running(data), found.starts, found.ends)
        value, owner = B.windows(hashes, found.first, words)
        value = value.view(np.int64)
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        value, owner = value[new], owner[new]
        yield piece, value, np.searchsorted(owner, np.arange(piece.num_rows + 1))


def _lists(value: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """An Arrow list column of value[start:end]."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes) + np.repeat(starts, sizes)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[place]))


def sketches(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sketch): two fingerprints of the whole set and its k smallest values."""

    def task(batch: pa.RecordBatch):
        for piece, value, bounds in _sets(batch, cfg.words):
            a, b = (
                np.concatenate([[np.uint64(0)], np.cumsum(B.mix(value.view(np.uint64) ^ np.uint64(seed)))])
                for seed in (0x1234567, 0x89ABCDEF01)
            )
            starts, ends = bounds[:-1], bounds[1:]
            yield {
                "doc_id": piece.column("doc_id"),
                "n_shingles": ends - starts,
                "set_a": (a[ends] - a[starts]).view(np.int64),
                "set_b": (b[ends] - b[starts]).view(np.int64),
                "sketch": _lists(value, starts, np.minimum(ends, starts + cfg.k)),
            }

    schema = "doc_id long, n_shingles long, set_a long, set_b long, sketch array<long>"
    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), task, schema)


def full_sets(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(id, items): all distinct window hashes of each document."""

    def task(batch: pa.RecordBatch):
        for piece, value, bounds in _sets(batch, cfg.words):
            yield {"id": piece.column("id"), "items": _lists(value, bounds[:-1], bounds[1:])}

    return mapped(docs.select("id", "text"), task, "id long, items array<long>")


def indexed(reps: DataFrame, cfg: Settings) -> DataFrame:
    """(value, rep, n, weight): each class, of n windows, in the lists of its rarest values, as far as another class may be there too."""
    rows = reps.select("rep", F.col("n_shingles").alias("total"), F.explode("sketch").alias("value"), F.size("sketch").alias("size"))
    shared = rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = rows.join(shared, "value")
    order = Window.partitionBy("rep").orderBy("n", "value")
    per = held.withColumn("place", F.row_number().over(order)).withColumn(
        "alone", F.col("size") - F.count(F.lit(1)).over(Window.partitionBy("rep"))
    ).withColumn("weight", F.sum("n").over(Window.partitionBy("rep")))
    # A partner shares at least `needed` of a sketch, hence one of the first size - needed + 1 values.
    needed = F.ceil(F.col("size") * cfg.least_percent / 100)
    chosen = per.where(F.col("alone") + F.col("place") <= F.col("size") - needed + 1)
    return chosen.select("value", "rep", F.col("total").alias("n"), "weight")


def _mixed(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists whose members are not yet all in one component, with each member's component."""
    now = stored(lists.join(labels, "rep"), "lists")
    several = now.groupBy("value").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
    return stored(now.join(several.select("value"), "value", "left_semi"), "mixed_lists")


def supported(lists: DataFrame, sources: DataFrame, cfg: Settings) -> DataFrame:
    """The lists, with the greatest size `most` that a partner of each member may have.

    With s windows that any other set has, a partner of m windows has a similarity of s / (n + m - s) at
    most. Members whose partners would have to be too small for them are left out.
    """
    items = sources.select(F.col("id").alias("rep"), F.explode("items").alias("item"))
    several = items.groupBy("item").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    shared = items.join(several, "item", "left_semi").groupBy("rep").agg(F.count(F.lit(1)).alias("s"))
    most = F.floor((100 + cfg.percent) * F.col("s") / cfg.percent) - F.col("n")
    bounded = lists.join(shared, "rep").withColumn("most", most.cast("long"))
    return bounded.where(100 * F.col("most") >= cfg.percent * F.col("n")).drop("s")


def _pivot_pairs(lists: DataFrame, turn: int, cfg: Settings) -> DataFrame:
    """(a, b): every member of a list with its pivots of another component.

    A pivot is the member that one of several orders puts first: the one with the most common values and
    the smallest in the first turn, else the smallest by a hash. Lists with common members tend to have
    common pivots.
    """
    first = turn * cfg.pivots
    orders = [F.xxhash64(F.lit(k), F.col("rep")) for k in range(first, first + cfg.pivots)]
    if turn == 0:
        orders[:2] = [-F.col("weight"), F.col("rep")]
    member = ["rep", "component", "n", "most"]
    pivots = lists.groupBy("value").agg(*[F.min(F.struct(o.alias("o"), *member)).alias(f"p{k}") for k, o in enumerate(orders)])
    each = F.array_distinct(F.array(*[F.struct(*[F.col(f"p{k}.{m}") for m in member]) for k in range(len(orders))]))
    met = lists.join(pivots.select("value", F.explode(each).alias("p")), "value")
    fit = (F.col("n") <= F.col("p.most")) & (F.col("p.n") <= F.col("most"))
    met = met.where((F.col("component") != F.col("p.component")) & fit)
    return met.select(F.least("rep", "p.rep").alias("a"), F.greatest("rep", "p.rep").alias("b")).distinct()


def _sides(lists: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """Members in the bucket of their size, and in those of the sizes that a partner no larger than they may have."""

    def bucket(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) / F.log(F.lit(cfg.bucket))).cast("int")

    least = F.greatest(F.ceil(F.col("n") * cfg.percent / 100), F.lit(1))
    sought = lists.withColumn("bucket", F.explode(F.sequence(bucket(least), bucket(F.least("n", "most")))))
    return lists.withColumn("bucket", bucket(F.col("n"))), sought


def _cross_pairs(lists: DataFrame, cfg: Settings) -> DataFrame:
    """(a, b): members of one list, in different components, whose sizes allow a link."""
    values = lists.groupBy("rep").agg(F.collect_set("value").alias("values"))
    own, sought = _sides(lists.join(values, "rep"), cfg)
    other = own.select(
        "value", "bucket", F.col("rep").alias("b"), F.col("component").alias("other"), F.col("n").alias("m"),
        F.col("most").alias("most_b"), F.col("values").alias("values_b"),
    )
    fit = (F.col("n") <= F.col("most_b")) & (F.col("m") <= F.col("most")) & (F.col("component") != F.col("other"))
    once = (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("b") < F.col("rep")))
    # Of the lists that have both, the one with the smallest value makes the pair.
    here = F.array_min(F.array_intersect("values", "values_b")) == F.col("value")
    met = sought.join(other, ["value", "bucket"]).where(once & fit & here)
    return met.select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct()


def _meetings(rows: DataFrame, member: list[str], side: str, cfg: Settings) -> DataFrame:
    """(pivot, theirs, item, side): a row for each window a member has room for, with the few `before` it in its order.

    Rows are of one width however long a difference is: all its windows in each row would be their square.
    """
    mine = F.transform(F.filter("places", lambda p: p["place"] <= F.col("room")), lambda p: p["item"])
    each = rows.withColumn("mine", mine).select("pivot", "theirs", *member, "mine", F.posexplode("mine").alias("at", "item"))
    before = F.slice("mine", F.greatest(F.col("at") - cfg.before + 1, F.lit(1)), F.least(F.col("at"), F.lit(cfg.before)))
    return each.select("pivot", "theirs", "item", F.struct(*member, before.alias("before")).alias(side))


def _by_difference(lists: DataFrame, sources: DataFrame, cfg: Settings) -> DataFrame:
    """Links (a, b) between members of one list in different components: enough of them to join all that belong together.

    Of a member x of n windows, let e be the number of windows in its difference from the pivot and
    W = (100 + percent) * e - (100 - percent) * n. Then x and y are similar if and only if their differences
    share (W_x + W_y) / (2 * (100 + percent)) windows or more.
    """
    up, down = 100 + cfg.percent, 100 - cfg.percent
    pivots = lists.groupBy("value").agg(F.min(F.struct(-F.col("weight"), "rep"))["rep"].alias("pivot"))
    members = stored(lists.join(pivots, "value").select("pivot", "rep", "component", "n", "most").distinct(), "members")
    both = members.join(sources.toDF("rep", "xs"), "rep").join(sources.toDF("pivot", "ps"), "pivot")
    apart = F.concat(F.array_except("xs", "ps"), F.array_except("ps", "xs"))
    far = both.select("pivot", "rep", "component", "n", "most", apart.alias("items")).withColumn("e", F.size("items"))
    w = (up * F.col("e") - down * F.col("n")).cast("long")
    far = far.withColumn("w", w).withColumn(
        "bucket", F.when(w <= 0, F.lit(-1)).otherwise(F.floor(F.log(F.greatest(w, F.lit(1))) / F.log(F.lit(cfg.weights))).cast("int"))
    )
    far = stored(far, "differences")
    # Whoever is surely linked with any member is so with the one of least W.
    least = far.groupBy("pivot").agg(F.min(F.struct("w", "rep")).alias("l"))
    sure = far.join(least, "pivot").where((F.col("w") + F.col("l.w") <= 0) & (F.col("rep") != F.col("l.rep")))
    sure = sure.select(F.least("rep", "l.rep").alias("a"), F.greatest("rep", "l.rep").alias("b")).distinct()

    def room(needed: Column) -> Column:
        return F.col("e") - F.greatest(F.ceil(needed), F.lit(1)) + 1

    # The member of smaller W is found by the other one, in each bucket of smaller W with the room that it leaves.
    held = far.withColumn("room", room(F.col("w") / up))
    buckets = far.groupBy("pivot", "bucket").agg(F.min("w").alias("w_least")).withColumnRenamed("bucket", "theirs")
    seeking = far.drop("items").join(buckets, "pivot").where("theirs <= bucket")
    seeking = seeking.withColumn("room", room((F.col("w") + F.col("w_least")) / (2 * up))).where("room > 0")
    widest = seeking.groupBy("pivot", "rep").agg(F.max("room").alias("room")).union(held.select("pivot", "rep", "room"))
    widest = widest.groupBy("pivot", "rep").agg(F.max("room").alias("widest")).where("widest > 0")
    each = far.join(widest, ["pivot", "rep"]).select("pivot", "rep", "widest", F.explode("items").alias("item"))
    shared = each.groupBy("pivot", "item").agg(F.count(F.lit(1)).alias("holders"))
    order = Window.partitionBy("pivot", "rep").orderBy("holders", "item")
    placed = each.join(shared, ["pivot", "item"]).withColumn("place", F.row_number().over(order))
    # Windows that no other has take room but are no places to meet.
    placed = placed.where("place <= widest and holders > 1").groupBy("pivot", "rep").agg(F.array_sort(F.collect_list(F.struct("place", "item"))).alias("places"))
    placed = stored(placed, "places")
    member = ["rep", "component", "n", "most", "w"]
    own = held.select("pivot", *member, "room", F.col("bucket").alias("theirs"))
    own = _meetings(placed.join(own, ["pivot", "rep"]), member, "y", cfg)
    sought = _meetings(placed.join(seeking.select("pivot", *member, "room", "theirs"), ["pivot", "rep"]), member, "x", cfg)
    once = (F.col("y.w") < F.col("x.w")) | ((F.col("y.w") == F.col("x.w")) & (F.col("y.rep") < F.col("x.rep")))
    fit = (F.col("x.n") <= F.col("y.most")) & (F.col("y.n") <= F.col("x.most")) & (F.col("x.component") != F.col("y.component"))
    # Nothing both have stands before the first window they meet at, so that one always makes the pair.
    here = ~F.arrays_overlap("x.before", "y.before")
    met = sought.join(own, ["pivot", "item", "theirs"]).where(once & fit & here).groupBy("x.rep", "y.rep").agg(F.min("pivot").alias("pivot"))
    pairs = stored(met.toDF("x", "y", "pivot"), "pairs")
    # Decided on the differences alone, which are shorter than the sets.
    mine = far.select("pivot", F.col("rep").alias("x"), F.col("w").alias("wx"), F.col("items").alias("xs"))
    theirs = far.select("pivot", F.col("rep").alias("y"), F.col("w").alias("wy"), F.col("items").alias("ys"))
    both = pairs.join(mine, ["pivot", "x"]).join(theirs, ["pivot", "y"])
    alike = both.where(2 * up * F.size(F.array_intersect("xs", "ys")) >= F.col("wx") + F.col("wy"))
    return sure.union(alike.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def union_estimate(x: Column, y: Column, k: int) -> Column:
    """Percent of the k smallest values of the union that both sketches hold."""
    both = F.slice(F.array_sort(F.array_union(x, y)), 1, k)
    return 100 * F.size(F.array_intersect(F.array_intersect(x, y), both)) / F.size(both)


def verified(pairs: DataFrame, reps: DataFrame, sources: DataFrame, cfg: Settings) -> DataFrame:
    """(a, b) of the pairs whose full sets are similar enough."""
    bound = cfg.percent
    sketch = reps.select("rep", "sketch")
    near = (
        pairs.join(sketch.toDF("a", "sa"), "a").join(sketch.toDF("b", "sb"), "b")
        .where(union_estimate(F.col("sa"), F.col("sb"), cfg.k) >= cfg.least_percent)
        .select("a", "b").distinct()
    )
    both = near.join(sources.toDF("a", "xs"), "a").join(sources.toDF("b", "ys"), "b")
    counted = both.select("a", "b", F.size("xs").alias("na"), F.size("ys").alias("nb"), F.size(F.array_intersect("xs", "ys")).alias("common"))
    return counted.where(100 * F.col("common") >= bound * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(rep, component): the smallest node reachable over `edges` (a, b) from each of `nodes` (rep).

    Every round passes the smallest label on to neighbours and then follows labels to their own label,
    which halves the distance left. Rounds are stored, so lost executors cost one round at most.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = nodes.select("rep", F.col("rep").alias("component"))
    while True:
        heard = (
            both.join(labels, both["b"] == labels["rep"]).groupBy(both["a"].alias("rep")).agg(F.min("component").alias("heard"))
        )
        told = stored(
            labels.join(heard, "rep", "left").select("rep", F.col("component").alias("was"), F.least("component", "heard").alias("component")),
            "labels",
        )
        jump = told.select(F.col("rep").alias("component"), F.col("component").alias("next"))
        labels = stored(
            told.join(jump, "component", "left").select("rep", "was", F.least("component", "next").alias("component")), "labels"
        )
        if labels.where("was != component").isEmpty():
            return labels.select("rep", "component")
        labels = labels.select("rep", "component")


def near_duplicates(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Texts are lower-cased for A-Z and split at blanks; with fewer than five words the whole sequence is
    the set, without words it is empty and linked with nothing. Documents are linked if
    100 * intersection >= 75 * union of their full sets; the component is named by its smallest doc_id,
    and the document of that id is kept. Rows that repeat an id are one document with each of their
    texts. A null doc_id is one more id, smaller than all others. Other columns are ignored.
    """
    # No id is the smallest number there is, so that can stand for null.
    none = F.lit(-(1 << 63))
    mine = docs.select(F.coalesce(F.col("doc_id").cast("long"), none).alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = stored(sketches(mine, cfg), "sketches")
    key = ["n_shingles", "set_a", "set_b"]
    classes = made.where("n_shingles > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "sketch")).alias("m"))
    reps = stored(classes.select(*key, F.col("m.doc_id").alias("rep"), F.col("m.sketch").alias("sketch")), "classes")
    lists = stored(indexed(reps, cfg), "lists")
    mine_of = made.select("doc_id", *key).join(reps.drop("sketch"), key)
    several = mine_of.groupBy("doc_id").agg(F.collect_set("rep").alias("reps")).where("size(reps) > 1")
    edges = stored(several.select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")).where("a < b"), "edges")
    nodes = stored(lists.select("rep").union(edges.select("a")).union(edges.select("b")).distinct(), "nodes")
    texts = mine.join(nodes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sources = stored(full_sets(texts.select(F.col("doc_id").alias("id"), "text"), cfg), "sets")

    lists = stored(supported(lists, sources, cfg), "supported_lists")
    labels = components(edges, nodes)
    for turn in range(cfg.turns + 1):
        mixed = _mixed(lists, labels)
        if mixed.isEmpty():
            break
        if turn < cfg.turns:
            pairs = _pivot_pairs(mixed, turn, cfg)
        else:
            length = mixed.groupBy("value").agg(F.count(F.lit(1)).alias("length"))
            short = mixed.join(length.where(F.col("length") <= cfg.short).select("value"), "value", "left_semi")
            long = mixed.join(length.where(F.col("length") > cfg.short).select("value"), "value", "left_semi")
            edges = edges.union(_by_difference(long, sources, cfg))
            pairs = _cross_pairs(short, cfg)
        edges = stored(edges.union(verified(stored(pairs, "pairs"), reps, sources, cfg)).distinct(), "edges")
        labels = components(edges, nodes)

    found = mine_of.join(labels, "rep", "left").select(
        "doc_id", *key, F.coalesce("component", "rep").alias("component")
    ).distinct()
    each = made.select("doc_id", *key).join(found, ["doc_id", *key], "left")
    component = F.coalesce("component", "doc_id")
    return each.select(
        F.nullif("doc_id", none).alias("doc_id"), "n_shingles", F.nullif(component, none).alias("component_id"),
        (component == F.col("doc_id")).alias("kept"),
    )


def deduplicated(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The documents of each group's smallest doc_id, with all their columns; texts without words stay."""
    gone = near_duplicates(docs, cfg).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
