"""Removal of byte strings that occur more than once, by sorting suffixes.

Every byte covered by a string of `window` bytes that also starts elsewhere is removed. Sorting the
suffixes at all places would move each byte two hundred times, so suffixes are sorted at anchors: the
anchor of a window is the place in its first half where a short hash is smallest, so equal windows have
equal anchors at the same offset. Neighbouring windows share anchors, about one in fifty places is one.

1. Suffixes at anchors are range-partitioned by their leading bytes, at splitters that Spark samples, and
   then by hashes of what every window of the anchor contains (its core) and of all bytes that its
   windows cover (its stretch), and by place, so that a frequent suffix fills several buckets. Buckets
   sort locally, key by key, and compare neighbours; runs that reach a bucket's boundary are compared
   across it. A core that occurs once proves its windows unique. If all stretches of a core are equal,
   all windows repeat.
2. Cores with several stretches are undecided: a copy ends or a word differs nearby. One copy of each
   such stretch is fetched, and the suffixes of its windows are compared the same way within their core.
3. The places of repeating windows are gathered by document and their bytes removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormledger.storage import stored

from . import bytehash as B
from .common import mapped, packed, pieces

PIECE = 1 << 20
CHUNK_ROWS = 1_000
TOP = np.iinfo(np.uint64).max


@dataclass(frozen=True)
class Settings:
    window: int = 200
    # Bytes hashed to choose anchors, and the places among which a window's anchor is the smallest.
    gram: int = 16
    reach: int = 100
    # Undecided stretches of one core that are compared in one task; more are split and compared once more.
    together: int = 4_000

    @property
    def core(self) -> int:
        """Bytes from an anchor on that all its windows contain."""
        return self.window - self.reach + 1


@dataclass
class Anchors:
    """Anchors of a batch of texts: text, place, and first and last window; places count from the text's start."""

    text: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchors(data: np.ndarray, bounds: np.ndarray, sums: np.ndarray, cfg: Settings) -> Anchors:
    n, none = len(data), np.zeros(0, dtype=np.int64)
    starts = np.arange(max(0, n - cfg.window + 1))
    owner = np.searchsorted(bounds, starts, "right") - 1
    inside = starts + cfg.window <= bounds[owner + 1]
    if not inside.any():
        return Anchors(none, none, none, none)
    # The place stands in the low bits of its hash, so the smallest number also tells the leftmost place.
    bits = np.uint64(max(1, int(n).bit_length()))
    value = np.full(-(-n // cfg.reach) * cfg.reach + cfg.reach, TOP, dtype=np.uint64)
    places = np.arange(n - cfg.gram + 1)
    value[: len(places)] = (B.spans(sums, places, places + cfg.gram) >> bits << bits) | places.astype(np.uint64)
    # Smallest of any `reach` values in a row: of the end of one block and the start of the next.
    blocks = value.reshape(-1, cfg.reach)
    to = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts, owner = starts[inside], owner[inside]
    least = np.minimum(since[starts], to[starts + cfg.reach - 1])
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # Windows in a row that share their anchor.
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    tail = np.concatenate([head[1:], [len(starts)]]) - 1
    base = bounds[owner[head]]
    return Anchors(owner[head], place[head] - base, starts[head] - base, starts[tail] - base)


def multikey_order(keys: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order rows by several keys, and for each number of leading keys the run every row is in.

    Rows are divided by the first key; each further key only touches rows that all keys before leave equal.
    """
    order = np.argsort(keys[0], kind="stable")
    runs: list[np.ndarray] = []
    run = np.zeros(len(order), dtype=np.int64)
    for k, key in enumerate(keys):
        if k:
            size = np.bincount(run)
            open_ = np.flatnonzero(size[run] > 1)
            order[open_] = order[open_][np.lexsort((key[order[open_]], run[open_]))]
        ordered = key[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (ordered[1:] != ordered[:-1]) | (run[1:] != run[:-1])
        run = np.cumsum(new) - 1
        runs.append(run)
    return order, runs


ROW = "doc_id long, tag int"


def _rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, text): rows that repeat an id with another text have another tag."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.hash(text).alias("tag"), text.alias("text"))


def _anchor_rows(rows: DataFrame, cfg: Settings) -> DataFrame:
    def task(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch, "text", PIECE):
            data, bounds = B.buffers(piece.column("text"))
            sums = B.running(data)
            found = anchors(data, bounds, sums, cfg)
            if not len(found.at):
                continue
            base = bounds[found.text]
            at, first, last = base + found.at, base + found.first, base + found.last
            lead = np.zeros(len(at), dtype=np.uint64)
            for k in range(8):
                lead = (lead << np.uint64(8)) | data[at + k].astype(np.uint64)
            offsets = ((at - first) * 1024 + (last - first)).astype(np.uint64)
            yield {
                "doc_id": piece.column("doc_id").take(pa.array(found.text)),
                "tag": piece.column("tag").take(pa.array(found.text)),
                # The order of signed numbers is that of the bytes.
                "lead": (lead ^ np.uint64(1 << 63)).view(np.int64),
                "core": B.spans(sums, at, at + cfg.core).view(np.int64),
                "stretch": B.mix(B.spans(sums, first, last + cfg.window) + offsets).view(np.int64),
                "first": found.first,
                "last": found.last,
            }

    return mapped(rows, task, f"{ROW}, lead long, core long, stretch long, first int, last int")


SORTED = f"{ROW}, lead long, core long, stretch long, first int, last int, alike long, leads boolean, alone boolean, mixed boolean, edge boolean"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort a bucket and compare neighbours; unique cores go, unless they lie at the bucket's boundary.

    `alike`: rows with the same stretch; `leads`: the first of them; `alone`, `mixed`: the core occurs
    once, or with several stretches, both as far as this bucket shows. `edge` marks the leading rows of
    the runs at the boundary, which stand for the rows like them.
    """
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    if not table.num_rows:
        return
    columns = {n: table.column(n).to_numpy() for n in ("lead", "core", "stretch")}
    order, (_, core, stretch) = multikey_order([columns["lead"], columns["core"], columns["stretch"]])
    n_core, n_stretch = np.bincount(core), np.bincount(stretch)
    leads = np.concatenate([[True], stretch[1:] != stretch[:-1]])
    mixed = np.bincount(core[leads]) > 1
    edge = (core == 0) | (core == core[-1])
    keep = np.flatnonzero((n_core[core] > 1) | edge)
    edge &= leads
    out = table.take(pa.array(order[keep])).combine_chunks()
    more = {"alike": n_stretch[stretch], "leads": leads, "alone": n_core[core] == 1, "mixed": mixed[core], "edge": edge}
    for name, values in more.items():
        out = out.append_column(name, pa.array(values[keep]))
    yield from out.to_batches(max_chunksize=50_000)


def sorted_anchors(rows: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """Stretches whose windows all repeat (doc_id, tag, first, last), and those to be compared (and core, alike)."""
    made = _anchor_rows(rows, cfg)
    buckets = made.repartitionByRange("lead", "core", "stretch", "doc_id", "first")
    found = stored(buckets.mapInArrow(_compare, SORTED), "suffixes")
    # Runs at boundaries, over all buckets they reach into: at most two cores for each bucket. Rows that
    # are like another in their bucket are settled there.
    edges = found.where("edge")
    across = edges.groupBy("lead", "core").agg(F.sum("alike").alias("n"), (F.min("stretch") != F.max("stretch")).alias("differ"))
    fixed = edges.drop("alone", "mixed").join(across, ["lead", "core"]).select(
        "doc_id", "tag", "core", "first", "last", "alike", "leads", (F.col("n") == 1).alias("alone"), F.col("differ").alias("mixed")
    )
    every = found.where("not edge").select(*fixed.columns).union(fixed).where("not alone")
    sure = every.where("not mixed or alike > 1").select("doc_id", "tag", "first", "last")
    return sure, every.where("mixed and leads").select("doc_id", "tag", "core", "first", "last", "alike")


def _stretches(rows: DataFrame, wanted: DataFrame, cfg: Settings) -> DataFrame:
    """The bytes of each wanted stretch."""
    import zlib

    places = wanted.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("core", "part", "first", "last", "alike")).alias("places"))
    met = packed(rows, "text").join(places, ["doc_id", "tag"])

    def task(batch: pa.RecordBatch) -> Iterator[dict]:
        made: dict[str, list] = {n: [] for n in ("doc_id", "tag", "core", "part", "first", "alike", "data")}
        for doc, tag, small, found in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "tag", "text", "places"))):
            data = zlib.decompress(small)
            made["doc_id"] += [doc] * len(found)
            made["tag"] += [tag] * len(found)
            for n in ("core", "part", "first", "alike"):
                made[n] += [p[n] for p in found]
            made["data"] += [data[p["first"] : p["last"] + cfg.window] for p in found]
            if len(made["data"]) > CHUNK_ROWS:
                yield made
                made = {n: [] for n in made}
        yield made

    return mapped(met, task, f"{ROW}, core long, part int, first int, alike long, data binary")


WINDOWS = f"{ROW}, first int, last int, window long"


def _windows(cfg: Settings):
    """Task: windows of undecided stretches that repeat within their core, as runs.

    Rows come sorted by core and part; whole cores are compared at a time. Windows of a core in several
    parts that found no partner in theirs, and one of each sort that did, are passed on with their hash.
    """

    def compare(docs, tags, cores, parts, firsts, alike, datas):
        lengths = np.array([len(d) for d in datas])
        data = np.frombuffer(b"".join(datas), dtype=np.uint8)
        base = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        counts = lengths - cfg.window + 1
        row = np.repeat(np.arange(len(datas)), counts)
        shift = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = base[row] + shift
        value = B.spans(B.running(data), at, at + cfg.window)
        core, part, many = np.array(cores), np.array(parts), np.array(alike) > 1
        order, (_, _, run) = multikey_order([core[row], part[row], value])
        size = np.bincount(run)
        known = np.bincount(run, weights=many[row][order]) > 0
        again = np.empty(len(row), dtype=bool)
        again[order] = (size[run] > 1) | known[run]
        # Runs of repeating windows of one row; rows that are sure already need none.
        wanted = again & ~many[row]
        start = wanted & np.concatenate([[True], ~wanted[:-1] | (row[1:] != row[:-1])])
        end = wanted & np.concatenate([~wanted[1:] | (row[1:] != row[:-1]), [True]])
        s, e = np.flatnonzero(start), np.flatnonzero(end)
        split = part[row] >= 0
        lead = np.zeros(len(row), dtype=bool)
        lead[order] = np.concatenate([[True], run[1:] != run[:-1]])
        open_ = np.flatnonzero(split & lead)
        first = np.array(firsts)
        rows = np.concatenate([row[s], row[open_]])
        return {
            "doc_id": np.array(docs)[rows],
            "tag": np.array(tags)[rows],
            "first": np.concatenate([(first[row] + shift)[s], (first[row] + shift)[open_]]),
            "last": np.concatenate([(first[row] + shift)[e], (first[row] + shift)[open_]]),
            "window": pa.array(np.concatenate([np.zeros(len(s), np.int64), value[open_].view(np.int64)]), mask=np.arange(len(rows)) < len(s)),
        }

    names = ("doc_id", "tag", "core", "part", "first", "alike", "data")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = compare(*zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns.values(), types)], names=list(columns))

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                if len(held) >= 500 and row[2:4] != held[-1][2:4]:
                    yield made(held)
                    held = []
                held.append(row)
        if held:
            yield made(held)

    return task


def repeating(rows: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, tag, first, last): runs of places where a window starts that also starts elsewhere."""
    sure, undecided = sorted_anchors(rows, cfg)
    undecided = stored(undecided, "undecided")
    hot = undecided.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cfg.together)
    hot = hot.select("core", F.ceil(F.col("n") / cfg.together).cast("int").alias("parts"))
    # Stretches of a frequent core are dealt to parts by a hash; -1 marks cores in one part.
    part = F.when(F.col("parts").isNull(), F.lit(-1)).otherwise(F.pmod(F.hash("doc_id", "first"), F.col("parts")))
    wanted = undecided.join(hot, "core", "left").withColumn("part", part).drop("parts")
    sides = _stretches(rows, wanted, cfg).repartition("core", "part").sortWithinPartitions("core", "part")
    windows = stored(sides.mapInArrow(_windows(cfg), WINDOWS), "windows")
    spread = windows.where("window is not null")
    met = spread.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    more = spread.join(met, "window", "left_semi").drop("window")
    return sure.union(windows.where("window is null").drop("window")).union(more)


def without_repeats(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): what is removed of each text and the bytes that stay, one row per input row.

    Texts are their UTF-8 bytes, null is empty; windows never cross texts. A span is a maximal run of
    removed bytes (start, end). Every copy of a repeating window goes, also the first, and also if the
    copies overlap. Rows that repeat an id and text repeat each other's windows. Texts shorter than a
    window stay as they are. Other columns are ignored; an empty table gives an empty result.
    """
    import zlib

    rows = _rows_of(docs)
    gone = repeating(rows, cfg).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("first", "last")).alias("places"))
    met = packed(rows, "text").join(gone, ["doc_id", "tag"], "left")

    def task(batch: pa.RecordBatch) -> Iterator[dict]:
        made: dict[str, list] = {n: [] for n in ("doc_id", "n_bytes", "spans", "kept")}
        for doc, small, places in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "places"))):
            data = zlib.decompress(small)
            spans: list[list[int]] = []
            for first, last in sorted((p["first"], p["last"] + cfg.window) for p in places or ()):
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], last)
                else:
                    spans.append([first, last])
            ends = [0, *(e for _, e in spans)]
            kept = b"".join(data[a:b] for a, b in zip(ends, [*(s for s, _ in spans), len(data)]))
            row = {"doc_id": doc, "n_bytes": len(data), "spans": [{"start": s, "end": e} for s, e in spans], "kept": kept}
            for name, value in row.items():
                made[name].append(value)
            if len(made["kept"]) > CHUNK_ROWS:
                yield made
                made = {n: [] for n in made}
        yield made

    made = mapped(met, task, "doc_id long, n_bytes long, spans array<struct<start: int, end: int>>, kept binary")
    return made.withColumn("doc_id", F.nullif("doc_id", F.lit(-(1 << 63))))
