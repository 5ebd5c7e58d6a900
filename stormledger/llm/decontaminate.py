"""Benchmark decontamination by templates.

Texts become templates: words in lower case without punctuation, with runs of numbers, units after a
number, and runs of names (capitalised words) replaced by typed placeholders. A capitalised word that opens
a sentence may be a name or not, so every text is read both ways. Windows of a template are hashed and
joined with those of the benchmark, so a question is found although its numbers or names were changed, also
to others of more or fewer words. Matches on one alignment, or on neighbouring ones, are added up, and the
values in the slots are compared: a changed question replaces each value by one other value wherever it
stands, chance agreement does not.

Items that are short or mostly slots can't be told from chance by their templates. A third reading takes
the words as they stand, values and signs included, so such items are found where they stand verbatim.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormledger.storage import stored

from . import bytehash as B
from .common import mapped, pieces

PIECE = 1 << 18
# Units of measure, counted as such after a number only.
UNITS = (
    "percent pct mm cm m km inch inches foot feet yard yards mile miles g kg mg lb lbs pound pounds oz ounce ounces ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years dollar dollars euro euros cent cents usd eur kb mb gb hz khz mhz w kw v degree degrees"
).split()
# Signs after which a sentence begins.
STOPS = np.isin(np.arange(256), [ord(c) for c in ".!?:;"])
# Signs that words are freed of at both ends when they are read as they stand.
EDGE = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\"'()[]{}"])
_BYTES = np.arange(256)
LETTER_OR_DIGIT = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES < 58)) | ((_BYTES >= 65) & (_BYTES < 91)) | ((_BYTES >= 97) & (_BYTES < 123))


@dataclass(frozen=True)
class Settings:
    # Template words in a window; shorter items are one window of all their words.
    window: int = 8
    # Templates of fewer words can't be told from chance; such items are found verbatim only.
    least_words: int = 5
    # Words, as they stand, of the shortest item that is sought verbatim: one or two are no question.
    least_exact: int = 3
    # Plain words that a window must have, in percent of its words.
    least_plain: int = 50
    # Part of an item, in percent, that one alignment must cover, or so many words.
    least_percent: int = 50
    enough_words: int = 25
    # Distinct item values in slots over distinct pairs of values: 1 if every value is replaced consistently.
    least_consistency: float = 0.8
    # The filter that tasks carry has 32 to 64 bits a window of the benchmark, but 2 to this power at most.
    filter_bits: int = 24


@dataclass
class Template:
    """Canonical words of a batch of texts: hash, whether a slot, byte span, and each text's first word."""

    data: np.ndarray
    hashes: np.ndarray
    slot: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def _unit_hashes() -> np.ndarray:
    joined = np.frombuffer("".join(UNITS).encode(), dtype=np.uint8)
    ends = np.cumsum([len(u) for u in UNITS])
    return np.sort(B.spans(B.running(joined), np.concatenate([[0], ends[:-1]]), ends))


UNIT_HASHES = _unit_hashes()
NUMBER, UNIT, NAME = B.mix(np.array([11, 12, 13], dtype=np.uint64))
# Ways to read a text: words that open a sentence as plain words, as names if capitalised, and all words as they stand.
PLAIN, NAMED, VERBATIM = READINGS = (0, 1, 2)
# Alignments that differ by up to two words fall into one band of either kind.
BAND = 4


def read(data: np.ndarray, at: np.ndarray, reading: int) -> Template:
    return verbatim(data, at) if reading == VERBATIM else template(data, at, reading == NAMED)


def verbatim(data: np.ndarray, at: np.ndarray) -> Template:
    """Words as they stand, in lower case and freed of signs at both ends; signs that stand alone are words if others than those."""
    found = B.find_words(data, at, B.IS_BLANK[data])
    index = np.arange(len(data))
    next_kept = np.minimum.accumulate(np.where(EDGE[data], len(data), index)[::-1])[::-1]
    last_kept = np.maximum.accumulate(np.where(EDGE[data], -1, index))
    starts, ends = next_kept[found.starts], last_kept[found.ends - 1] + 1
    real = starts < ends
    starts, ends = starts[real], ends[real]
    first = np.concatenate([[0], np.cumsum(real)])[found.first]
    return Template(data, B.spans(B.running(B.LOWER[data]), starts, ends), np.zeros(len(starts), dtype=bool), starts, ends, first)


def template(data: np.ndarray, at: np.ndarray, named: bool = False) -> Template:
    """Templates of texts; with `named`, capitalised words that open a sentence are names as others are."""
    found = B.find_words(data, at, B.IS_BLANK[data])
    folded = B.LOWER[data]
    # Capital letters of Latin-1 are two bytes of which the second differs by 32.
    second = np.zeros(len(data), dtype=bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded = np.where(second, folded | 0x20, folded).astype(np.uint8)
    kept = LETTER_OR_DIGIT[data]
    place = np.concatenate([[0], np.cumsum(kept)])
    starts, ends = place[found.starts], place[found.ends]
    real = ends > starts
    index = np.flatnonzero(kept)
    # Words of punctuation alone vanish, but may end a sentence.
    before = np.concatenate([[False], STOPS[data[found.ends[:-1] - 1]]]) if len(real) else real
    line = np.concatenate([[0], np.cumsum(data == 10)])
    broken = np.concatenate([[True], line[found.starts[1:]] > line[found.ends[:-1]]]) if len(real) else real
    opens = before | broken
    opens[found.first[:-1][found.first[:-1] < len(opens)]] = True
    # A word opens a sentence if it, or a vanished word just before it, does.
    if not real.all():
        run = np.maximum.accumulate(np.where(opens, np.arange(len(opens)), -1))
        last = np.maximum.accumulate(np.where(real, np.arange(len(real)), -1))
        opens = run > np.concatenate([[-1], last[:-1]])
    opens, raw_starts, raw_ends = opens[real], found.starts[real], found.ends[real]
    starts, ends = starts[real], ends[real]
    hashes = B.spans(B.running(folded[kept]), starts, ends)
    head = data[index[starts]]
    after = data[index[np.minimum(starts + 1, len(index) - 1)]] if len(starts) else head
    long = ends - starts > 1
    wide = (head == 0xC3) & second[np.minimum(index[starts] + 1, len(data) - 1)] if len(starts) else head.astype(bool)
    third = data[index[np.minimum(starts + 2, len(index) - 1)]] if len(starts) else head
    following = np.where(wide, third, after)
    upper = ((head >= 65) & (head < 91)) | wide
    name = upper & long & ~((following >= 65) & (following < 91)) & (named | ~opens)
    number = (head >= 48) & (head < 58)
    previous = np.concatenate([[False], number[:-1]]) if len(number) else number
    first = np.concatenate([[0], np.cumsum(real)])[found.first]
    previous[first[:-1][first[:-1] < len(previous)]] = False
    near = np.minimum(np.searchsorted(UNIT_HASHES, hashes), len(UNIT_HASHES) - 1)
    unit = previous & (UNIT_HASHES[near] == hashes)
    hashes = np.select([number, unit, name], [NUMBER, UNIT, NAME], hashes)
    # A run of numbers or of names is one slot, if no sentence begins inside.
    alone = np.ones(len(hashes), dtype=bool)
    alone[1:] = ~((number[1:] & number[:-1]) | (name[1:] & name[:-1])) | opens[1:]
    alone[first[:-1][first[:-1] < len(alone)]] = True
    kept = np.flatnonzero(alone)
    last = np.concatenate([kept[1:], [len(alone)]])[: len(kept)] - 1
    first = np.concatenate([[0], np.cumsum(alone)])[first]
    return Template(data, hashes[kept], (number | unit | name)[kept], raw_starts[kept], raw_ends[last], first)


def windows(t: Template, size: int, least_plain: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word) of all windows of `size` words with enough plain words among them."""
    n = len(t.hashes)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.full(n - size + 1, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total += t.hashes[k : n - size + 1 + k] * B.WEIGHTS[k]
    owner = np.repeat(np.arange(len(t.first) - 1), np.diff(t.first))
    slots = np.concatenate([[0], np.cumsum(t.slot)])
    plain = size - (slots[size:] - slots[: n - size + 1])
    good = np.flatnonzero((owner[: n - size + 1] == owner[size - 1 :]) & (100 * plain >= least_plain * size))
    return B.mix(total[good]), owner[good], good


def _value(data: np.ndarray) -> str:
    return " ".join(data.tobytes().decode("utf-8", "replace").split()).strip(".,;:!?\"'()[]").lower()


def _rows(t: Template, size: int, hashes: np.ndarray, good: np.ndarray) -> tuple[list[int], list[list[dict]]]:
    """Place in the text, and slots with their raw values, of windows."""
    owner = np.searchsorted(t.first, good, "right") - 1
    values = [
        [
            {"k": int(k), "v": _value(t.data[t.starts[i + k] : t.ends[i + k]])}
            for k in np.flatnonzero(t.slot[i : i + size])
        ]
        for i in good
    ]
    return (good - t.first[owner]).tolist(), values


WINDOW = "id long, reading int, at int, size int, h long, slots array<struct<k: int, v: string>>"


def _windows_of(df: DataFrame, sizes: dict[int, list[int]] | None, bits: np.ndarray | None, cfg: Settings) -> DataFrame:
    """Windows of (id, text) rows in every reading. Without `sizes`, each text's own: the usual one, or all its words if fewer."""

    def task(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch, "text", PIECE):
            data, at = B.buffers(piece.column("text"))
            for reading in READINGS if sizes is None else sorted(sizes):
                least, least_plain = (cfg.least_exact, 0) if reading == VERBATIM else (cfg.least_words, cfg.least_plain)
                t = read(data, at, reading)
                own = np.minimum(np.diff(t.first), cfg.window)
                for size in sizes[reading] if sizes is not None else sorted({int(c) for c in own if c >= least}):
                    h, owner, good = windows(t, size, least_plain)
                    if bits is None:
                        hit = own[owner] == size
                    else:
                        bit = h >> np.uint64(65 - (8 * len(bits)).bit_length())
                        hit = (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    h, owner, good = h[hit], owner[hit], good[hit]
                    if len(h):
                        places, slots = _rows(t, size, h, good)
                        yield {
                            "id": piece.column("id").take(pa.array(owner)), "reading": [reading] * len(h), "at": places,
                            "size": [size] * len(h), "h": h.view(np.int64), "slots": slots,
                        }

    return mapped(df, task, WINDOW)


def _filter(benchmark: DataFrame, cfg: Settings) -> np.ndarray:
    """A bit for every window of the benchmark; no more bits are collected than the filter has."""
    power = min(cfg.filter_bits, max(10, benchmark.count().bit_length() + 5))
    bits = np.zeros(1 << (power - 3), dtype=np.uint8)
    index = F.shiftrightunsigned("h", 64 - power).cast("int").alias("bit")
    found = benchmark.select(index).distinct().toArrow().column(0).to_numpy()
    np.bitwise_or.at(bits, found >> 3, np.left_shift(1, found & 7).astype(np.uint8))
    return bits


def leaks(docs: DataFrame, benchmark: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, n_words, covered, n_slots, kind): a row for each item that a document contains.

    `covered` of the item's `n_words` words match on the best alignment, where a run of names or numbers is
    one word. `kind` is `verbatim` if all slots have the item's values and `reparameterised` if they are
    consistently replaced. Null and empty texts contain nothing; items whose templates have fewer than
    `least_words` words, or too few plain ones, are found as they stand (then without slots), and items of
    fewer than `least_exact` words match nothing. A null id is an id like any other. Rows that repeat a
    document add nothing, items that repeat a text are each reported. Empty tables give an empty result;
    other columns are ignored. Documents are read once and only windows that may be the benchmark's leave
    the task that read them.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).distinct()
    theirs = stored(_windows_of(items, None, None, cfg), "benchmark_windows").dropDuplicates(["id", "reading", "at", "size", "h"])
    sizes: dict[int, list[int]] = {}
    for r in theirs.select("reading", "size").distinct().sort("reading", "size").collect():  # sizes up to the usual one
        sizes.setdefault(r["reading"], []).append(r["size"])
    mine = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    ours = _windows_of(mine, sizes, _filter(theirs, cfg), cfg)
    lengths = theirs.groupBy(F.col("id").alias("of_item"), F.col("reading").alias("of_reading")).agg(F.max(F.col("at") + F.col("size")).alias("n_words"))
    item = theirs.select(F.col("id").alias("item_id"), "reading", F.col("at").alias("j"), "size", "h", F.col("slots").alias("item_slots"))
    met = ours.withColumnRenamed("id", "doc_id").join(item, ["h", "size", "reading"])
    # One value pair for each slot of a window; the arrays of a pair have the same places.
    pairs = F.transform(
        F.arrays_zip("item_slots", "slots"),
        lambda z: F.struct((F.col("j") + z["item_slots"]["k"]).alias("at"), z["item_slots"]["v"].alias("theirs"), z["slots"]["v"].alias("ours")),
    )
    # A word more or less inside an item moves what follows, so matches also add up over neighbouring shifts.
    shift = F.col("at") - F.col("j")
    bands = [shift, F.floor(shift / BAND), F.floor((shift + BAND // 2) / BAND)]
    aligned = (
        met.withColumn("pairs", pairs)
        .withColumn("band", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), b.cast("long").alias("place")) for k, b in enumerate(bands)])))
        .groupBy("doc_id", "item_id", "reading", "band")
        .agg(F.array_sort(F.collect_set("j")).alias("js"), F.max("size").alias("size"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    )
    covered = F.aggregate(
        "js",
        F.struct(F.lit(0).alias("n"), F.lit(-(1 << 20)).alias("last")),
        lambda acc, j: F.struct((acc["n"] + F.least(F.col("size"), j - acc["last"])).alias("n"), j.alias("last")),
        lambda acc: acc["n"],
    )
    values = F.array_distinct(F.transform("pairs", lambda p: p["theirs"]))
    both = F.array_distinct(F.transform("pairs", lambda p: F.struct(p["theirs"], p["ours"])))
    judged = aligned.select(
        "doc_id",
        "item_id",
        "reading",
        covered.alias("covered"),
        F.size("pairs").alias("n_slots"),
        F.when(F.size(both) > 0, F.size(values) / F.size(both)).otherwise(F.lit(1.0)).alias("consistency"),
        F.forall("pairs", lambda p: p["theirs"] == p["ours"]).alias("same"),
    ).join(lengths, F.col("item_id").eqNullSafe(F.col("of_item")) & (F.col("reading") == F.col("of_reading")))
    enough = F.least(F.ceil(F.col("n_words") * cfg.least_percent / 100), F.lit(cfg.enough_words))
    held = judged.where((F.col("covered") >= enough) & (F.col("consistency") >= cfg.least_consistency))
    # Words as they stand tell no slots, so they count where templates find nothing.
    order = F.struct((F.col("reading") != VERBATIM).alias("by_template"), "covered", "same", "n_slots", "n_words")
    best = held.groupBy("doc_id", "item_id").agg(F.max(order).alias("best"))
    return best.select(
        "doc_id", "item_id", F.col("best.n_words").cast("long").alias("n_words"), F.col("best.covered").cast("long").alias("covered"),
        F.col("best.n_slots").cast("long").alias("n_slots"),
        F.when(F.col("best.same"), "verbatim").otherwise("reparameterised").alias("kind"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    found = leaks(docs, benchmark, cfg).select(F.col("doc_id").alias("leak_id")).distinct()
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["leak_id"]), "left_anti")
