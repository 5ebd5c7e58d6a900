import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormledger.llm import bytehash as B
from stormledger.llm import suffixes as S

from .helpers import LONG, awkward, documents, none


def plain(rows, window):
    """(bytes, spans, kept) of each text."""
    texts = {d: (t or "").encode() for d, t in rows}
    starts = Counter(t[p : p + window] for t in texts.values() for p in range(len(t) - window + 1))
    out = {}
    for d, t in texts.items():
        gone = bytearray(len(t))
        for p in range(len(t) - window + 1):
            if starts[t[p : p + window]] > 1:
                gone[p : p + window] = b"\x01" * window
        ends = [k for k in range(len(t) + 1) if (k > 0 and gone[k - 1]) != (k < len(t) and gone[k])]
        out[d] = (len(t), list(zip(ends[::2], ends[1::2])), bytes(b for b, g in zip(t, gone) if not g))
    return out


def found(docs, cfg=S.Settings()):
    rows = S.without_repeats(docs, cfg).collect()
    return {r["doc_id"]: (r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in rows}


@pytest.mark.parametrize("cfg", [S.Settings(), S.Settings(together=2), S.Settings(window=60, reach=30, gram=6)])
def test_equals_brute_force(spark, cfg):
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdefgh é") for _ in range(900))
    rows = []
    for i in range(80):
        text = ""
        for _ in range(rnd.randint(0, 4)):
            a = rnd.randint(0, 850)
            text += base[a : a + rnd.randint(30, 420)] + "".join(rnd.choice("xyz ") for _ in range(rnd.choice([0, 0, 1, 40])))
        rows.append((i, text + "ab" * rnd.choice([0, 0, 0, 90, 150])))
    rows += [(100, base[:199]), (101, base[:200]), (102, base[:201]), (103, "q" * 200), (104, "r" * 201)]
    docs = documents(spark, rows).repartition(6)
    assert found(docs, cfg) == plain(rows, cfg.window)


def test_many_copies_of_one_passage_in_different_surroundings(spark):
    rnd = random.Random(8)
    passage = "".join(rnd.choice("lmnopq ") for _ in range(260))
    rows = [(i, f"{rnd.random()}" * 12 + passage + f"{rnd.random()}" * 12) for i in range(60)]
    got = found(documents(spark, rows).repartition(9), S.Settings(together=7))
    assert got == plain(rows, 200) and all(len(v[1]) == 1 for v in got.values())


def test_keys_order_as_a_full_sort_would():
    rnd = np.random.default_rng(1)
    keys = [rnd.integers(0, 3, 500) for _ in range(3)]
    order, runs = S.multikey_order(keys)
    rows = list(zip(*(k[order].tolist() for k in keys)))
    assert rows == sorted(rows)
    assert len(set(zip(rows, runs[2].tolist()))) == len(set(rows)) == runs[2][-1] + 1


def test_equal_windows_have_equal_anchors():
    rnd = np.random.default_rng(2)
    shared = rnd.integers(97, 105, 300, dtype=np.uint8)
    made = [np.concatenate([rnd.integers(97, 105, n, dtype=np.uint8), shared]) for n in (0, 17, 500)]
    at = np.concatenate([[0], np.cumsum([len(m) for m in made])])
    data = np.concatenate(made)
    a = S.anchors(data, at, B.running(data), S.Settings())
    per = [{int(p) - n: int(x) - n for x, f, e in zip(a.at[a.text == k], a.first[a.text == k], a.last[a.text == k]) for p in range(f, e + 1)} for k, n in enumerate((0, 17, 500))]
    assert all(per[k][p] == per[0][p] for k in (1, 2) for p in range(101))


def test_awkward_rows_and_empty_tables(spark):
    rows = S.without_repeats(awkward(spark)).collect()
    assert len(rows) == 12
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[1]["n_bytes"] == 0 and by_id[1]["spans"] == []
    assert by_id[4]["n_bytes"] == len(LONG) and bytes(by_id[4]["kept"]) == bytes(by_id[5]["kept"]) == b""
    assert S.without_repeats(none(spark)).count() == 0
    twice = documents(spark, [(1, "z y x w " * 40), (1, "z y x w " * 40), (2, "unlike")])
    assert [len(r["kept"]) for r in S.without_repeats(twice).orderBy(F.col("doc_id")).collect()] == [0, 0, 6]
