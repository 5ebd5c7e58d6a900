import random

import pytest

from stormledger.llm import lines as L

from .helpers import awkward, documents, none

BLANKS = " \t\n\x0b\x0c\r"


def close(x, y):
    """Within one edit."""
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) <= 1
    i = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    return len(y) == len(x) + 1 and x[i:] == y[i + 1 :]


def plain(rows, least):
    places = [(d, k, line) for d, t in rows for k, line in enumerate((t or "").split("\n")) if line.strip(BLANKS)]
    gone = {}
    for d, k, line in places:
        for e, j, other in places:
            if (e, j) < (d, k) and (line == other or min(len(line), len(other)) >= least and close(line, other)):
                gone.setdefault(d, set()).add(k)
                break
    return {d: (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(d, ()))) for d, t in rows}


@pytest.mark.parametrize("least", [8, 20])
def test_equals_brute_force(spark, least):
    rnd = random.Random(least)
    base = ["abcdefghij klmnop qrst uvwxyz"[: rnd.randint(6, 29)] + str(i) for i in range(10)]

    def edited(s):
        for _ in range(rnd.randint(0, 2)):
            p, kind = rnd.randint(0, len(s)), rnd.randint(0, 2)
            s = s[:p] + rnd.choice("xyzé") + s[p + (kind > 0) :] if kind < 2 else s[:p] + s[p + 1 :]
        return s

    rows = [(i, "\n".join(edited(rnd.choice(base)) if rnd.random() < 0.8 else rnd.choice(["", " ", "ab"]) for _ in range(5))) for i in range(60)]
    found = L.deduplicated(documents(spark, rows), L.Settings(least_fuzzy=least), counts=True)
    assert {r["doc_id"]: r["text"] for r in found.collect()} == plain(rows, least)


def test_edits_at_the_ends_and_along_a_long_line(spark):
    line = "".join(chr(97 + i * 7 % 26) for i in range(300))
    changed = [line[:i] + "#" + line[i + 1 :] for i in (0, 149, 150, 299)] + [line[:i] + line[i + 1 :] for i in (0, 77, 299)]
    changed += [line[:i] + "#" + line[i:] for i in (0, 33, 300)]
    rows = [(0, line), *[(i + 1, t) for i, t in enumerate(changed)], (50, line[:100] + "##" + line[102:]), (51, line[2:])]
    found = {r["doc_id"]: r["n_removed"] for r in L.deduplicated(documents(spark, rows), counts=True).collect()}
    assert found == {0: 0, **{i + 1: 1 for i in range(len(changed))}, 50: 0, 51: 1}  # 51 is one edit from an earlier line


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    found = L.deduplicated(docs)
    assert found.columns == docs.columns and found.count() == 12
    texts = [(r["doc_id"], r["text"]) for r in found.select("doc_id", "text").collect()]
    assert (1, None) in texts and texts.count((6, "One line only here.")) == 2
    assert (5, "") in texts  # all of it stands in document 4
    assert (9, "a b c\n") in texts
    assert L.deduplicated(docs, emptied=False).count() == 11
    assert L.deduplicated(none(spark)).count() == 0
