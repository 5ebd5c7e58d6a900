import math
import random
import re
from collections import Counter

from stormledger.llm import search as S

from .helpers import awkward, clashing, documents, none, prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, best=10):
    held = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, total = len(held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    out = []
    for item, text in items:
        asked, scored = TERM.findall((text or "").translate(LOWER)), []
        for i, w in held:
            tf, m = Counter(w), 25 + 75 * len(w) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in asked)
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:best])]
    return sorted(out, key=str)


def bench(spark, rows):
    return clashing(spark.createDataFrame(rows, "item_id long, text string"))


def test_equals_a_plain_version_with_copies_and_ties(spark):
    rnd = random.Random(5)
    texts = [prose(rnd, rnd.randint(1, 60), "abcñé1", words=40) for _ in range(30)]
    docs = [(i, rnd.choice(texts) if i % 3 else texts[0]) for i in range(150)]
    items = [(k, prose(rnd, 8, "abcñé1", words=40) + " " + rnd.choice(texts)[:40].upper()) for k in range(12)]
    for cfg in (S.Settings(), S.Settings(items=5, scores=50, piece=64)):
        got = sorted((tuple(r) for r in S.ranked(documents(spark, docs), bench(spark, items), cfg).collect()), key=str)
        assert got == plain(docs, items)


def test_awkward_rows(spark):
    docs, items = awkward(spark), [(1, "ONE line, a b"), (None, "word1 and2"), (3, None), (4, "..."), (5, "nowhere"), (1, "ONE line, a b")]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((tuple(r) for r in S.ranked(docs, bench(spark, items)).collect()), key=str)
    assert got == plain(rows, items[:2]) and any(r[2] is None for r in got)
    assert S.ranked(none(spark), bench(spark, items)).count() == 0
    assert S.ranked(docs, bench(spark, [])).count() == 0


def test_terms_in_pieces_are_those_of_the_whole():
    text = ("Ab, c1-Ü\t" * 50 + "x" * 100 + " end").encode()
    whole = [t for some in S.terms(text, 1 << 20) for t in some]
    assert whole == [t.encode() for t in TERM.findall(text.decode().translate(LOWER))]
    for most in (1, 7, 64):
        assert [t for some in S.terms(text, most) for t in some] == whole


def test_sums_beyond_doubles():
    block = S.ItemBlock([1], [{0: 10**6}], [b"a"])
    scorer = S.Scorer(block, [20_001], S.Settings())
    import numpy as np
    import pyarrow as pa

    bag = np.array([[0, 3]], dtype="<i4").tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([25]), pa.array([bag], pa.binary())], names=["m", "bag"])
    assert not scorer.doubles and scorer.scores(batch).tolist() == [[20_001 * 10**6 * (3 * 10**9 // (3000 + 200))]]
