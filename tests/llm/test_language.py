import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from stormledger.llm import language as L
from stormledger.llm.common import fold

from .helpers import awkward, documents, none, prose

ALPHABETS = {"xa": "abcdeé", "xb": "defghi", "xc": "ñopqßab"}


def corpus(spark, n=90):
    rnd = random.Random(4)
    rows = [(i, prose(rnd, rnd.randint(20, 80), ALPHABETS[k]), k, "s") for i in range(n) for k in [sorted(ALPHABETS)[i % 3]]]
    return rows, documents(spark, rows)


def by_hand(texts):
    """Counts of 1- to 3-grams, words bounded by `_`, without those that are a boundary in the middle."""
    counts = Counter()
    for text in texts:
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            padded = f"_{word}_"
            counts.update(word)
            counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
            counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return counts


def rank(counts, length):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:length]


def test_profiles_and_distances_equal_a_plain_version(spark):
    rows, docs = corpus(spark)
    cfg = L.Settings(length=60)
    known = L.collected(L.profiles(docs, cfg=cfg))
    expected = {k: rank(by_hand(r[1] for r in rows if r[2] == k), 60) for k in ALPHABETS}
    assert known == expected
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.identify(docs, cfg=cfg).collect()}
    for doc, text, *_ in rows:
        own = rank(by_hand([text]), 60)
        far = {k: sum(abs(i - p.index(g)) if g in p else 60 for i, g in enumerate(own)) for k, p in expected.items()}
        best = min(far, key=lambda k: (far[k], k))
        assert found[doc][0] == best and abs(found[doc][1] - (1 - far[best] / (60 * len(own)))) < 1e-12


def test_held_out_accuracy_and_large_alphabets_alike(spark):
    rows, docs = corpus(spark)
    learn = fold(F.col("doc_id"), 3) != 1
    found = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs, learn).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert held and all(found[r[0]] == r[2] for r in held)
    wide = [(i, "".join(chr(0x4E00 + (i * 7 + k) % 400) for k in range(300)), "zh", "s") for i in range(3)]
    codes = L.grams([w[1] for w in wide])
    assert codes.size > 100
    numbers, counts = codes.counted(codes.codes)
    assert {codes.gram(int(c)): int(n) for c, n in zip(numbers, counts)} == dict(by_hand(w[1] for w in wide))
    assert all(codes.number(codes.gram(int(c))) == c for c in numbers[::50])


def test_awkward_rows_and_empty_tables(spark):
    found = L.identify(awkward(spark)).collect()
    assert len(found) == 12
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in found if r["doc_id"] in (1, 2, 3, 7))
    assert all(0 <= r["score"] <= 1 for r in found)
    assert L.identify(none(spark)).count() == 0
    kept = L.kept_languages(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert {1, 2, 3, 7}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert L.kept_languages(none(spark)).count() == 0
    nothing_learned = L.identify(documents(spark, [(1, "some text", None, None)])).first()
    assert (nothing_learned["lang_pred"], nothing_learned["score"]) == ("und", 0.0)


def test_unlearned_languages_of_the_same_script_are_rejected(spark):
    rows, docs = corpus(spark)
    rnd = random.Random(8)
    other = [(1_000 + i, prose(rnd, 60, "abcdefghi"), None, "s") for i in range(20)]
    junk = [(2_000 + i, prose(rnd, 60, "abcdefghijklm"), "xa", "s") for i in range(20)]
    kept = {r["doc_id"] for r in L.kept_languages(docs.union(documents(spark, other + junk)), F.col("doc_id") < 1_000).collect()}
    assert kept == {r[0] for r in rows}


def test_cutoffs_leave_out_a_part_of_each_language(spark):
    judged = spark.createDataFrame([("a", k / 1000) for k in range(1000)] + [("b", 0.5)], "lang string, score double")
    assert {r["lang"]: r["cutoff"] for r in L.cutoffs(judged, 0.005).collect()} == {"a": 0.005, "b": 0.5}
