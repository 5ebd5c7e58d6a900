import random
from collections import defaultdict

from stormledger.llm import mixing as M

from .helpers import awkward, documents, none


def cells_of(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, topic string, n_words long")


def test_margins_meet_their_targets(spark):
    rnd = random.Random(1)
    rows = [(s, k, t, rnd.randint(1, 9_000)) for s in ("s0", "s1", "s2", "s3") for k in ("en", "fr") for t in ("prose", "list") if rnd.random() < 0.9]
    cfg = M.Settings(rounds=25)
    found = M.raked(cells_of(spark, rows), cfg).collect()
    total = sum(r[3] for r in rows)
    for at, margin in enumerate(M.MARGINS):
        words, weights = defaultdict(int), defaultdict(float)
        for r in rows:
            words[r[at]] += r[3]
        for r in found:
            weights[r[margin]] += r["weight"]
        parts = {v: n ** cfg.power(margin) for v, n in words.items()}
        for v, part in parts.items():
            assert abs(weights[v] - total * part / sum(parts.values())) < 1e-3 * total


def test_probabilities_give_the_wanted_words(spark):
    rows = [("a", "en", "prose", 100_000), ("b", "en", "prose", 1_000), ("c", "fr", "list", 10), ("d", "fr", "list", 0)]
    made = M.raked(cells_of(spark, rows))
    got = {r["source"]: r for r in M.probabilities(made).collect()}
    assert got["d"]["probability"] == 1 and all(0 < r["probability"] <= 1 for r in got.values())
    expected = sum(r["probability"] * r["n_words"] for r in got.values())
    assert abs(expected - 0.6 * 101_010) < 1e-3 * 101_010
    assert got["b"]["probability"] > got["a"]["probability"]


def test_sample_follows_the_probabilities_and_ids(spark):
    rows = [(i, "some words of text " * (1 + i % 7), "en" if i % 4 else "fr", f"s{i % 3 if i % 5 else 9}") for i in range(2_000)]
    docs = documents(spark, rows)
    found = M.mixed(docs).collect()
    assert len(found) == 2_000
    per = defaultdict(list)
    for r in found:
        per[r["source"], r["lang"], r["topic"], r["probability"]].append(r["kept"])
    for (*_, p), kept in per.items():
        assert abs(sum(kept) - p * len(kept)) <= 5 * (len(kept) * p * (1 - p)) ** 0.5 + 1
    same = {r["doc_id"] for r in M.sampled(docs).collect()}
    assert same == {r["doc_id"] for r in found if r["kept"]}


def test_topics(spark):
    texts = ["a | b | c | d", "x\ny\nz", "word " * 40, ""]
    got = [r["topic"] for r in M.measured(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()]
    assert got == ["table", "list", "prose", "prose"]


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    found = M.mixed(docs).collect()
    assert len(found) == 12 and all(r["source"] is not None and r["kept"] is not None for r in found)
    sample = M.sampled(docs)
    assert sample.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in sample.collect()) == sorted(str(r["doc_id"]) for r in found if r["kept"])
    assert M.mixed(none(spark)).count() == 0 and M.sampled(none(spark)).count() == 0
    assert M.mixed(documents(spark, [(1, ""), (2, None)])).where("kept").count() == 2
