import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormledger.llm import toxicity as X
from stormledger.llm.common import fold

from .helpers import awkward, documents, none

BAD = ["zorgle", "wexmud", "grontas"]
PLAIN = "the quiet river runs over grey stones and small green plants while people walk home after long days of honest work".split()


def corpus(spark, n=400):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [rnd.choice(PLAIN) for _ in range(40)]
        if toxic:
            words[rnd.randint(0, 39)] = rnd.choice(BAD) + rnd.choice(["", "", "ly", "ed"])
        rows.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(toxic)))
    return rows, documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_character_counts_equal_a_plain_version(spark):
    rows, docs, _ = corpus(spark, 20)
    got = {(r["a"], r["b"]): r["n"] for r in X.pair_counts(docs).collect()}
    expected = {}
    for _, text in rows:
        spaced = "_" + "_".join(X.WORD.findall(text.lower())) + "_"
        for a, b in zip(spaced, spaced[1:]):
            key = (X.CODE[a], X.CODE[b])
            expected[key] = expected.get(key, 0) + 1
    assert got == expected


@pytest.fixture(scope="module")
def model(spark):
    rows, docs, _ = corpus(spark)
    return X.character_model(docs)


@pytest.mark.parametrize("disguised", ["z0rgle", "z0rg1e", "zooooorgle", "z o r g l e", "z.o.r.g.l.e", "w3xmud", "gr0nt4s", "6r0nta5", "wexxxmuuud"])
def test_disguises_are_undone(model, disguised):
    assert set(BAD) & X.Restorer(model, X.Settings()).words(f"and then {disguised}, they said")


def test_decoding_is_the_best_path(model):
    """Viterbi finds what trying all paths finds."""
    from itertools import product

    restorer = X.Restorer(model, X.Settings())
    for token in ("w3xmud", "a11y", "g00d", "5t4r$", "he1l0"):
        steps = restorer._steps(token)
        best = max(
            (sum(c for _, c in path) + sum(model[X.CODE[a], X.CODE[b]] for a, b in zip("_" + word, word + "_")), word)
            for path in product(*steps) for word in ["".join(s for s, _ in path)]
        )
        assert restorer.decode(token) == best[1]


def test_plain_texts_are_left_alone(model):
    text = "Call 555-0216 or see https://a.org/x1?y=2 on 3rd May, it costs $40!!! A b. **bold** x86"
    assert set(X.WORD.findall(text.lower())) <= X.Restorer(model, X.Settings()).words(text)


def test_held_out_labels_and_disguised_ones(spark):
    rows, docs, labels = corpus(spark)
    extra = [(1_000, "the quiet w 3 x m u d river"), (1_001, "the quiet z0rgle river"), (1_002, "the quiet river")]
    found = {r["doc_id"]: r for r in X.scores(docs.union(documents(spark, extra)), labels, fold(F.col("doc_id"), 4) != 2).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i]["predicted"] == (i % 5 == 0) for i in held) and any(i % 5 == 0 for i in held)
    assert found[1_000]["predicted"] == found[1_001]["predicted"] == 1 and found[1_002]["predicted"] == 0
    assert found[1_001]["n_restored"] == 1


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (4, None, None), (None, 1, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    found = X.scores(docs, labels).collect()
    assert len(found) == 12 and all(0 <= r["score"] <= 1 and not np.isnan(r["score"]) for r in found)
    assert all(r["score"] == 0 for r in X.scores(docs, labels.limit(0)).collect())
    assert {r["score"] for r in X.scores(docs, labels.where("toxic = 0 and doc_id = 6")).collect()} == {0.0}
    assert X.scores(none(spark), labels).count() == 0


@pytest.mark.parametrize("disguised", ["zorgl3", "+oxnar", "!diotar", "|diotar", "(lownar", "oxnat+", "gron-tas", "gron.tas", "g  r  o  n  t  a  s", "6 r o n t a s", "zo" + "o" * 60 + "rgle"])
def test_edge_signs_gaps_and_long_repeats(disguised):
    """A model of words that begin or end with what a sign stands for."""
    table = np.ones((X.OTHER + 1, X.OTHER + 1))
    known = ["toxnar", "idiotar", "clownar", "oxnatt", "grontas", "zorgle"]
    for w in known:
        for a, b in zip("_" + w, w + "_"):
            table[X.CODE[a], X.CODE[b]] += 50
    table = np.log(table / table.sum(axis=1, keepdims=True))
    assert set(known) & X.Restorer(table, X.Settings()).words(f"and then {disguised} they said")


@pytest.mark.parametrize("broken", ["gron tas", "gro nt as", "gr0n tas!", "you gron-tas", "y o u g r o n t a s", "y o u   g r o n t a s", "g r o n t a s", "wex mudly"])
def test_words_broken_anywhere_are_found(broken):
    restorer = X.Restorer(np.log(np.full((X.OTHER + 1, X.OTHER + 1), 1 / 28)), X.Settings())
    evidence = X.Evidence({"grontas": 2.0, "gront*": 1.0, "wexmud*": 1.0, "asnow": 3.0}, {"as", "now"})
    text = f"as now {broken} then"
    hits = evidence.joined(text) | evidence.hits(*restorer.readings(text))
    assert hits and not any("asnow" == h for h in hits)
    assert evidence.joined("grontas is here, as now, grontas tas") == {}


def test_two_readings_of_one_word_count_once():
    evidence = X.Evidence({"stupid": 2.0, "stupi*": 1.5})
    assert evidence.hits({"stupid", "stupidi"}, {"stupidi": {"stupid"}}) == {"stupid": 2.0}
    assert X.Evidence({"idiot": 2.0, "dio": 1.0}).hits({"idiot", "dio"}, {"idiot": {"dio"}}) == {"idiot": 2.0}
