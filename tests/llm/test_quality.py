import random
import re
from collections import Counter
from math import comb

from pyspark.sql import functions as F

from stormledger.llm import quality as Q

from .helpers import WORD, awkward, documents, none, prose


def plain(text):
    w = WORD.findall(text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    marked = {j + k for j in range(len(w) - 2) if windows[tuple(w[j : j + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked))
    return counts, len(w) < 50 or 100 * len(marked) > 50 * len(w)


def measured(docs):
    rows = Q.base_counts(docs).collect()
    return [(r["doc_id"], ((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]), r["base_failed"])) for r in rows]


def test_counts_equal_a_plain_version(spark):
    rnd = random.Random(1)
    texts = ["a a a a a", "a b c a b c", "a b a b a b", "x\ny\nx\n\n\n x", "é|#$ ü<>& z*%", "\x0bq\x0c q\rq q", "a b c d", "a b c"]
    texts += [" ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    rows = list(enumerate(texts))
    assert dict(measured(documents(spark, rows))) == {d: plain(t) for d, t in rows}


def test_allowed_rejections_are_the_exact_binomial_bound(spark):
    cases = [(0, 0.05), (1, 0.5), (50, 0.05), (300, 0.05), (300, 0.001), (5_000, 0.01)]
    rows = spark.createDataFrame(cases, "n long, error double")
    got = [r[0] for r in rows.select(Q.allowed_rejections(F.col("n"), 0.02, F.col("error"))).collect()]

    def exact(n, error):
        total, k = 0.0, -1
        for i in range(n + 1):
            total += comb(n, i) * 0.02**i * 0.98 ** (n - i) if n < 1_000 else 0
            if total > error:
                return k
            k = i
        return k

    assert got[:5] == [-1 if n == 0 else exact(n, e) for n, e in cases[:5]]
    assert 60 < got[5] < 100  # below the mean by some standard deviations, without underflow


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_cutoffs_keep_the_promise_for_each_stratum_and_reject_junk(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(4_000)]

    def text(junk):
        return " ".join(rnd.choice(words) + ("#*$" if rnd.random() < junk else "") for _ in range(60))

    rows = [(i, text(0.0 if i % 50 else 0.05), "en" if i % 2 else None, "s") for i in range(2_400)]
    rows += [(5_000 + i, text(0.9), "en", "s") for i in range(20)] + [(6_000, text(0.9), "fr", "s")]
    labels = labelled(spark, [(r[0], 1, 0) for r in rows if r[0] < 2_400])
    counts = Q.base_counts(documents(spark, rows)).cache()
    risk = Q.Risk(share=0.2, error=0.1)
    cuts = {(r["stratum"], r["ratio"]): r for r in Q.cutoffs(counts, labels, risk).collect()}
    assert {s for s, _ in cuts} == {"en", ""} and all(r["n_good"] == 1_200 for r in cuts.values())
    assert cuts["en", "symbol_ratio"]["cutoff"] < 2 and cuts["", "symbol_ratio"]["cutoff"] < 2
    kept = {r["doc_id"]: r["kept"] for r in Q.apply_rules(counts, Q.cutoffs(counts, labels, risk)).collect()}
    assert not any(kept[5_000 + i] for i in range(20)) and kept[6_000]  # no labels, no cutoff
    for parity in (0, 1):
        assert sum(not kept[i] for i in range(2_400) if i % 2 == parity) <= 0.2 * 1_200


def test_few_labels_reject_nothing(spark):
    rows = [(i, prose(random.Random(i), 60), "en", "s") for i in range(30)]
    labels = labelled(spark, [(i, 1, 0) for i in range(30)] + [(1, 0, 0), (None, 1, 0), (2, None, 1)])
    cuts = Q.cutoffs(Q.base_counts(documents(spark, rows)), labels)
    assert all(r["cutoff"] is None and r["n_good"] < 30 for r in cuts.collect())


def test_awkward_rows_and_empty_tables(spark):
    docs, labels = awkward(spark), labelled(spark, [(1, 1, 0), (4, 1, 0), (6, 1, None), (6, 0, 1), (None, None, None)])
    found = Q.quality_rules(docs, labels).collect()
    assert len(found) == 12
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["base_failed"] and not by_id[i]["kept"] and by_id[i]["n_words"] == 0 for i in (1, 2, 3))
    assert by_id[4]["n_words"] == 60_000
    assert Q.quality_rules(docs, labelled(spark, [])).count() == 12
    assert Q.quality_rules(none(spark), labels).count() == 0
