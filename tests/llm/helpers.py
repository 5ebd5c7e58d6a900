"""Small inputs and plain versions of what the operators compute."""

import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = ["row", "key", "value", "rep", "component", "n", "n_words", "gone", "gone_id", "leak_id", "tag", "probability", "score", "line", "a", "b",
            "meta.tag", "two words", "c0", "learned", "lang.x", "tick`ed"]


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """The same rows with further columns of awkward names."""
    return df.selectExpr("*", *[f"'x' AS `{c.replace('`', '``')}`" for c in CLASHING])


LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))


def awkward(spark):
    """Nulls in every column, empty and very long texts, blanks only, ties and repeated rows."""
    rows = [
        (1, None, None, None), (2, "", "en", "s"), (3, " \t\n\n", "en", None), (4, LONG, "en", "s"), (5, LONG, None, "s"),
        (6, "One line only here.", "en", "s"), (6, "One line only here.", "en", "s"), (None, "no id at all, a text of some words", "en", "s"),
        (None, None, None, None), (7, "!!! ... ---", "fr", "s"), (8, "a", "fr", "s"), (9, "a b c\na b c\n", "fr", "t"),
    ]
    return clashing(documents(spark, rows))


def none(spark):
    return clashing(documents(spark, []))


def prose(rnd: random.Random, n: int, letters="abcdefghij", words=400) -> str:
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))) for _ in range(words)]
    return " ".join(rnd.choice(made) for _ in range(n))


def groups(links, nodes):
    """Smallest reachable node of each."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
