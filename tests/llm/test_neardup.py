import random

from stormledger.llm import neardup as N

from .helpers import WORD, awkward, documents, groups, none, prose

LOWER = {c: c + 32 for c in range(65, 91)}


def sets_of(rows):
    found = {}
    for doc, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        found[doc] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())
    return found


def plain(rows):
    sets = sets_of(rows)
    ids = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return groups(links, ids), {d: len(s) for d, s in sets.items()}


def altered(rnd, text, share):
    return " ".join(w if rnd.random() > share else f"w{rnd.randint(0, 10**6)}" for w in text.split(" "))


def compare(spark, rows, cfg=N.Settings()):
    component, sizes = plain(rows)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(documents(spark, rows), cfg).collect()}
    assert found == {d: (sizes[d], component[d], component[d] == d) for d in component}
    return component


def test_equals_brute_force_on_copies_chains_and_shared_passages(spark):
    rnd = random.Random(1)
    bases = [prose(rnd, n) for n in (6, 40, 90, 200)]
    passage = prose(rnd, 60)
    rows = [(i, prose(rnd, rnd.randint(1, 80)) + (" " + passage if i % 2 else "")) for i in range(40)]
    rows += [(100 + i, altered(rnd, rnd.choice(bases), rnd.choice([0, 0.01, 0.03, 0.06]))) for i in range(120)]
    text = prose(rnd, 150)
    for i in range(10):  # each links with the next only
        rows.append((300 - i, text))
        text = altered(rnd, text, 0.025)
    rows += [(400, "one two"), (401, "One TWO"), (402, "one"), (403, ""), (404, None), (405, "É x y z w"), (406, "é x y z w")]
    component = compare(spark, rows)
    assert component[401] == 400 and component[406] == 406


def test_a_large_group_of_near_misses_takes_no_shortcut(spark):
    """Copies of one text that mostly miss each other, in one list; few pivots, then all possible pairs."""
    rnd = random.Random(2)
    base = prose(rnd, 120)
    rows = [(i, altered(rnd, base, rnd.choice([0.02, 0.04, 0.06, 0.1]))) for i in range(150)]
    compare(spark, rows, N.Settings(pivots=2, turns=1))


def test_awkward_rows_and_empty_tables(spark):
    found = N.near_duplicates(awkward(spark)).collect()
    assert len(found) == 12
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[5]["component_id"] == 4 and not by_id[5]["kept"]
    assert [r["kept"] for r in found if r["doc_id"] == 6] == [True, True]
    assert by_id[2]["n_shingles"] == 0 and by_id[2]["kept"]
    assert all(r["component_id"] is None and r["kept"] for r in found if r["doc_id"] is None)
    assert N.near_duplicates(none(spark)).count() == 0
    kept = N.deduplicated(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.count() == 11
    assert N.deduplicated(none(spark)).count() == 0


def test_an_id_with_two_texts_links_both_groups(spark):
    a, b = "a1 a2 a3 a4 a5 a6", "b1 b2 b3 b4 b5 b6"
    found = N.near_duplicates(documents(spark, [(1, a), (5, a), (5, b), (7, b)])).collect()
    assert {r["component_id"] for r in found} == {1}


def test_differences_from_pivots_alone_find_all_links(spark):
    """No pivot turns, no lists paired directly: deletions only, insertions only, and both, around two bases."""
    rnd = random.Random(6)
    bases = [prose(rnd, 90), prose(rnd, 140)]

    def changed(text):
        w = text.split(" ")
        for _ in range(rnd.randint(0, 4)):
            i = rnd.randrange(len(w))
            w[i : i + rnd.randint(0, 2)] = [f"v{rnd.randint(0, 9)}"] * rnd.randint(0, 1)
        return " ".join(w)

    rows = [(i, changed(rnd.choice(bases))) for i in range(140)]
    component = compare(spark, rows, N.Settings(turns=0, short=1))
    assert 2 < len(set(component.values())) < 120


def test_rows_sent_to_meetings_do_not_widen_with_the_differences(spark):
    """Each held all windows of its member: 9 GB of them on half a GB of documents."""
    cfg = N.Settings()
    schema = "pivot long, rep long, w long, theirs int, room int, places array<struct<place: int, item: long>>"
    places = {1: [(k + 1, 1000 + k) for k in range(300)], 2: [(k + 1, 1000 + k) for k in range(0, 300, 3)], 3: []}
    rows = [(9, rep, 5, 0, 250, held) for rep, held in places.items()]
    found = N._meetings(spark.createDataFrame(rows, schema), ["rep", "w"], "x", cfg).collect()
    assert len(found) == 250 + 84
    for r in found:
        mine = [item for place, item in places[r["x"]["rep"]] if place <= 250]
        at = mine.index(r["item"])
        assert r["x"]["before"] == mine[max(0, at - cfg.before) : at]
