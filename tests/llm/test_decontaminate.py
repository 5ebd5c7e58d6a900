import random

from stormledger.llm import decontaminate as D

from .helpers import awkward, documents, none, prose

QUESTION = "Today Tom has 12 apples and Anna gives him 5 kg more, how many apples has Tom now?"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, benchmark, cfg=D.Settings()):
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in D.leaks(docs, benchmark, cfg).collect()}


def test_changed_numbers_and_names_are_found_if_consistent(spark):
    docs = documents(spark, [
        (1, f"Before it. {QUESTION} After it."),
        (2, "well, today Bob has 30 APPLES and Mia gives him 7 kg more how many apples has Bob now"),
        (3, "Today Bob has 30 apples and Mia gives him 7 kg more, how many pears has Zed then or not at all in this other text?"),
        (4, "Today Tom has 12"),
        (5, QUESTION.replace("apples", "pears").replace("gives", "takes").replace("more", "less")),
    ])
    assert found(docs, items(spark, [(9, QUESTION)])) == {(1, 9): "verbatim", (2, 9): "reparameterised", (3, 9): "reparameterised"}
    strict = D.Settings(least_consistency=1.0, least_percent=95)
    assert set(found(docs, items(spark, [(9, QUESTION)]), strict)) == {(1, 9), (2, 9)}


def test_slots_must_agree_wherever_they_stand(spark):
    item = " ".join(f"word{k} and Tom goes on with Anna to" for k in range(4))
    same, mixed = item.replace("Tom", "Bob"), item
    for k, name in enumerate(("Bob", "Kim", "Lee", "Max")):
        mixed = mixed.replace("Tom", name, 1)
    got = found(documents(spark, [(1, same), (2, mixed)]), items(spark, [(1, item)]))
    assert got == {(1, 1): "reparameterised"}


def test_planted_items_are_all_found_and_nothing_else(spark):
    rnd = random.Random(6)
    benchmark = [(i, prose(rnd, n).capitalize()) for i, n in enumerate([5, 6, 8, 9, 20, 60])]
    rows = [(i, prose(rnd, 60)) for i in range(30)]
    rows += [(100 + i, f"{prose(rnd, 20)} {t} {prose(rnd, 20)}.") for i, t in benchmark]
    rows += [(200 + i, t.upper() if i % 2 else f"X.\n{t}") for i, t in benchmark]
    rows += [(300, " ".join(t for _, t in benchmark[2:]))]
    got = set(found(documents(spark, rows), items(spark, benchmark)))
    assert got == {(k + i, i) for i, _ in benchmark for k in (100, 200)} | {(300, i) for i in range(2, 6)}


def test_template_of_awkward_words():
    import numpy as np

    texts = ["Ça va. Été à Élan, 5 km et 3 Km", "", "... !!", "A. B"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    t = D.template(data, at)
    words = [t.data[s:e].tobytes().decode() for s, e in zip(t.starts, t.ends)]
    assert [(w, bool(s)) for w, s in zip(words, t.slot)][:9] == [
        ("Ça", False), ("va.", False), ("Été", False), ("à", False), ("Élan,", True), ("5", True), ("km", True), ("et", False), ("3", True)
    ]
    assert t.first.tolist() == [0, 10, 10, 10, 12]


def test_awkward_rows_and_empty_tables(spark):
    benchmark = items(spark, [(1, None), (None, "no id at all, a text of some words"), (2, ""), (3, "two words"), (4, "One line only here."), (4, "One line only here.")])
    docs = awkward(spark)
    assert set(found(docs, benchmark)) == {(None, None), (6, 4)}
    assert found(none(spark), benchmark) == {} and found(docs, items(spark, [])) == {}
    kept = D.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == 8  # both rows without an id and both of id 6 go
    assert D.decontaminated(none(spark), benchmark).count() == 0


def test_short_items_and_items_of_slots_are_found_as_they_stand(spark):
    benchmark = items(spark, [(1, "What is 12 + 34?"), (2, "Tom 5 kg, Ann 7 kg, Bob 9 kg: total?"), (3, "Why not")])
    docs = documents(spark, [
        (1, "He asked: what is 12 + 34? Nobody knew."), (2, "what is 12 - 34?"), (3, "what is 12 + 35?"), (4, "Why not"),
        (5, "sum of tom 5 kg, ann 7 kg, bob 9 kg: total? yes"), (6, "sum of tom 5 kg, ann 8 kg, bob 9 kg: total? yes"),
    ])
    assert found(docs, benchmark) == {(1, 1): "verbatim", (5, 2): "verbatim"}


def test_names_may_open_sentences_and_have_more_words(spark):
    item = "Tom has 12 apples. Tom eats 5. How many are left?"
    city = "Every year Boston sends 40 letters to all of its friends and then Boston waits for answers again"
    docs = documents(spark, [
        (1, "Bob has 30 apples. Bob eats 7. How many are left?"), (2, "Mary Ann has 30 apples. Mary Ann eats 7. How many are left?"),
        (3, "so Mary Ann has 30 apples. Mary Ann eats 7. How many are left?"), (4, "Bob has 30 pears. Kim sells 7. How few were left?"),
        (5, city.replace("Boston", "New York")), (6, city.replace("Boston", "New York").replace("40 letters", "1 000 letters")),
        (7, city.replace("year", "single year now")),
    ])
    got = found(docs, items(spark, [(1, item), (2, city)]))
    assert got == {(1, 1): "reparameterised", (2, 1): "reparameterised", (3, 1): "reparameterised",
                   (5, 2): "reparameterised", (6, 2): "reparameterised", (7, 2): "verbatim"}


def plain_words(text, reading):
    """(word or kind of slot, value) in a reading, word by word."""
    made, opens, previous = [], True, None
    for line in text.split("\n"):
        opens = True
        for raw in line.split():
            word = "".join(c for c in raw if c.isalnum() or ord(c) > 127)
            value = raw.strip(".,;:!?\"'()[]").lower()
            if reading == D.VERBATIM:
                if value := raw.strip(".,;:!?\"'()[]{}").lower():
                    made.append((value, None))
            elif word:
                number = word[0] in "0123456789"
                name = len(word) > 1 and word[0].isupper() and not word[1].isupper() and (reading == D.NAMED or not opens)
                kind = "#" if number else "unit" if previous == "#" and word.lower() in D.UNITS else "name" if name else None
                if kind in ("#", "name") and previous == kind and not opens:
                    made[-1] = (kind, f"{made[-1][1]} {value}")
                else:
                    made.append((kind or word.lower(), value if kind else None))
                previous, opens = kind, False
            opens = opens or raw[-1] in ".!?:;"
    return made


def plain_leaks(docs, benchmark, cfg=D.Settings()):
    """(document, item) of all windows of all items beside all windows of all documents."""
    got = set()
    for doc, text in docs:
        for item, question in benchmark:
            for reading in D.READINGS:
                ours, theirs = plain_words(text, reading), plain_words(question, reading)
                size = min(len(theirs), cfg.window)
                if size < (cfg.least_exact if reading == D.VERBATIM else cfg.least_words):
                    continue
                least = 0 if reading == D.VERBATIM else cfg.least_plain
                bands = {}
                for j in range(len(theirs) - size + 1):
                    window = theirs[j : j + size]
                    if 100 * sum(v is None for _, v in window) < least * size:
                        continue
                    for i in range(len(ours) - size + 1):
                        if [w for w, _ in ours[i : i + size]] == [w for w, _ in window]:
                            for band in ((0, i - j), (1, (i - j) // 4), (2, (i - j + 2) // 4)):
                                words, pairs = bands.setdefault(band, (set(), set()))
                                words |= set(range(j, j + size))
                                pairs |= {(theirs[j + k][1], ours[i + k][1]) for k in range(size) if window[k][1] is not None}
                enough = min(-(-len(theirs) * cfg.least_percent // 100), cfg.enough_words)
                if any(len(w) >= enough and (not p or len({a for a, _ in p}) / len(p) >= cfg.least_consistency) for w, p in bands.values()):
                    got.add((doc, item))
    return got


def test_equals_a_plain_version(spark):
    rnd = random.Random(17)
    vocabulary = "the cat has many red apples and gives some of them to".split()

    def sentence():
        made = []
        for _ in range(rnd.randint(3, 9)):
            made.append(rnd.choice(vocabulary) if rnd.random() < 0.75 else rnd.choice(["Tom", "Bob", "Mary Ann", "12", "5 kg", "1 000", "+"]))
        made[0] = made[0].capitalize() if made[0] in vocabulary else made[0]
        return " ".join(made) + rnd.choice(".?!")

    benchmark = [(i, " ".join(sentence() for _ in range(rnd.randint(1, 3)))) for i in range(25)]
    docs = []
    for d in range(120):
        _, text = rnd.choice(benchmark)
        for old, new in rnd.sample([("Tom", "Kim"), ("Bob", "Lee Ray"), ("12", "77"), ("5 kg", "6 kg"), ("cat", "dog"), (" to", " to all")], 2):
            text = text.replace(old, new, rnd.choice([1, 9]))
        docs.append((d, f"{sentence()} {text}\n{sentence()}"))
    expected = plain_leaks(docs, benchmark)
    assert set(found(documents(spark, docs), items(spark, benchmark))) == expected and len(expected) > 40
