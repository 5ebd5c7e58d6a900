import itertools
import math
import random
import re
from collections import Counter

from stormledger.llm import urls as U

from .helpers import CLASHING

RULES = (U.HostRule("allow", "org", "/"), U.HostRule("block", "a.org", "/x"), U.HostRule("block", "com", "/de/"))


def parts(url):
    if not url or "://" not in url:
        return "", "", "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match("[^/?#]*", rest).group()
    before, _, fragment = rest.partition("#")
    head, _, query = before.partition("?")
    return "".join(c.lower() if c.isascii() else c for c in host), head[len(host) :], query, fragment


def tokens(url):
    out = set()
    for name, part, sep in zip("hpqf", parts(url), ("[.:@-]+", "[/._-]+", "&+", "#+")):
        out |= {f"{name}:" + re.sub("([0-9])[0-9]*", r"\1#", t) for t in re.split(sep, part) if t}
    return out


def given(url):
    host, path, *_ = parts(url)
    fit = [(len(r.host + r.path), r.host + r.path, r.verdict) for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, default=(0, None, None))[1:]


def plain(rows, labelled, cfg):
    """Every set of tokens of every url."""
    def sets(url):
        mine = sorted(tokens(url))
        return [c for n in range(1, len(mine) + 1) for c in itertools.combinations(mine, n)]

    whole, with_label = Counter(), Counter()
    for url, label in labelled:
        for s in sets(url):
            whole[s] += 1
            with_label[s, label] += 1
    least = max(1, math.ceil(cfg.least_support * len(labelled)))
    rules = {}
    for (s, label), n in with_label.items():
        if n >= least and n / whole[s] >= cfg.least_confidence:
            rules.setdefault(s, []).append((n / whole[s], n, label == "block", label))
    out = []
    for page, url in rows:
        rule, verdict = given(url)
        best = max((x for s in sets(url) for x in rules.get(s, [])), default=None)
        learned = best[3] if best and rule is None else None
        out.append((page, *parts(url)[:2], rule, verdict or learned or cfg.default, learned))
    return sorted(out, key=str)


def made(rnd, n):
    urls = []
    for _ in range(n):
        host = ".".join(filter(None, [rnd.choice(["", "www", "M"]), rnd.choice(["a", "b-c", "shop"]), rnd.choice(["org", "com", "net"])]))
        urls.append(f"http://{host}/{rnd.choice(['de', 'x', 'en'])}/{rnd.randrange(3000)}" + rnd.choice(["", "?k=1", "#top"]))
    return urls


def judged(spark, rows, cfg=U.Settings(), labelled=None):
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", *[f"'x' AS `{c.replace('`', '``')}`" for c in [*CLASHING, "host", "rule", "tokens"]])
    found = U.judged(pages, RULES, labelled, cfg)
    return sorted((tuple(r)[:6] for r in found.collect()), key=str)


def test_equals_all_sets_of_tokens(spark):
    rnd = random.Random(8)
    rows = list(enumerate(made(rnd, 160) + ["http://long.org/a/b/c/d/e/f?p=1&q=2#z"] * 60))
    known = [(u, given(u)[1]) for _, u in rows if given(u)[1]]
    cfg = U.Settings(least_support=0.03, least_confidence=0.6, copies=7)
    got = judged(spark, rows, cfg)
    assert got == plain(rows, known, cfg)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_given_labels(spark):
    rows = [(1, "http://x.net/casino/1"), (2, "http://y.net/news/1"), (3, "http://z.net/other")]
    known = [("http://q.net/casino/2", "block")] * 4 + [("http://q.net/news/2", "allow")] * 4 + [("http://q.net/other", None)]
    frame = spark.createDataFrame(known, "url string, label string")
    assert [r[4:] for r in judged(spark, rows, labelled=frame)] == [("block", "block"), ("allow", "allow"), ("allow", None)]


def test_awkward_urls(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme/x"), (4, "://"), (5, "HTTP://A.ORG/x/é?q#f"), (6, "http://a.org"), (7, "http://sub.a.org/x"), (7, "http://sub.a.org/x"),
        (None, "http://xorg/"), (8, "http://u://v/w"), (9, "http://a.org?u=/x"), (10, "http://b.com/de/" + "long/" * 5_000), (11, "http://b.com\n/de/"),
    ]
    got = judged(spark, rows)
    assert got == plain(rows, [(u, given(u)[1]) for _, u in rows if given(u)[1]], U.Settings())
    assert judged(spark, []) == [] and judged(spark, [(1, "x")]) == [(1, "", "", None, "allow", None)]
