import base64
import gzip
import hashlib
import os
from collections import Counter

from stormledger.llm import warc as W

from .helpers import CLASHING

PAGES = "page_id long, url string, html string"


def written(spark, tmp_path, rows, cfg=W.Settings()):
    pages = spark.createDataFrame(rows, PAGES)
    folder, directory = W.write_warc(spark, pages, str(tmp_path), cfg)
    return pages, folder, directory


def expected(rows):
    first = {}
    for page, _, html in sorted(rows, key=lambda r: r[0]):
        first.setdefault(html or "", page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        whole = first[html or ""] == page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if whole else "revisit", None if whole else first[html or ""]))
    return Counter(out)


def test_round_trip_with_many_blocks_and_files(spark, tmp_path):
    rows = [(i, f"http://www{i % 2 or ''}.h{i % 13}.example.org/p/{i % 40}?q={i}#f", f"<p>é{i % 50}\r\n\r\n{i % 50}</p>" * (i % 50)) for i in range(400)]
    rows += [(500 + i, "https://hot.example.org/", "same") for i in range(90)]
    pages, folder, directory = written(spark, tmp_path, rows, W.Settings(block_entries=16, file_bytes=4_000))
    assert directory.count() >= 490 // 16
    got = W.lookup(pages, folder, directory, payloads=True).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(rows)
    html = {r[0]: r[2] for r in rows}
    assert all(bytes(r["payload"]).decode() == html[r["page_id"]] for r in got if r["record_type"] == "response")
    # Files are plain WARC for any reader.
    text = b"".join(gzip.open(os.path.join(tmp_path, f)).read() for f in os.listdir(tmp_path) if f.endswith(".warc.gz"))
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 490


def test_lookup_finds_all_captures_of_an_address_and_no_others(spark, tmp_path):
    rows = [(i, f"http://a.org/{i % 10}", f"x{i}") for i in range(60)] + [(100, None, "n"), (101, "", None), (102, "HTTP://A.org:80/3", "y")]
    _, folder, directory = written(spark, tmp_path, rows, W.Settings(block_entries=4))

    def ids(*urls):
        asked = spark.createDataFrame([(u,) for u in urls], "url string")
        return sorted(r["page_id"] for r in W.lookup(asked, folder, directory).collect())

    assert ids("http://www.a.org/3", "http://a.org/3#x") == [3, 13, 23, 33, 43, 53, 102]
    assert ids("http://a.org/99", "http://b.org/") == [] and ids(None) == [100, 101]


def test_keys():
    assert W.url_key("https://User@www2.News.Example.com:8080/a/b?c=d#e") == "com,example,news:8080)/a/b?c=d"
    assert W.url_key("example.org") == "org,example)/" and W.url_key(None) == W.url_key("") == ")/"


def test_awkward_rows_and_empty_tables(spark, tmp_path):
    rows = [(1, None, None), (2, "u\r\nInjected: x", ""), (3, "http://b.org", "z" * 500_000), (3, "http://b.org", "z" * 500_000), (None, "http://c.org", "z" * 500_000), (None, None, None)]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", *[f"1 AS `{c}`" for c in [*CLASHING, "digest", "size", "first"]])
    folder, directory = W.write_warc(spark, pages, str(tmp_path / "a"))
    got = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in W.lookup(pages, folder, directory).collect())
    assert got == Counter({
        (1, 0, "response", None): 1, (2, 0, "revisit", 1): 1, (3, 500_000, "response", None): 2,
        (None, 500_000, "response", None): 1, (None, 0, "response", None): 1,
    })
    folder, directory = W.write_warc(spark, pages.limit(0), str(tmp_path / "b"))
    assert W.lookup(pages, folder, directory).count() == 0
