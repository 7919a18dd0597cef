import hashlib

import pytest

from faresight.llm import warc as W
from faresight.llm.common import Workspace

LONG, OTHER = "<p>same page</p>" * 20, "<p>Größe 東京</p>" * 20
ROWS = [(5, "http://www.a.org/x", LONG), (3, "https://b.a.org:8080/y?q=1", LONG), (9, None, LONG), (4, "http://www.a.org/x", "short"), (2, "http://www.a.org/x", "short"),
        (7, "http://c.net/", None), (8, "", ""), (10, "not a url\twith\nbreaks", OTHER), (11, "http://c.net/ü", OTHER), (None, "http://c.net/n", LONG),
        (12, "http://h.net/" + "z" * 3000, "w" * 2_000_000), (3, "https://b.a.org:8080/y?q=1", LONG)]
SCHEMA = "page_id long, url string, html string, key string, file string, digest string, row int, cnt int"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "k", "f", "d", 1, 2) for r in ROWS], SCHEMA).repartition(3)


def expected():
    out = []
    for i, _, h in ROWS:
        b = (h or "").encode()
        same = [j for j, _, g in ROWS if j is not None and g == h]
        first = min(same) if i is not None and len(b) >= 100 else i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    return out


def test_round_trip(pages):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in W.round_trip(pages).collect()), key=key) == sorted(expected(), key=key)


def test_index_finds_every_capture_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_LINES", 3)
    monkeypatch.setattr(W, "ROTATE", 2000)
    rows = [(i, f"http://h{i % 7}.example.org/{i % 11}", f"page {i % 50} " * 20) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    ws = Workspace(spark, "warc-test")
    captures, archives = W.write_archives(df, ws)
    index, ranges = W.build_index(captures, ws)
    assert captures.select("file").distinct().count() > 4 and len(ranges) > 1
    got = {r.page_id: r for r in W.read_back(captures, archives, index, ranges).collect()}
    for i, _, h in rows:
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(h), hashlib.sha256(h.encode()).hexdigest())
        assert got[i].refers_to == (None if i < 50 else i % 50)
    one = W.CaptureIndex(index, ranges[0][1])
    assert one.find("") is None and one.find("org,nowhere)/ 1") is None


def test_records_parse_and_damage_is_seen():
    m = W.gzip_member(W.record("7.0", "http://a.org/", b"body", hashlib.sha256(b"body").hexdigest(), None))
    assert W.parse(m)["payload"] == b"body" and W.parse(m)["url"] == "http://a.org/"
    with pytest.raises(ValueError):
        W.parse(W.gzip_member(W.record("7.0", "http://a.org/", b"body", "0" * 64, None)))


def test_reversed_host_keys():
    assert W.surt("https://www.a.org/x?y") == "org,a,www)/x?y" and W.surt("http://A.org:81") == "org,a:81)/" and W.surt(None) == "" and W.surt("plain") == "plain"


def test_empty(spark):
    assert W.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
