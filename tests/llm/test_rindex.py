import hashlib
import random

import numpy as np
import pytest

from faresight.llm import rindex as R
from tests.llm.conftest import edge_texts, sentence


def brute(texts, length):
    seen = {}
    for b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for b in texts:
        m = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                m[i] += 1
                m[i + length] -= 1
        cov = np.cumsum(m)[:len(b)] > 0
        kept = bytes(x for x, c in zip(b, cov) if not c)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], cov.astype(int)])) == 1))
        out.append((len(b), int(cov.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(df, rows, length):
    want = sorted((-1 if i is None else i, *x) for (i, _), x in zip(rows, brute([(t or "").encode() for _, t in rows], length)))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.digest(df, length).collect())
    assert got == want


@pytest.mark.parametrize("length", [60, 400])
def test_edges_match_brute_force(edge_docs, length):
    check(edge_docs, edge_texts(), length)


@pytest.mark.parametrize("limit", [1_500_000, 800])
def test_shared_passages_in_many_documents(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "SHARD_BYTES", limit)          # the small limit takes the path of wide minimizers
    passage = sentence(9, 100)
    rows = [(i, sentence(100 + i, 20 + i % 7) + " " + passage[i % 5:] + " " + sentence(300 + i, 30)) for i in range(40)]
    rows += [(100 + i, passage) for i in range(5)] + [(200, "abcabc" * 300), (201, "z" * 1000)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows, 200)


def test_long_document_across_slabs(spark, monkeypatch):
    monkeypatch.setattr(R, "SLAB", 3000)
    a, b = sentence(20, 2500), sentence(21, 900)
    rows = [(1, a + b), (2, b + a[500:4000]), (3, sentence(22, 2000))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 300)


def test_matching_statistics_and_suffix_order():
    r = random.Random(1)
    base = bytes(r.choice(b"abcd") for _ in range(200))
    texts = [base, b"xx" + base[10:150] + b"yy", base[50:180], b"aaaaaaaaaaaa", base[5:199], b""]
    m, off = R.matching_statistics(texts)
    t = b"\0".join(texts) + b"\0"
    end = np.repeat(off[1:] - 1, [len(x) + 1 for x in texts])
    at = [i for i in range(len(t)) if t[i]]
    for i in at:
        best = 0
        for j in at:
            if i != j:
                n, most = 0, min(end[i] - i, end[j] - j)
                while n < most and t[i + n] == t[j + n]:
                    n += 1
                best = max(best, n)
        assert m[i] == best
    sym = np.frombuffer(t, np.uint8).astype(np.uint16) + 1
    sym[off[1:] - 1] = 0
    assert R.suffix_array(sym).tolist() == sorted(range(len(sym)), key=lambda i: sym[i:].tolist())


def test_segments_hold_each_window_once():
    data = np.frombuffer((sentence(30, 800) + "q" * 900).encode(), np.uint8)
    off = np.array([0, 1000, 1100, 2500, len(data)])
    doc, start, n, anchor, h, own = R.segments(data, off, 100, 25)
    seen = [(d, s + k) for d, s, c in zip(doc, start, n) for k in range(c)]
    assert sorted(seen) == [(d, s) for d in range(4) for s in range(int(off[d + 1] - off[d]) - 99)]


def test_remove_repeats_keeps_columns(edge_docs):
    out = R.remove_repeats(edge_docs, 100)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    by = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by[1].text is None and by[7].text == "" and by[4].text == "one" and by[7].n_chars == 0 and sentence(5, 80) in by[12].text


def test_empty(no_docs):
    assert R.digest(no_docs).count() == 0 and R.remove_repeats(no_docs).count() == 0


def test_planted_passages_by_length(spark):
    """Passages of 51 to 90 words, each in two to twelve documents: those of 400 bytes and more
    are removed wherever they stand, shorter ones are below the contract's length and stay."""
    r = random.Random(8)
    rows, planted = [], []
    for k in range(40):
        passage = " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 11))) for _ in range(51 + k))
        planted.append(passage)
        for _ in range(2 + k % 11):
            rows.append((len(rows), sentence(5000 + len(rows), r.randint(5, 60)) + "\n" + passage + "\n" + sentence(9000 + len(rows), r.randint(5, 60))))
    rows += [(len(rows) + i, sentence(20_000 + i, 120)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(df, rows, 400)
    long_ones = [p for p in planted if len(p) >= 400]
    assert 5 < len(long_ones) < len(planted)
    out = {x.doc_id: x for x in R.digest(df, 400).collect()}
    left = {x.doc_id: x.text for x in R.remove_repeats(df, 400).collect()}
    for i, text in rows:
        p = next((p for p in planted if p in text), None)
        caught = p is not None and len(p) >= 400
        assert (p is not None and p not in left[i]) == caught and out[i].n_kept == out[i].n_bytes - out[i].n_removed == len(left[i].encode())
        assert (out[i].n_removed >= len(p)) if caught else out[i].n_removed == 0


def test_digest_returns_the_text_left(spark, edge_docs, monkeypatch):
    """What is left can be read from the result itself: repeated passages are gone from the
    text, rows without repeats keep theirs, split characters go, null gives an empty text."""
    passage, split = sentence(40, 120), "é" * 150
    rows = [(1, sentence(41, 30) + " " + passage + " " + sentence(42, 30)), (2, passage + " " + sentence(43, 40)), (3, sentence(44, 120)),
            (4, None), (5, ""), (6, "a" + split[:110]), (7, "b" + split[:110]), (8, "é" + sentence(45, 90) + "è"), (9, "ê" + sentence(45, 90) + "ë")]
    monkeypatch.setattr(R, "OUT_BYTES", 700)              # more than one batch of results
    out = {r.doc_id: r for r in R.digest(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 200).collect()}
    assert len(out) == len(rows) and passage not in out[1].text + out[2].text
    assert out[1].text.startswith(sentence(41, 30)) and out[2].text.endswith(sentence(43, 40))
    assert out[3].text == rows[2][1] and out[4].text == out[5].text == ""
    assert out[8].text == "é" and out[9].text == "ê" and out[8].n_kept == out[9].n_kept == 3
    for i, t in rows:
        b = (t or "").encode()
        assert out[i].n_bytes == len(b) and out[i].n_kept == len(b) - out[i].n_removed >= len(out[i].text.encode())
        if not out[i].n_removed:
            assert out[i].text.encode() == b and out[i].kept_sha256 == hashlib.sha256(b).hexdigest()
    left = sorted((r.doc_id or -1, r.text or "") for r in R.remove_repeats(edge_docs, 100).collect())
    assert left == sorted((r.doc_id or -1, r.text) for r in R.digest(edge_docs, 100).collect())
