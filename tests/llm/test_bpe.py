import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from faresight.llm import bpe, queries as Q

from .conftest import edge_texts

PATH = Q.tokenizer_path(Q.BYTE_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encode_all(texts):
    raw = [t.encode("utf-8") for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, at = bpe.encode_texts(bpe.model(PATH), np.frombuffer(b"".join(raw), np.uint8), off)
    return [ids[s:e].tolist() for s, e in zip(at[:-1], at[1:])]


def same(library, texts):
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, want, encode_all(texts)) if a != b] == []


def test_every_code_point_splits_like_the_library(library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 50_000):
        same(library, [f"a{chr(c)}a 1{chr(c)}1 !{chr(c)}! {chr(c)}" for c in points[lo:lo + 50_000]])


def test_random_texts(library):
    r = random.Random(3)
    parts = ["'s", "'re", "'ll", "'", "''", " ", "  ", "\n", "\t", "\r\n", "a", "the", "ing", "1", "23", "!", "...", "é", "ß", "東京", " ", "　", "\x1c",
             "\x85", "<|endoftext|>", "<|endof", "text|>", "🙂", "́", "re", "'t", "don't", "'D", "\x00", "_", "'ve", "'m'd"]
    same(library, ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(5000)])


def test_long_fragments_and_edges(library):
    same(library, [t or "" for _, t in edge_texts()] + ["x" * 50_000, "ab" * 20_000, " " * 3000 + "a", "\n" * 999, "qzqxjq" * 900, "", "<|endoftext|>" * 3, "the" * 9000])


def test_forced_cuts_are_inside_no_token(library):
    m = bpe.model(PATH)
    r = random.Random(5)
    text = "".join(chr(r.choice([r.randint(32, 126), r.randint(160, 0x2FF), r.randint(0x4E00, 0x4F00)])) for _ in range(20_000))
    data = np.frombuffer(text.encode(), np.uint8)
    cuts = set(m.cuts(data, np.array([0, len(data)])).tolist())
    off = np.cumsum([0] + [len(m.texts(np.array([i]), np.array([0, 1]))[0]) for i in encode_all([text])[0]])
    assert cuts <= set(off.tolist())                  # no token crosses a cut
    assert 0 < m.forced.mean() < 1
    forced = np.flatnonzero(m.forced[data[:-1], data[1:]]) + 1
    assert len(forced) and set(forced.tolist()) <= cuts


def test_small_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 10)
    bpe.model(PATH)._reset()
    same(library, ["one two three four five six seven eight nine ten eleven twelve", "one two", "thirteen fourteen one"])


def test_digest_encode_decode(spark, edge_docs, library):
    texts = sorted(((i, t or "") for i, t in edge_texts()), key=repr)
    ids = [library.encode(t, add_special_tokens=False).ids for _, t in texts]
    want = sorted(((i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(library.decode(x, skip_special_tokens=False).encode()).hexdigest()) for (i, _), x in zip(texts, ids)), key=repr)
    got = sorted((tuple(r) for r in bpe.digest(edge_docs, PATH).collect()), key=repr)
    assert got == want
    coded = bpe.encode(edge_docs, PATH)
    assert sorted(((r["doc_id"], r["ids"]) for r in coded.collect()), key=repr) == sorted(((i, x) for (i, _), x in zip(texts, ids)), key=repr)
    assert sorted((tuple(r) for r in bpe.decode(coded, PATH).collect()), key=repr) == texts


def test_decode_of_arbitrary_ids(spark, library):
    rows = [(1, [220, 50256, 0]), (2, [447, 247]), (3, [447]), (4, []), (5, None), (6, [None, 1, 60_000, -3]), (None, [10])]
    got = {r["doc_id"]: r["text"] for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    for i, ids in rows[:4]:
        assert got[i] == library.decode(ids, skip_special_tokens=False)
    assert got[5] == "" and got[6] == library.decode([1]) and got[None] == library.decode([10])


def test_empty_table(spark, no_docs):
    assert bpe.digest(no_docs, PATH).collect() == [] and bpe.encode(no_docs, PATH).collect() == []


def test_query(spark, sf_dir, library):
    got = {r["doc_id"]: r for r in Q.op13_forced_boundary_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
