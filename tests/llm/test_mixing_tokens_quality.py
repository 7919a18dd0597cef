import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from faresight.llm import mixing as M, quality as Q, token_counts as T
from faresight.llm.queries import PIECES, tokenizer_path
from tests.llm.conftest import edge_texts, sentence, words


def brute_mix(rows, over, lo=0.0, hi=1.0):
    """Copies of (doc_id, source, tokens) rows at the exponent that halving [0, 1] finds."""
    tok = collections.Counter()
    for _, s, n in rows:
        tok[s] += n
    tok = {s: n for s, n in tok.items() if n}
    total = sum(tok.values())
    p = {s: n / total for s, n in tok.items()}
    weights = lambda t: {s: x ** t / sum(y ** t for y in p.values()) for s, x in p.items()}
    if over(weights(1.0), tok, total):
        t = 1.0
    elif not over(weights(0.0), tok, total):
        t = 0.0
    else:
        for _ in range(M.STEPS):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if over(weights(mid), tok, total) else (lo, mid)
        t = hi
    w, out = weights(t), collections.Counter()
    for s, x in w.items():
        share = math.floor(x * total + 0.5)
        passes, rest = divmod(share, tok[s])
        mine = sorted((hashlib.md5(f"mix|{i if i is not None else ''}".encode()).hexdigest(), -1 if i is None else i, n) for i, q, n in rows if q == s)
        used, sums = 0, {}
        for h, i, n in mine:
            used += n
            sums[i] = used
        for h, i, n in mine:
            out[s, i, n] += passes + (sums[i] <= rest)
    return t, out


def test_copies_match_brute_force(spark):
    r = random.Random(1)
    rows = [(i, f"s{min(7, int(r.expovariate(0.5)))}", r.randint(0, 40)) for i in range(900)] + [(5000, None, 30), (5001, "zero", 0), (None, "s1", 7)]
    df = spark.createDataFrame([(i, s, "w " * n, "x", 1, "y") for i, s, n in rows], "doc_id long, source string, text string, weight string, copies int, block string").repartition(4)
    t, want = brute_mix(rows, lambda w, tok, total: max(w[s] * total / tok[s] for s in tok) > 3.0)
    assert 0 < t < 1
    got = collections.Counter()
    for x in M.mix(df, max_repeat=3.0).collect():
        got[x.source, -1 if x.doc_id is None else x.doc_id, x.n_tokens] += x.copies
        assert (x.weight is None) == (x.source == "zero")
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_entropy_target_is_met(spark):
    rows = [(i, "big" if i % 10 else f"s{i % 30}", "w " * 20) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    w = {r.source: r.weight for r in M.mix(df, min_entropy=0.9).collect()}
    h = -sum(x * math.log(x) for x in w.values()) / math.log(len(w))
    assert sum(w.values()) == pytest.approx(1) and h == pytest.approx(0.9, abs=1e-6)


def test_cover_budget_takes_every_document(spark, edge_docs):
    out = M.realise(edge_docs, budget_tokens="cover", max_repeat=2.0)
    assert out.columns == edge_docs.columns
    n = collections.Counter((r.doc_id, r.text) for r in out.collect())
    have = collections.Counter((r.doc_id, r.text) for r in edge_docs.collect())
    assert set(n) == set(have) and all(have[k] <= n[k] <= 3 * have[k] for k in have)


def test_mix_of_nothing(no_docs):
    assert M.mix(no_docs, max_repeat=2.0).count() == 0 and M.realise(no_docs, "cover", max_repeat=2.0).count() == 0


def greedy(vocabulary, word):
    x, n, i, longest = T.MARK + word, 0, 0, max(map(len, vocabulary))
    while i < len(x):
        for j in range(min(len(x), i + longest), i, -1):
            if x[i:j] in vocabulary:
                break
        else:
            return None
        i, n = j, n + 1
    return n


def test_automaton_is_greedy_longest_match():
    r = random.Random(2)
    for _ in range(40):
        vocabulary = {T.MARK + "".join(r.choice("abcé") for _ in range(r.randint(0, 3))) for _ in range(6)} | {"".join(r.choice("abcé") for _ in range(r.randint(1, 5))) for _ in range(12)}
        a = T.Automaton(sorted(vocabulary))
        texts = ["".join(r.choice("abcé") for _ in range(r.randint(1, 12))) for _ in range(60)]
        b = [t.encode() for t in texts]
        end = np.cumsum([len(x) for x in b])
        got = a.counts(np.frombuffer(b"".join(b), np.uint8), end - [len(x) for x in b], end)
        assert got.tolist() == [greedy(vocabulary, t) or 0 for t in texts]


def test_token_counts_of_documents(edge_docs, no_docs):
    vocabulary = set(T.sentence_pieces(tokenizer_path(PIECES)))
    want = []
    for i, t in edge_texts():
        ws = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", t or "")]
        c = [greedy(vocabulary, w) for w in ws]
        want.append((-1 if i is None else i, len(ws), sum(x or 1 for x in c), sum(x is None for x in c)))
    got = [(-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_tokens, r.n_unknown) for r in T.count_tokens(edge_docs, tokenizer_path(PIECES)).collect()]
    assert sorted(got) == sorted(want)
    assert T.count_tokens(no_docs, tokenizer_path(PIECES)).count() == 0


def test_quality_on_held_out_rows(spark):
    docs = [(i, sentence(i, 60) if i % 3 else sentence(i, 60).upper().replace(" ", "!! ")) for i in range(900)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(900)] + [(1, None, 0), (None, 1, 0)]
    d = spark.createDataFrame([(*x, 0.1, 1, "z") for x in docs], "doc_id long, text string, score double, label int, c0 string").repartition(3)
    r = Q.classify(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).toPandas().sort_values("doc_id")
    assert list(r.held_out) == [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(900)]
    assert (r.predicted == [int(i % 3 > 0) for i in range(900)])[r.held_out].mean() > 0.97
    assert ((r.score >= 0.7) == (r.predicted == 1)).all() and r.score.between(0, 1).all()


def test_quality_learns_word_order(spark):
    """The same words in both classes, in another order."""
    docs, labels = [], []
    for i in range(1200):
        w = sentence(i, 30).split(" ")
        for at in (5, 12, 20):
            w[at:at + 2] = ["north", "wind"] if i % 2 else ["wind", "north"]
        docs.append((i, " ".join(w)))
        labels.append((i, i % 2))
    r = Q.classify(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int")).toPandas().sort_values("doc_id")
    held = r[r.held_out]
    assert ((held.score > 0.5) == (held.doc_id % 2 == 1)).mean() > 0.95


def test_quality_score_from_the_definition(spark, edge_docs):
    """Each score recomputed one feature at a time from the learned arrays."""
    rng = np.random.default_rng(3)
    add, bias = rng.normal(size=Q.BUCKETS), 0.25
    got = sorted(((r.doc_id is None, r.doc_id or 0, round(r.score, 9)) for r in Q.score(edge_docs, (add, bias), ["doc_id"]).collect()))

    def one(word):
        return Q.X.words(np.frombuffer(word, np.uint8), np.array([0, len(word)]), lower=False)[2]
    want = []
    for i, text in edge_texts():
        ws = __import__("re").findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        known = {w: one(w) for w in set(ws)}
        ids = [known[w] for w in ws]
        for a, b in zip(ws, ws[1:]):
            ids.append(Q.X.mix(known[a] * np.uint64(0x9E3779B97F4A7C15) + known[b]))
            if a == b:
                ids.append(np.array([0xA5A5A5A5A5], np.uint64))
        grams = __import__("collections").Counter(w[j:j + k] for w in ws for k in Q.NGRAMS for j in range(len(w) - k + 1))
        total, n = sum(add[int(x[0] % np.uint64(Q.BUCKETS))] for x in ids), len(ids)
        for gram, c in grams.items():
            x = len(gram)
            for b in gram:
                x = (x * 0x100000001B3 + b) % 2**64
            total, n = total + c * add[int(Q.X.mix(np.array([x], np.uint64))[0] % np.uint64(Q.BUCKETS))], n + c
        want.append((i is None, i or 0, round(float(1 / (1 + np.exp(-(bias + total / max(n, 1))))), 9)))
    assert got == sorted(want)


def test_quality_does_not_see_held_out_labels(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lab = spark.read.parquet(f"{sf_dir}/labels.parquet")
    flipped = lab.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    a, b = ({r.doc_id: r.score for r in Q.classify(d, x).collect()} for x in (lab, flipped))
    assert a == b


def test_quality_edges(edge_docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    r = Q.classify(edge_docs, none).collect()
    assert len(r) == edge_docs.count() and all(x.score == 0.5 for x in r) and Q.classify(no_docs, none).count() == 0
    only = spark.createDataFrame([(i, 1) for i in range(1, 20)], "doc_id long, quality int")
    assert all(x.score > 0.9 for x in Q.classify(edge_docs, only).collect())


def test_words_are_counted_as_elsewhere(edge_docs):
    got = sorted((r[0] is None, r[0] or 0, r[1]) for r in edge_docs.select("doc_id", M.words(edge_docs.text)).collect())
    assert got == sorted((i is None, i or 0, len(words(t))) for i, t in edge_texts())


def test_cover_budget_keeps_sources_without_tokens(spark):
    from faresight.llm import mixing
    rows = [(1, "a", "one two three"), (2, "b", None), (3, "b", " "), (4, None, ""), (5, "c", "four")]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for docs, ids in ((d, {1, 2, 3, 4, 5}), (d.filter("doc_id in (2, 3, 4)"), {2, 3, 4})):
        assert {r.doc_id for r in mixing.realise(docs, budget_tokens="cover", max_repeat=2.0).collect()} == ids
        copies = {r.doc_id: r.copies for r in mixing.mix(docs, budget_tokens="cover", max_repeat=2.0).collect()}
        assert set(copies) == ids and copies[2] == copies[3] == copies[4] == 1
