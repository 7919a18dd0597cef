import numpy as np

from faresight.llm import minhash as M, textnum as X
from tests.llm.conftest import edge_texts, edit, sentence, words


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = shingles(t, k)
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(df, rows, k, percent=80):
    want = brute(rows, k, percent)
    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept is False
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id), r


def test_edges_match_brute_force(edge_docs):
    check(M.near_duplicates(edge_docs, words=4), edge_texts(), 4)


def test_chain_and_hot_groups(spark):
    base = sentence(50, 120)
    rows = [(i, edit(base, i, 25)) for i in range(60)]               # similarities around the threshold
    rows += [(100 + i, base) for i in range(40)]
    chain = sentence(51, 200).split(" ")
    rows += [(200 + i, " ".join(chain[6 * i:6 * i + 110])) for i in range(14)]   # each links with its neighbours
    check(M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words=5), rows, 5)


def test_tiles_split_large_groups(spark, monkeypatch):
    monkeypatch.setattr(M, "TILE", 8)
    base = sentence(60, 100)
    rows = [(i, edit(base, i, 18)) for i in range(80)]
    check(M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4), rows, 4)


def test_empty(no_docs):
    out = M.near_duplicates(no_docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0


def test_signature_is_an_unbiased_estimate():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    a, b = np.sort(pool[:1250]), np.sort(pool[125:])
    s = M.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    true = 1125 / 1500
    assert abs((s[0] == s[1]).mean() - true) < 0.13
    assert M.common(a, b) == 1125


def test_word_hashes_follow_the_definition():
    t = "Ab  c d\tÉ\nab".encode()
    s, e, h, wo = X.words(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
    assert [t[a:b].lower() for a, b in zip(s, e)] == words(t.decode()) and h[0] == h[-1] and len(set(h.tolist())) == len(h) - 1


def test_link_with_a_low_estimate_is_confirmed_on_full_sets():
    import numpy as np
    from faresight.llm.minhash import tile_edges
    sets = [np.arange(90, dtype=np.uint64), np.arange(10, 100, dtype=np.uint64)]       # 80 of 100: similarity 0.8
    sigs = np.zeros((2, 128), np.uint32)
    sigs[1, 80:] = 1                                                                   # estimate 0.625
    assert tile_edges(np.array([1, 2]), np.array([1, 2]), np.zeros(2, int), sigs, sets, 80) == [(1, 2)]
