import math

import numpy as np
import pytest

from faresight.llm import embed_dedup as D, maxscore as S


def vectors(n=300, dim=12, seed=0):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centre[i % 12] + r.normal(size=dim) * (0.05 if i % 2 else 0.45)
        rows.append((i, [float(x) for x in v], int(i % 3)))
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(25)]                # equal vectors
    rows += [(2000, None, 1), (2001, [0.0] * dim, 1), (2002, [None] + [1.0] * (dim - 1), 1), (2003, [math.nan] + [1.0] * (dim - 1), 0),
             (2004, [math.inf] + [1.0] * (dim - 1), 0), (2005, rows[7][1], None), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (2008, [], 1),
             (None, rows[7][1], rows[7][2]), (2009, [x * 1e200 for x in rows[7][1]], rows[7][2]), (2010, [x * 1e-200 for x in rows[7][1]], rows[7][2]),
             (7, rows[7][1], rows[7][2])]                                           # a repeated row
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int"


def frame(spark, rows):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("v", "rep", "cnt", "cell", "first", "links", "query_id")}).repartition(4)


def brute_links(rows, threshold):
    good = [(i, np.array(v), c) for i, v, c in rows if i is not None and c is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, comp = {}, {}
    ids = sorted({i for i, _, _ in rows if i is not None})
    comp = {i: i for i in ids}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    n = [0] * len(good)
    for a in range(len(good)):
        for b in range(a):
            (i, x, c), (j, y, d) = good[a], good[b]
            if c == d and len(x) == len(y):
                x, y = x / abs(x).max(), y / abs(y).max()
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    p, q = root(i), root(j)
                    comp[max(p, q)] = min(p, q)
    for (i, _, _), k in zip(good, n):
        links.setdefault(i, k)
    return {i: (links.get(i, 0), root(i)) for i in ids}


@pytest.mark.parametrize("threshold,block", [(0.93, 1024), (0.93, 16), (0.75, 32)])
def test_links_match_brute_force(spark, monkeypatch, threshold, block):
    monkeypatch.setattr(D, "BLOCK", block)
    rows = vectors()
    want = brute_links(rows, threshold)
    got = D.near_duplicates(frame(spark, rows), threshold).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.n_links, r.component_id) == want[r.vec_id] and r.kept == (r.vec_id == r.component_id), r


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert D.near_duplicates(none).count() == 0 and S.search(none).count() == 0
    assert D.near_duplicates(spark.createDataFrame([(1, None, 1)], SCHEMA)).first().kept


def brute_top(rows, every, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(good):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(good) if m != n)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard,queries", [(4096, 2048), (40, 3)])
def test_search_matches_brute_force(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(S, "SHARD", shard)
    monkeypatch.setattr(S, "QUERIES", queries)
    rows = [r for r in vectors(seed=3) if r[0] not in (2009, 2010)] + [(3000 + i, [0.25] * 12, 0) for i in range(30)]
    rows += [r for r in rows if r[0] in (20, 21, 40)] + [(20, [0.5] * 12, 0), (60, rows[5][1], 1), (61, rows[5][1], 1)]     # repeated rows, ids of several vectors
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in S.search(frame(spark, rows), every=20, k=10).collect())
    assert got == brute_top(rows, 20, 10)


def test_repeated_rows_are_vectors_of_their_own(spark):
    rows = [(100, [1.0, 0.0], 0), (100, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [0.25, 0.5], 0)]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in S.search(frame(spark, rows)).collect())
    assert got == sorted([(100, 1, 100, 1048576), (100, 2, 1, 524288), (100, 3, 2, 262144)] * 2)
    two = [(100, [1.0, 0.0], 0), (100, [0.0, 1.0], 0), (1, [0.5, 0.25], 0)]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in S.search(frame(spark, two)).collect())
    assert got == sorted([(100, 1, 1, 524288), (100, 2, 100, 0), (100, 1, 1, 262144), (100, 2, 100, 0)])


def test_few_candidates(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)]
    assert [tuple(r) for r in S.search(frame(spark, rows)).orderBy("rank").collect()] == [(0, 1, 1, 524288), (0, 2, 2, 524288)]


def test_shard_prunes_and_stays_exact():
    r = np.random.default_rng(5)
    rows = (r.normal(size=(3000, 32)) * np.geomspace(400, 4, 32)).astype(np.int64)
    s = S.Shard(np.arange(3000), rows)
    for i in range(0, 3000, 150):
        ids, score = s.top(i, rows[i], 10)
        full = rows @ rows[i]
        full[i] = -2**62
        want = np.lexsort((np.arange(3000), -full))[:10]
        assert ids.tolist() == want.tolist() and score.tolist() == full[want].tolist()
