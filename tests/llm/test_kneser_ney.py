import collections
import math
import zlib

import numpy as np
import pytest

from faresight.llm import kneser_ney as K
from tests.llm.conftest import edge_texts, sentence, words


def brute(rows):
    """Scores by dictionaries, straight from the formulas."""
    toks = [(i, [*words(t), "</s>"]) for i, t in rows]
    train = [ts for i, ts in toks if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    c = collections.Counter(w for ts in train for w in ts)
    total, distinct = sum(c.values()), len(c)
    big = collections.Counter(p for ts in train for p in zip(["<s>", *ts], ts))
    cu, n, cont = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0, 0]), collections.Counter()
    for (u, w), x in big.items():
        cu[u] += x
        n[u][min(x, 3)] += 1
        cont[w] += 1
    d2 = [0, *K.discounts([sum(x == k for x in big.values()) for k in (1, 2, 3, 4)])]
    d1 = [0, *K.discounts([sum(x == k for x in cont.values()) for k in (1, 2, 3, 4)])]
    pairs = sum(cont.values())
    rest = sum(d1[min(x, 3)] for x in cont.values()) / pairs if pairs else 1.0

    def p(u, w):
        low = (cont[w] - d1[min(cont[w], 3)] if cont[w] else 0) / max(1, pairs) + rest / (distinct + 1)
        if not cu[u]:
            return low
        b = big[u, w]
        return (b - d2[min(b, 3)] if b else 0) / cu[u] + sum(d2[k] * n[u][k] for k in (1, 2, 3)) / cu[u] * low

    out = []
    for i, ts in toks:
        out.append((i, len(ts), sum(c[w] > 0 for w in ts), total, sum(math.log10((c[w] + .5) / (total + .5 * (distinct + 1))) for w in ts),
                    sum(math.log10(p(u, w)) for u, w in zip(["<s>", *ts], ts))))
    return out, p, c


def check(df, rows):
    want, _, _ = brute(rows)
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in K.score_documents(df).collect()]
    order = lambda x: (-1 if x[0] is None else x[0], x[1], x[5])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=order), sorted(want, key=order)):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_edges_match_brute_force(edge_docs):
    check(edge_docs, edge_texts())


def test_frequent_words_are_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(K, "SHARD_TOKENS", 300)
    monkeypatch.setattr(K, "RUN_TOKENS", 500)
    rows = [(i, " ".join(("the " + w) if k % 3 else w for k, w in enumerate(sentence(i % 37, 60).split()))) for i in range(120)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_probabilities_sum_to_one():
    _, p, c = brute([(i, sentence(i % 5, 80)) for i in range(30)])
    for u in ["<s>", *list(c)[:20], "never"]:
        assert sum(p(u, w) for w in c) + p(u, "unknown word") == pytest.approx(1)


def test_held_out_text_is_better_than_the_base(spark, sf_dir):
    r = K.score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).filter("held_out").toPandas()
    assert len(r) > 10 and r.score.sum() > 1.02 * r.base_score.sum() and (r.score > r.base_score).mean() > 0.9


def test_empty_and_untrained(no_docs, spark):
    assert K.score_documents(no_docs).count() == 0
    r = K.score_documents(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).first()
    assert r.held_out is None and r.train_tokens == 0 and r.n_tokens == 3 and r.score == 0.0


def test_discounts_fall_back_on_few_counts():
    assert K.discounts([0, 0, 0, 0]) == [0.5, 1.0, 1.5]
    assert all(0 < d < k + 1 for k, d in enumerate(K.discounts([100, 40, 20, 10])))
    assert K.small_counts(np.array([1, 300])).dtype == np.uint16
