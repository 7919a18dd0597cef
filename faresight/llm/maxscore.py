"""Exact top-k inner products by MaxScore over shards.

A vector's integer components are the impacts of one term per dimension. A shard holds the
postings of a bounded block of vectors, dimension by dimension, with the least and greatest
contribution each term can make. Query at a time: a seed block gives a first threshold; the
terms are split by their bounds into essential ones, whose postings are traversed, and
non-essential ones, which together cannot lift a vector over the threshold and are only
probed for vectors that are still competitive. Shards return their k best; a window of
shards x k rows a query merges them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from faresight.llm.common import Workspace

SHARD = 4096
QUERIES = 2048
SEED = 128
PROBE = 8


class Shard:
    """Postings of a block of vectors: (dimension, vector) integers. ``own``: row numbers that
    tell vectors of one id apart (default: the ids)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, own: np.ndarray | None = None):
        own = ids if own is None else own
        order = np.lexsort((own, ids))
        self.own = own[order]
        self.ids, self.post = ids[order], np.ascontiguousarray(rows[order].T)
        self.low, self.high = self.post.min(axis=1), self.post.max(axis=1)

    def top(self, query: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best vectors, row ``query`` left out; ties to smaller ids."""
        a, b = q * self.low, q * self.high
        floor, bound = np.minimum(a, b), np.abs(b - a)             # every impact is counted from its floor
        terms = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)   # bound of terms[i:]
        base = int(floor.sum())
        every = np.flatnonzero(self.own != query)
        if len(every) <= k:
            return self._best(every, q @ self.post[:, every], k)
        lead = terms[0]
        seed = every[np.argpartition(-(q[lead] * self.post[lead, every]), min(SEED, len(every) - 1))[:SEED]]
        seed_scores = q @ self.post[:, seed]
        threshold = np.partition(seed_scores, -k)[-k] if len(seed) >= k else np.iinfo(np.int64).min
        # essential: the fewest leading terms whose complement cannot reach the threshold
        split = int(np.searchsorted(-(rest + base), -threshold, side="right")) if threshold > base else len(terms)
        split = max(1, min(split, len(terms)))
        alive, score = every, np.full(len(every), base, np.int64)
        at = 0
        while at < len(terms):
            step = terms[at:max(min(split, at + 2 * PROBE), at + PROBE)]
            score = score + q[step] @ self.post[np.ix_(step, alive)] - int(floor[step].sum())
            at += len(step)
            keep = score + rest[at] >= threshold
            alive, score = alive[keep], score[keep]
            if len(alive) > k:
                threshold = max(threshold, np.partition(score, -k)[-k])   # floors of the rest are counted: a true lower bound
        return self._best(alive, score, k)

    def _best(self, at, score, k):
        order = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at][order], score[order]


def _search(k: int):
    def run(key, docs, queries):
        import pandas as pd
        out = []
        if len(docs) and len(queries):
            dim = max(docs["v"].map(len).max(), queries["v"].map(len).max())
            fill = lambda col: np.stack([np.pad(np.asarray(v, np.int64), (0, dim - len(v))) for v in col])
            s = Shard(docs["vec_id"].to_numpy(), fill(docs["v"]), docs["row"].to_numpy())
            for row, qid, q in zip(queries["row"].to_numpy(), queries["query_id"].to_numpy(), fill(queries["v"])):
                ids, score = s.top(row, q, k)
                out += [(row, qid, i, x) for i, x in zip(ids.tolist(), score.tolist())]
        return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"], dtype="int64")
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every query.

    Both inputs have ``row`` long (a number of its own for every row, the same in both),
    ``vec_id`` long and ``v`` array<long> (no nulls); shorter vectors count as padded with zeros.
    Every row is a vector of its own: the query's own row alone is left out, so another row of
    its vec_id is a candidate, a vec_id that several rows hold can stand in a list several times,
    and each query row has its own list. Ties go to the smaller vec_id; with fewer than k
    candidates all are returned. Empty inputs give an empty result. Integers are exact below
    2**63."""
    n, m = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-m // QUERIES))
    d = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    q = queries.withColumnRenamed("vec_id", "query_id").withColumn("blk", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    best = d.groupBy("shard", "blk").cogroup(q.groupBy("shard", "blk")).applyInPandas(_search(k), "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def integer_vectors(df: DataFrame, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id and v = floor(scale * component) of rows whose id and vector are not null and
    whose components are all finite."""
    v = F.col(vec_col).cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull()
        & F.forall("x", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))) \
        .select("vec_id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def search(df: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Queries: rows whose vec_id is divisible by ``every``; candidates: every row but the
    query's own. Rules as in ``integer_vectors`` and ``top_k``."""
    v = Workspace(df.sparkSession, "maxscore").table(integer_vectors(df).withColumn("row", F.monotonically_increasing_id()), "vectors")
    return top_k(v, v.filter(F.col("vec_id") % every == 0), k)
