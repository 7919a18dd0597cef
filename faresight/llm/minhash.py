"""MinHash near-dedup by min-max hashing.

Each permutation of the shingle space gives two signature values, the smallest and the
largest hash, so half the hash evaluations give the same number of values, each an unbiased
witness of the Jaccard similarity. Signatures are banded; documents that share a band are
candidates; every link is confirmed on the full shingle sets.

Plan (n documents):

1. One Arrow pass makes a narrow row per document (set size, 128-bit set fingerprint, band
   keys, signature), written as a table. Equal sets are collapsed to their smallest doc_id.
2. Per band key one partial aggregate finds the hub (smallest document); every other member
   is a (member, hub) pair. Members that a signature puts clearly below the threshold are
   not confirmed; the rest are, on full sets. Connected components of the links.
3. A hub's group holds every pair of documents that share one of its buckets. Groups whose
   members are still in several components are compared completely: tiles of bounded size,
   signatures first, full sets next, and only pairs of different components. A tile returns
   the edges that join its components, never its pairs. Components again.
4. Members of collapsed sets get their representative's component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from faresight.llm import textnum as X
from faresight.llm.common import Workspace, components, join_back

PERMUTATIONS = 64
ROWS = 4
SLACK = 0.21   # an estimate from 128 values at 0.8 is lower by more with probability 3e-8 (binomial), less than the bands' 5e-8
TILE = 256
_rng = np.random.default_rng(77)
_A = _rng.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def signatures(s: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, 2 * PERMUTATIONS) uint32: minima, then maxima, of every permutation."""
    docs = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, 2 * PERMUTATIONS), np.uint32)
    if len(docs):
        at = offsets[docs]
        for p in range(PERMUTATIONS):
            v = s * _A[p] + _B[p]
            out[docs, p] = X.mix(np.minimum.reduceat(v, at)) & np.uint64(0xFFFFFFFF)
            out[docs, PERMUTATIONS + p] = X.mix(np.maximum.reduceat(v, at)) & np.uint64(0xFFFFFFFF)
    return out


def _sketch(words: int):
    def run(batches):
        for batch in batches:
            data, off = X.utf8(batch.column(1))
            for d, e in X.groups(off):
                _, _, h, wo = X.words(data, off[d:e + 1])
                s, so = X.shingle_sets(h, wo, words)
                n = np.diff(so)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(s, dtype=np.uint64)])
                sums2 = np.concatenate([np.zeros(1, np.uint64), np.cumsum(X.mix(s ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
                f1, f2 = (X.mix(c[so[1:]] - c[so[:-1]] + n.astype(np.uint64)) for c in (sums, sums2))
                sig = signatures(s, so)
                nb = 2 * PERMUTATIONS // ROWS
                # a band mixes minima and maxima of different permutations
                order = np.arange(2 * PERMUTATIONS).reshape(ROWS, nb).T
                keys = np.empty((e - d, nb), np.int64)
                for b in range(nb):
                    k = np.full(e - d, b + 1, np.uint64)
                    for j in order[b]:
                        k = X.mix(k ^ sig[:, j].astype(np.uint64)) + np.uint64(b)
                    keys[:, b] = k.view(np.int64)
                full = np.concatenate([[0], np.cumsum(np.where(n > 0, nb, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(full), pa.array(keys[n > 0].ravel()))
                sigs = X.binaries(sig.ravel(), np.arange(e - d + 1) * sig.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(d, e - d), pa.array(n.astype(np.int64)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), bands, sigs],
                    names=["doc_id", "n", "f1", "f2", "bands", "sig"])
    return run


def _sets(words: int):
    def run(batches):
        for batch in batches:
            data, off = X.utf8(batch.column(1))
            for d, e in X.groups(off):
                _, _, h, wo = X.words(data, off[d:e + 1])
                s, so = X.shingle_sets(h, wo, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(d, e - d), X.binaries(s, so), batch.column(2).slice(d, e - d)], names=["doc_id", "shingles", "sig"])
    return run


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    c = common(a, b)
    return 100 * c >= percent * (len(a) + len(b) - c)


def _confirm(percent: int):
    def run(batches):
        for b in batches:
            s1, s2 = b.column(2), b.column(3)
            keep = [i for i in range(b.num_rows) if linked(np.frombuffer(s1[i].as_buffer(), np.uint64), np.frombuffer(s2[i].as_buffer(), np.uint64), percent)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), b.column(1).take(pa.array(keep, pa.int64()))], names=["u", "v"])
    return run


def tile_edges(ids, comp, side, sigs, sets, percent: int) -> list[tuple[int, int]]:
    """Edges that join different components inside one tile (side 0: both blocks are the
    same; else pairs of a side-1 and a side-2 member). Most similar signatures come first;
    a pair whose components have met is skipped."""
    low = percent / 100 - SLACK
    parent: dict[int, int] = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    left = np.flatnonzero(side <= 1)
    right = np.flatnonzero((side == 0) | (side == 2))
    sizes = np.array([len(s) for s in sets])
    found, pairs = [], []
    for i in left:
        js = right[right > i] if side[i] == 0 else right
        js = js[(comp[js] != comp[i]) & (100 * np.minimum(sizes[js], sizes[i]) >= percent * np.maximum(sizes[js], sizes[i]))]
        if len(js):
            est = (sigs[js] == sigs[i]).mean(axis=1)
            ok = est >= low
            pairs.append(np.stack([est[ok], np.full(ok.sum(), i), js[ok]]))
    if not pairs:
        return found
    p = np.concatenate(pairs, axis=1)
    for k in np.argsort(-p[0], kind="stable"):
        i, j = int(p[1, k]), int(p[2, k])
        a, b = root(comp[i]), root(comp[j])
        if a != b and linked(sets[i], sets[j], percent):
            parent[max(a, b)] = min(a, b)
            found.append((int(ids[i]), int(ids[j])))
    return found


def _tiles(percent: int):
    def run(pdf):
        import pandas as pd
        pdf = pdf.drop_duplicates("doc").sort_values("doc")
        sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        sigs = np.stack([np.frombuffer(x, np.uint32) for x in pdf["sig"]])
        e = tile_edges(pdf["doc"].to_numpy(), pdf["comp"].to_numpy(), pdf["side"].to_numpy(), sigs, sets, percent)
        return pd.DataFrame(e, columns=["u", "v"], dtype="int64")
    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered; the set holds the distinct
    ``words``-word shingles (fewer words: the whole sequence; none or null: the empty set,
    linked with nothing). Links: 100 * |intersection| >= percent * |union|, confirmed on full
    sets. component_id is the smallest doc_id reachable; kept = (doc_id = component_id).
    Repeated rows of one doc_id are returned each, as one node. A null doc_id takes no part:
    component_id null, kept false. Other columns of ``docs`` are not read. An empty table
    gives an empty result."""
    spark = docs.sparkSession
    ws = Workspace(spark, "minhash")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    t = ws.table(src.mapInArrow(X.tidy(_sketch(words)), "doc_id long, n long, f1 long, f2 long, bands array<long>, sig binary"), "sketch")
    sets = ws.table(t.filter("n > 0 and doc_id is not null").groupBy("f1", "f2", "n")
                    .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("cnt")), "sets")
    reps = ws.table(t.filter("n > 0 and doc_id is not null").select("doc_id", "bands")
                    .join(sets.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
                    .select("doc_id", F.explode("bands").alias("band")), "bands")
    buckets = ws.table(reps.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("cnt")).filter("cnt > 1"), "buckets")
    total = buckets.agg(F.sum("cnt")).first()[0] or 0
    member = ws.table(join_back(reps, buckets, ["band"], total).select("doc_id", "hub").distinct(), "members")

    sig = t.select("doc_id", "sig")
    ids = ws.table(member.select("doc_id").unionByName(member.select(F.col("hub").alias("doc_id"))).distinct(), "candidates")
    v = ws.table(src.join(ids, "doc_id", "left_semi").join(sig.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "doc_id")
                 .mapInArrow(X.tidy(_sets(words)), "doc_id long, shingles binary, sig binary"), "shingles")
    pairs = member.filter("doc_id <> hub")
    hubs = ws.table(pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("cnt")), "hubs")
    n_pairs = hubs.agg(F.sum("cnt")).first()[0] or 0
    hub_sets = ws.table(v.join(hubs, v.doc_id == hubs.hub).select("hub", "cnt", F.col("shingles").alias("s2")), "hub-sets")
    with_doc = pairs.join(v.select("doc_id", F.col("shingles").alias("s1")), "doc_id")
    links = ws.table(_spread(with_doc, hub_sets, n_pairs).select("doc_id", "hub", "s1", "s2")
                     .mapInArrow(_confirm(percent), "u long, v long"), "links")
    comp = components(ws, links)

    nodes = ws.table(member.join(comp.select(F.col("node").alias("doc_id"), F.col("component").alias("c")), "doc_id", "left")
                     .select("hub", "doc_id", F.coalesce("c", "doc_id").alias("comp")), "nodes")
    open_ = ws.table(nodes.groupBy("hub").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("cnt"))
                     .filter("lo <> hi and cnt > 2").select("hub", "cnt", F.ceil(F.col("cnt") / TILE).cast("int").alias("nb")), "open")
    n_open = open_.agg(F.sum("cnt")).first()[0] or 0
    m = join_back(nodes, open_, ["hub"], n_open).withColumn("blk", F.pmod(F.xxhash64("doc_id"), F.col("nb")).cast("int"))
    tile = m.select("doc_id", "comp", "hub", "blk", F.explode(F.expr("sequence(0, nb - 1)")).alias("o")) \
        .select(F.col("doc_id").alias("doc"), "comp", "hub", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"),
                F.expr("case when blk = o then 0 when blk < o then 1 else 2 end").alias("side"))
    more = ws.table(tile.join(v, tile.doc == v.doc_id).select("hub", "i", "j", "doc", "comp", "side", "sig", "shingles")
                    .groupBy("hub", "i", "j").applyInPandas(_tiles(percent), "u long, v long"), "more-links")
    comp = ws.table(components(ws, links.unionByName(more)), "components")

    final = ws.table(sets.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
                     .select("f1", "f2", "n", "cnt", F.coalesce("component", "rep").alias("component_id")), "classes")
    ws.drop(reps, buckets, member, ids, v, hubs, hub_sets, links, nodes, open_, more, comp, sets)
    base = t.select("doc_id", "n", "f1", "f2")
    out = join_back(base.filter("n > 0 and doc_id is not null"), final, ["f1", "f2", "n"], max(1, final.agg(F.sum("cnt")).first()[0] or 0))
    alone = base.filter("n = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    out = out.select("doc_id", "n", "component_id").unionByName(alone.select("doc_id", "n", "component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _spread(pairs: DataFrame, hub_sets: DataFrame, total: int) -> DataFrame:
    """Pairs joined with their hub's set. Hubs of 1/1000 of all pairs or more are spread over
    64 salts (a set is too large to broadcast a thousand of them unchecked)."""
    from faresight.llm.common import HEAVY
    hot = hub_sets.filter(F.col("cnt") * HEAVY >= F.lit(total)).select("hub", "s2")
    names = F.broadcast(hot.select("hub"))
    salted = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
    a = pairs.join(names, "hub", "left_semi").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(64)).cast("int")).join(salted, ["hub", "salt"]).drop("salt")
    b = pairs.join(names, "hub", "left_anti").join(hub_sets.select("hub", "s2").join(names, "hub", "left_anti"), "hub")
    return a.unionByName(b)
