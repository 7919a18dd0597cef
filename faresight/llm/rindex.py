"""Removal of long repeated byte strings with a run-length index.

A string of ``length`` bytes repeats when it starts at two places of the corpus. To keep the
work linear, every window (string of that length) is routed by its minimizer, the smallest
hash of its k-byte strings: equal windows have equal minimizers, and consecutive windows that
share one form a segment, about one per 185 bytes at length 400.

1. One Arrow pass cuts the documents into segments (narrow rows, no text). Minimizers that
   occur once cannot repeat and are dropped; equal segments are one class, and a class of two
   or more occurrences repeats as a whole.
2. Classes that share a minimizer but differ are compared in shards of bounded size. A shard
   builds the run-length Burrows-Wheeler transform of its segments with the suffix positions
   sampled at run ends; the longest match is computed at the run ends only and follows along
   the text (it falls by one per byte inside a run), which gives the matching statistics of
   every position. Positions that match another for ``length`` bytes are marked.
3. Minimizers whose classes exceed a shard (a passage shared by very many documents) are
   split by the hash of each whole window instead, an aggregate without a large group.
4. Marked windows are mapped to every occurrence of their class and merged by document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faresight.llm import textnum as X
from faresight.llm.common import Workspace, join_back

LENGTH = 400
GRAM = 32
MAX_WINDOWS = 2048
SHARD_BYTES = 1_500_000
SLAB = 1 << 19
OUT_BYTES = 1 << 23


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    n = len(v)
    m = -(-n // w) * w
    p = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    p[:n] = v
    blocks = p.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def prefix_hash(b: np.ndarray):
    p, ip = X.powers(len(b) + 1)
    c = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(X._BYTE[b] * p[:-1], out=c[1:])
    return c, ip


def segments(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Segments of the documents: (document, start, windows, anchor, hash, own repeat) arrays."""
    found = []
    lo, hi = int(off[0]), int(off[-1])
    p = lo
    while p < hi:
        q = min(p + SLAB, hi)
        b = data[p:min(q + length - 1, hi)]
        nw = len(b) - length + 1
        if nw > 0:
            c, ip = prefix_hash(b)
            g = X.mix((c[gram:] - c[:-gram]) * ip[:len(b) - gram + 1])
            m = sliding_min(g, length - gram + 1)[:nw]
            at = np.arange(p, p + nw)
            doc = np.searchsorted(off, at, side="right") - 1
            valid = at + length <= off[doc + 1]
            first = np.ones(nw, bool)
            first[1:] = (m[1:] != m[:-1]) | (doc[1:] != doc[:-1]) | ~valid[:-1]
            run = np.arange(nw) - np.maximum.accumulate(np.where(first, np.arange(nw), 0))
            start = np.flatnonzero(valid & (first | (run % MAX_WINDOWS == 0)))
            if len(start):
                ends = np.flatnonzero(valid & np.append(~valid[1:] | first[1:] | (run[1:] % MAX_WINDOWS == 0), True)) + 1
                n = ends - start
                h = X.mix((c[start + n + length - 1] - c[start]) * ip[start] + n.astype(np.uint64))
                found.append((doc[start], at[start] - off[doc[start]], n, m[start], h, twice(g, m, start, n, length - gram + 1)))
        p = q
    return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 6


def twice(g: np.ndarray, m: np.ndarray, start: np.ndarray, n: np.ndarray, w: int) -> np.ndarray:
    """Whether a segment's minimizer occurs at two places in it: only then can two windows of
    one segment be equal (periodic text)."""
    pad = np.zeros(w - 1, np.uint64)
    top = ~sliding_min(~np.concatenate([pad, m, pad]), w)
    at = np.flatnonzero(g[:len(top)] == top)       # places that are the minimum of some window
    lo, hi = np.searchsorted(at, start), np.searchsorted(at, start + n + w - 1)
    many = hi - lo
    k = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
    same = np.concatenate([[0], np.cumsum(g[at[k]] == np.repeat(m[start], many))])
    ends = np.cumsum(many)
    return same[ends] - same[ends - many] > 1


def _segment_rows(length: int, gram: int):
    def run(batches):
        for batch in batches:
            data, off = X.utf8(batch.column(2))
            doc, start, n, anchor, h, own = segments(data, off, length, gram)
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(start.astype(np.int64)), pa.array(n.astype(np.int32)),
                 pa.array(anchor.astype(np.uint64).view(np.int64)), pa.array(h.astype(np.uint64).view(np.int64)),
                 pa.array(own.astype(bool))], names=["doc_id", "h", "start", "n", "anchor", "sh", "own"])
    return run


def suffix_array(sym: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``sym`` (values below 511; 0 ends a segment), by prefix
    doubling on the positions that are still tied."""
    n = len(sym)
    s = np.zeros(n + 8, np.uint64)
    s[:n] = sym
    s[:n] += np.uint64(1)       # the end of all is below a separator
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = (key << np.uint64(9)) | s[j:n + j]
    order = np.argsort(key)
    k = key[order]
    first = np.ones(n, bool)
    first[1:] = k[1:] != k[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    slots = np.flatnonzero(~first | ~np.append(first[1:], True))
    h = 7
    while len(slots):
        p = order[slots]
        nxt = p + h
        r2 = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, 0)
        both = (rank[p].astype(np.uint64) << np.uint64(32)) | r2.astype(np.uint64)
        o = np.argsort(both)
        p, both = p[o], both[o]
        order[slots] = p
        first = np.ones(len(p), bool)
        first[1:] = both[1:] != both[:-1]
        rank[p] = np.maximum.accumulate(np.where(first, slots, 0))
        slots = slots[~first | ~np.append(first[1:], True)]
        h *= 2
    return order


def matching_statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Longest match of every position with another position, inside segments, and the
    segments' offsets in the concatenation (one separator after each)."""
    sizes = np.array([len(t) for t in texts])
    off = np.concatenate([[0], np.cumsum(sizes + 1)])
    b = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    sym = b.astype(np.uint16) + np.uint16(1)
    sym[off[1:] - 1] = 0
    n = len(sym)
    sa = suffix_array(sym)
    bwt = sym[sa - 1]
    # run ends of the transform; a position after a separator starts a run of its own
    head = np.ones(n, bool)
    head[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0)
    end = np.repeat(off[1:] - 1, sizes + 1)
    c, ip = prefix_hash(b)
    runs = np.flatnonzero(head)
    runs = runs[runs > 0]
    i, j = sa[runs], sa[runs - 1]
    lo = np.zeros(len(runs), np.int64)
    hi = np.minimum(end[i] - i, end[j] - j)
    while True:
        open_ = lo < hi
        if not open_.any():
            break
        mid = (lo + hi + 1) // 2
        same = (c[i + mid] - c[i]) * ip[i] == (c[j + mid] - c[j]) * ip[j]
        lo = np.where(open_ & same, mid, lo)
        hi = np.where(open_ & ~same, mid - 1, hi)
    # sampled at run heads; elsewhere one less than at the position before
    value = np.zeros(n, np.int64)
    at_head = np.zeros(n, bool)
    value[i] = lo
    at_head[i] = True
    at_head[sa[0]] = True
    at_head[0] = True
    src = np.maximum.accumulate(np.where(at_head, np.arange(n), 0))
    prev = np.maximum(value[src] - (np.arange(n) - src), 0)    # match with the suffix before
    lcp = prev[sa]
    best = lcp.copy()
    best[:-1] = np.maximum(best[:-1], lcp[1:])                   # and with the one after
    out = np.empty(n, np.int64)
    out[sa] = best
    return np.minimum(out, end - np.arange(n)), off


def marked(match: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged [start, end) covered by windows of ``length`` at the positions that match."""
    at = np.flatnonzero(match >= length)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    s = at[np.concatenate([[0], cut + 1])]
    e = at[np.concatenate([cut, [len(at) - 1]])] + length
    return list(zip(s.tolist(), e.tolist()))


def _shard(length: int):
    def run(pdf):
        import pandas as pd
        X.only(__name__)
        match, off = matching_statistics([bytes(t) for t in pdf["bytes"]])
        rows = []
        for k, (a, s, n) in enumerate(zip(pdf["anchor"], pdf["sh"], pdf["n"])):
            spans = marked(match[off[k]:off[k + 1] - 1], length)
            if spans:
                rows.append((a, s, n, [{"s": x, "e": y} for x, y in spans]))
        del match
        X.release()
        return pd.DataFrame(rows, columns=["anchor", "sh", "n", "spans"])
    return run


def _segment_texts(length: int):
    def run(batches):
        for batch in batches:
            data, off = X.utf8(batch.column(0))
            wanted = batch.column(1).to_pylist()
            rows = []
            for d, w in enumerate(wanted):
                for x in w:
                    s = off[d] + x["start"]
                    rows.append((x["anchor"], x["sh"], x["n"], x["cnt"], data[s:s + x["n"] + length - 1].tobytes()))
                    if len(rows) >= 2000:
                        yield _texts_batch(rows)
                        rows = []
            if rows:
                yield _texts_batch(rows)
    return run


def _texts_batch(rows):
    c = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(c, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                                      names=["anchor", "sh", "n", "cnt", "bytes"])


def _window_hashes(length: int):
    def run(batches):
        for batch in batches:
            out = []
            for t, n in zip(batch.column(3), batch.column(2).to_pylist()):
                b = np.frombuffer(t.as_buffer(), np.uint8)
                c, ip = prefix_hash(b)
                out.append(X.mix((c[length:] - c[:-length]) * ip[:n]).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.list_(pa.int64())), batch.column(4)],
                                             names=["anchor", "sh", "n", "w", "cnt"])
    return run


def _merge_offsets(length: int):
    def run(batches):
        for batch in batches:
            spans = []
            for x in batch.column(3).to_pylist():
                at = np.unique(np.array(x, np.int64))
                m = np.zeros(int(at[-1]) + 1, np.int64)
                m[at] = length
                spans.append([{"s": a, "e": b} for a, b in marked(m, length)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))],
                                             names=["anchor", "sh", "n", "spans"])
    return run


SPANS = "anchor long, sh long, n int, spans array<struct<s: long, e: long>>"


def repeated_spans(docs: DataFrame, length: int = LENGTH, ws: Workspace | None = None) -> DataFrame:
    """(doc_id, h, spans) of documents with repeats: ``h`` is xxhash64 of the text, ``spans``
    the [s, e) byte ranges (several may touch or overlap) covered by a string of ``length``
    bytes that also starts elsewhere. Rows of equal doc_id are told apart by ``h``."""
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "rindex")
    gram = min(GRAM, max(4, length // 4))
    src = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    seg = ws.table(src.filter(F.octet_length("text") >= length)
                   .mapInArrow(X.tidy(_segment_rows(length, gram)), "doc_id long, h long, start long, n int, anchor long, sh long, own boolean"), "segments")
    anchors = ws.table(seg.groupBy("anchor").agg(F.count(F.lit(1)).alias("cnt"), F.max("own").alias("any")).filter("cnt > 1 or any").drop("any"), "anchors")
    total = anchors.agg(F.sum("cnt")).first()[0] or 0
    seg2 = ws.table(join_back(seg, anchors, ["anchor"], total), "shared-segments")
    ws.drop(seg, anchors)
    key = ["anchor", "sh", "n"]
    classes = ws.table(seg2.groupBy(*key).agg(F.count(F.lit(1)).alias("cnt"), F.min(F.struct("doc_id", "h", "start")).alias("rep"),
                                               F.max("own").alias("own")), "classes")
    per = ws.table(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("cnt"), F.min("cnt").alias("least"), F.max("own").alias("any"),
                                                 F.sum(F.col("n").cast("long") + (length - 1)).alias("size"))
                   .filter("(cnt > 1 or any) and least = 1"), "anchor-classes")
    n_classes, size = per.agg(F.sum("cnt"), F.sum(F.when(F.col("size") <= SHARD_BYTES, F.col("size")))).first()
    shards = max(1, -(-int(size or 0) // SHARD_BYTES))
    fine = join_back(classes.withColumnRenamed("cnt", "c"), per.select("anchor", "cnt", (F.col("size") > SHARD_BYTES).alias("wide")), ["anchor"], n_classes or 1)
    wanted = ws.table(fine.select("rep.doc_id", "rep.h", F.struct("anchor", "sh", "n", F.col("rep.start").alias("start"),
                                                                  F.when(F.col("wide"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("cnt")).alias("w"))
                      .groupBy("doc_id", "h").agg(F.collect_list("w").alias("w")), "wanted")
    texts = ws.table(src.join(wanted.withColumnsRenamed({"doc_id": "d2", "h": "h2"}), F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2")))
                     .select("text", "w").mapInArrow(X.tidy(_segment_texts(length)), "anchor long, sh long, n int, cnt long, bytes binary")
                     .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int")), "segment-texts")
    one = texts.filter("cnt = 0").dropDuplicates(key).groupBy("shard").applyInPandas(_shard(length), SPANS)
    windows = ws.table(texts.filter("cnt = 1").select("anchor", "sh", "n", "bytes", "cnt")
                       .mapInArrow(_window_hashes(length), "anchor long, sh long, n int, w array<long>, cnt long")
                       .select(*key, F.posexplode("w").alias("o", "w")), "wide-windows")
    often = ws.table(windows.groupBy("w").agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1"), "wide-repeats")
    n_often = often.agg(F.sum("cnt")).first()[0] or 1
    two = join_back(windows, often, ["w"], n_often).groupBy(*key).agg(F.collect_list("o").alias("o")).mapInArrow(_merge_offsets(length), SPANS)
    partial = ws.table(one.unionByName(two), "marked")
    whole = classes.filter("cnt > 1").select(*key, F.array(F.struct(F.lit(0).cast("long").alias("s"), (F.col("n") + (length - 1)).cast("long").alias("e"))).alias("spans"), "cnt")
    hits = ws.table(whole.unionByName(partial.join(classes.filter("cnt = 1").select(*key), key, "left_semi").select(*key, "spans", F.lit(1).cast("long").alias("cnt"))), "hits")
    n_hits = hits.agg(F.sum("cnt")).first()[0] or 1
    out = ws.table(join_back(seg2, hits, key, n_hits)
                   .select("doc_id", "h", F.transform("spans", lambda x: F.struct((x["s"] + F.col("start")).alias("s"), (x["e"] + F.col("start")).alias("e"))).alias("x"))
                   .groupBy("doc_id", "h").agg(F.flatten(F.collect_list("x")).alias("spans")), "spans")
    ws.drop(seg2, classes, per, wanted, texts, windows, often, partial, hits)
    return out


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _with_spans(docs: DataFrame, spans: DataFrame, *cols) -> DataFrame:
    d = docs.withColumn("__h", F.xxhash64("text"))
    s = spans.select(F.col("doc_id").alias("__d"), F.col("h").alias("__h2"), F.col("spans").alias("__spans"))
    return d.join(s, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__h") == F.col("__h2")), "left").select(*cols, "__spans")


def _pieces(text: bytes, spans) -> tuple[bytes, list[tuple[int, int]]]:
    gone = merged(spans)
    kept, p = [], 0
    for s, e in gone:
        kept.append(text[p:s])
        p = e
    kept.append(text[p:])
    return b"".join(kept), gone


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept (bytes left) and text (what is
    left; bytes of a character that a cut has split are dropped from it, not from n_kept and
    the hash) of every row.

    A null text counts as empty. Overlaps count, matches never cross documents, rows of equal
    or null doc_id are documents of their own, strings are judged on the input. Texts shorter
    than ``length`` lose nothing. Other columns are not read."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            data, off = X.utf8(batch.column(1))
            for lo, hi in X.groups(off, OUT_BYTES):
                rows = []
                for i, spans in enumerate(batch.column(2).slice(lo, hi - lo).to_pylist(), lo):
                    kept, gone = _pieces(data[off[i]:off[i + 1]].tobytes(), spans)
                    rows.append((int(off[i + 1] - off[i]), sum(e - s for s, e in gone), len(gone), hashlib.sha256(kept).hexdigest(), len(kept),
                                 kept.decode("utf-8", "ignore")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *[pa.array(v, t) for v, t in zip(zip(*rows), types)]],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "text"])

    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
    return _with_spans(d, repeated_spans(d, length), "doc_id", "text").mapInArrow(
        X.tidy(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, text string")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with every repeated string cut out of ``text``; bytes of a character that a
    cut has split are dropped. All other columns are kept; n_chars, if there, is recounted.
    Null texts stay null."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spans = repeated_spans(plain, length)
    cols = docs.columns
    d = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    j = _with_spans(d, spans, *[F.col(f"`{c}`") for c in cols])
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields]
    at = cols.index("text")

    def run(batches):
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            new = [t if not s or t is None else _pieces(t.encode("utf-8"), s)[0].decode("utf-8", "ignore") for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([pa.array(new, batch.column(i).type) if i == at else batch.column(i) for i in range(len(cols))], names=cols)

    out = j.mapInArrow(run, ", ".join(types))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.length("text").cast(d.schema["n_chars"].dataType)).select(*[F.col(f"`{c}`") for c in cols])
    return out
