"""Interpolated modified Kneser-Ney language model (bigrams over words).

Counting: Arrow tasks count words, then bigrams, of bounded runs of tokens in numpy and emit
one sorted block per hash shard (pre-aggregated, no row per n-gram); a shuffle brings the
blocks of a shard together, where they are merged. Bigrams are sharded by their context, so
that a shard has all that follows a word; the followers of very frequent words (1/1000 of all
tokens or more, at most 1000 of them) are spread over all shards by the whole bigram.

Storage: every shard is a file of sorted 64-bit hashes and count arrays in the shared folder.
Scoring: workers memory-map the files and look up sorted, distinct keys of a batch of
documents, so pages are touched in order; nothing of the model is collected or broadcast but
its file names, four discounts a level and the list of frequent words.

    p(w | u) = (c(u w) - D(c)) / c(u) + g(u) p(w),  g(u) = sum_i D_i N_i(u .) / c(u)
    p(w)     = (n(w) - D'(n)) / n(. .) + g' / (V + 1),  n(w) = distinct words before w
"""

from __future__ import annotations

import io
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faresight.llm import textnum as X
from faresight.llm.common import HEAVY, Workspace

END = np.uint64(0x0E4D0E4D0E4D0E4D)
BEGIN = np.uint64(0xBE61BE61BE61BE61)
RUN_TOKENS = 2_000_000
SHARD_TOKENS = 3_000_000
GROUP = 1 << 22


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Range shard of a hash, by its high bits."""
    return ((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def bigram_key(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return X.mix(u * np.uint64(0x9E3779B97F4A7C15) + X.mix(w))


def bigram_shard(u, key, heavy: np.ndarray, shards: int) -> np.ndarray:
    spread = np.isin(u, heavy)
    return shard_of(np.where(spread, key, X.mix(u)), shards)


def tokens(data: np.ndarray, off: np.ndarray):
    """Word hashes of the documents with BEGIN before and END after each: all tokens, and the
    position of each document's BEGIN (with the total at the end)."""
    _, _, h, wo = X.words(data, off)
    n = len(off) - 1
    out = np.empty(len(h) + 2 * n, np.uint64)
    begin = wo[:-1] + 2 * np.arange(n)
    last = wo[1:] + 2 * np.arange(n) + 1
    inner = np.ones(len(out), bool)
    inner[begin] = inner[last] = False
    out[inner] = h
    out[begin] = BEGIN
    out[last] = END
    return out, np.append(begin, len(out))


def pack(**arrays: np.ndarray) -> bytes:
    f = io.BytesIO()
    np.savez(f, **arrays)
    return f.getvalue()


def unpack(b: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(b)) as z:
        return {k: z[k] for k in z.files}


def blocks(shard: np.ndarray, shards: int, **arrays):
    """(shard, packed arrays) of rows that are sorted by shard."""
    cut = np.searchsorted(shard, np.arange(shards + 1))
    for s in range(shards):
        a, b = int(cut[s]), int(cut[s + 1])
        if b > a:
            yield s, pack(**{k: v[a:b] for k, v in arrays.items()})


def _emit(rows):
    c = list(zip(*rows)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c[0], pa.int32()), pa.array(c[1], pa.binary())], names=["shard", "block"])


def _runs(batches, column: int = 0):
    """Token arrays of at least RUN_TOKENS tokens (the last one may be shorter)."""
    held, n = [], 0
    for batch in batches:
        data, off = X.utf8(batch.column(column))
        for d, e in X.groups(off):
            t, _ = tokens(data, off[d:e + 1])
            held.append(t)
            n += len(t)
            if n >= RUN_TOKENS:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def _count_words(shards: int):
    def run(batches):
        for t in _runs(batches):
            h, c = np.unique(t[t != BEGIN], return_counts=True)
            for s, b in blocks(shard_of(h, shards), shards, h=h, c=c.astype(np.uint32)):
                yield _emit([(s, b)])
    return run


def _count_bigrams(shards: int, heavy: np.ndarray):
    def run(batches):
        for t in _runs(batches):
            names, inv = np.unique(t, return_inverse=True)
            u, w = inv[:-1], inv[1:]
            ok = t[:-1] != END
            pair, c = np.unique((u[ok].astype(np.uint64) << np.uint64(32)) | w[ok].astype(np.uint64), return_counts=True)
            uh, wh = names[(pair >> np.uint64(32)).astype(np.int64)], names[(pair & np.uint64(0xFFFFFFFF)).astype(np.int64)]
            s = bigram_shard(uh, bigram_key(uh, wh), heavy, shards)
            o = np.argsort(s, kind="stable")
            s, uh, wh, c = s[o], uh[o], wh[o], c[o]
            # contexts are stored once per block: distinct, then how many pairs follow each
            cut = np.searchsorted(s, np.arange(shards + 1))
            for k in range(shards):
                a, b = int(cut[k]), int(cut[k + 1])
                if b > a:
                    x = uh[a:b]
                    at = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
                    yield _emit([(k, pack(u=x[at], n=np.diff(np.append(at, b - a)).astype(np.uint32), w=wh[a:b], c=small_counts(c[a:b])))])
    return run


def small_counts(c: np.ndarray) -> np.ndarray:
    """Smallest unsigned type that holds the counts."""
    top = int(c.max()) if len(c) else 0
    return c.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32 if top < 2**32 else np.uint64)


def merge(keys: np.ndarray, *values: np.ndarray):
    """Distinct sorted keys and the sums of their values."""
    o = np.argsort(keys)
    k = keys[o]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return (k[at], *[np.add.reduceat(v[o].astype(np.int64), at) if len(k) else v.astype(np.int64) for v in values])


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> str:
    """Arrays as .npy files of one folder entry; a retried task writes under a new name."""
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    stem = f"{name}-{uuid.uuid4().hex[:8]}"
    for k, v in arrays.items():
        f = io.BytesIO()
        np.save(f, v)
        with system.open_output_stream(f"{path}/{stem}.{k}.npy") as out:
            out.write(f.getbuffer())
    return stem


_maps: dict = {}


def read_array(folder: str, stem: str, k: str) -> np.ndarray:
    """Memory map of an array file; from a store that is not mounted, its bytes are read."""
    key = (folder, stem, k)
    if key not in _maps:
        if len(_maps) > 4096:
            _maps.clear()
        if folder.startswith("file:") or folder.startswith("/"):
            from urllib.parse import unquote, urlparse
            _maps[key] = np.load(f"{unquote(urlparse(folder).path)}/{stem}.{k}.npy", mmap_mode="r")
        else:
            from pyarrow import fs
            system, path = fs.FileSystem.from_uri(folder)
            with system.open_input_file(f"{path}/{stem}.{k}.npy") as f:
                return np.load(io.BytesIO(f.read()))
    return _maps[key]


def count_of_counts(c: np.ndarray) -> list[int]:
    return [int((c == i).sum()) for i in (1, 2, 3, 4)]


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more; 0.5 * count where the
    counts of counts are too few to tell."""
    d = [0.5, 1.0, 1.5]
    if n[0] and n[1]:
        y = n[0] / (n[0] + 2 * n[1])
        d[0] = 1 - 2 * y * n[1] / n[0]
        if n[2]:
            d[1] = 2 - 3 * y * n[2] / n[1]
            d[2] = 3 - 4 * y * n[3] / n[2] if n[3] else d[1]
    return [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]


def discounted(c: np.ndarray, d: list[float]) -> np.ndarray:
    return np.where(c > 0, c - np.array([0.0, *d])[np.minimum(c, 3)], 0.0)


STATS = "shard int, block binary, path string, n1 long, n2 long, n3 long, n4 long, total long, distinct long, ends long"


def _rows(shard_blocks, path, counts, total, distinct, ends=0):
    import pandas as pd
    rows = [(s, b, None, 0, 0, 0, 0, 0, 0, 0) for s, b in shard_blocks]
    rows.append((-1, None, path, *counts, total, distinct, ends))
    return pd.DataFrame(rows, columns=[x.split()[0] for x in STATS.split(", ")])


def _merge_words(folder: str):
    def run(pdf):
        z = [unpack(bytes(b)) for b in pdf["block"]]
        h, c = merge(np.concatenate([x["h"] for x in z]), np.concatenate([x["c"] for x in z]))
        s = int(pdf["shard"].iloc[0])
        heavy = c.argsort()[::-1][:HEAVY]      # no more can be heavy, in this shard or at all
        top = pack(h=h[heavy], c=c[heavy])
        return _rows([(s, top)], write_arrays(folder, f"words-{s}", {"h": h, "c": small_counts(c)}), [0, 0, 0, 0], int(c.sum()), len(h),
                     int(c[h == END].sum())).assign(shard=s)
    return run


def _frequent(total: int):
    def run(batches):
        for b in batches:
            for x in b.column(0).to_pylist():
                z = unpack(x)
                yield pa.RecordBatch.from_arrays([pa.array(z["h"][z["c"] * HEAVY >= total].view(np.int64))], names=["h"])
    return run


def _merge_bigrams(folder: str, word_shards: int):
    def run(pdf):
        s = int(pdf["shard"].iloc[0])
        z = [unpack(bytes(b)) for b in pdf["block"]]
        u = np.concatenate([np.repeat(x["u"], x["n"]) for x in z])
        w = np.concatenate([x["w"] for x in z])
        c = np.concatenate([x["c"].astype(np.int64) for x in z])
        del z
        key = bigram_key(u, w)
        o = np.argsort(key)
        key = key[o]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        c = np.add.reduceat(c[o], at)
        u, w, key = u[o][at], w[o][at], key[at]
        path = write_arrays(folder, f"bigrams-{s}", {"h": key, "c": small_counts(c)})
        out = []
        uu, n1, n2, n3 = merge(u, c == 1, c == 2, c > 2)
        out += blocks(shard_of(uu, word_shards), word_shards, u=uu, n1=n1.astype(np.uint32), n2=n2.astype(np.uint32), n3=n3.astype(np.uint32))
        ww, n = merge(w, np.ones(len(w), np.int64))
        out += blocks(shard_of(ww, word_shards), word_shards, w=ww, n=n.astype(np.uint32))
        return _rows(out, path, count_of_counts(c), int(c.sum()), len(c))
    return run


def _merge_context(folder: str):
    def run(pdf):
        s = int(pdf["shard"].iloc[0])
        z = [unpack(bytes(b)) for b in pdf["block"]]
        a, b = [x for x in z if "u" in x], [x for x in z if "w" in x]
        u = merge(*[np.concatenate([x[k] for x in a]) if a else np.zeros(0, np.uint64) for k in ("u", "n1", "n2", "n3")])
        w = merge(*[np.concatenate([x[k] for x in b]) if b else np.zeros(0, np.uint64) for k in ("w", "n")])
        arrays = {"u": u[0], "n1": small_counts(u[1]), "n2": small_counts(u[2]), "n3": small_counts(u[3]), "w": w[0], "n": small_counts(w[1])}
        return _rows([], write_arrays(folder, f"context-{s}", arrays), count_of_counts(w[1]), int(w[1].sum()), len(w[0])).assign(shard=s)
    return run


def lookup(folder: str, stems: dict[int, str], shard: np.ndarray, keys: np.ndarray, key: str, values: list[str]) -> list[np.ndarray]:
    """Values (0 where absent) of keys; keys of one shard are looked up together, sorted."""
    out = [np.zeros(len(keys), np.int64) for _ in values]
    o = np.lexsort((keys, shard))
    cut = np.flatnonzero(np.append(True, shard[o][1:] != shard[o][:-1])) if len(o) else []
    for a, b in zip(cut, [*cut[1:], len(o)]):
        stem = stems.get(int(shard[o[a]]))
        if stem is None:
            continue
        h = read_array(folder, stem, key)
        if not len(h):
            continue
        q = keys[o[a:b]]
        p = np.searchsorted(h, q)
        p[p == len(h)] = 0
        hit = h[p] == q
        for v, name in zip(out, values):
            v[o[a:b][hit]] = read_array(folder, stem, name)[p[hit]]
    return out


def _score(m: dict):
    def run(batches):
        for batch in batches:
            data, off = X.utf8(batch.column(2))
            for d, e in X.groups(off, GROUP):
                t, at = tokens(data, off[d:e + 1])
                names, inv = np.unique(t, return_inverse=True)
                ws = shard_of(names, m["shards"])
                c, = lookup(m["folder"], m["words"], ws, names, "h", ["c"])
                n, = lookup(m["folder"], m["context"], ws, names, "w", ["n"])
                n1, n2, n3 = lookup(m["folder"], m["context"], ws, names, "u", ["n1", "n2", "n3"])
                cu = np.where(names == BEGIN, m["docs"], c)
                low = discounted(n, m["d1"]) / max(1, m["pairs"]) + m["rest"] / (m["distinct"] + 1)
                back = np.where(cu > 0, (m["d2"][0] * n1 + m["d2"][1] * n2 + m["d2"][2] * n3) / np.maximum(cu, 1), 1.0)
                pair, which = np.unique((inv[:-1].astype(np.uint64) << np.uint64(32)) | inv[1:].astype(np.uint64), return_inverse=True)
                u, w = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
                key = bigram_key(names[u], names[w])
                b, = lookup(m["folder"], m["bigrams"], bigram_shard(names[u], key, m["heavy"], m["shards"]), key, "h", ["c"])
                p = discounted(b, m["d2"]) / np.maximum(cu[u], 1) + back[u] * low[w]
                logp = np.append(0.0, np.log10(np.where(names[w] == BEGIN, 1.0, p))[which])
                base = np.log10((c + 0.5) / (m["tokens"] + 0.5 * (m["distinct"] + 1)))[inv]
                known = (c > 0)[inv]
                first = np.zeros(len(t), bool)
                first[at[:-1]] = True
                logp[first] = base[first] = 0.0
                known[first] = False
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(d, e - d), batch.column(1).slice(d, e - d), pa.array(np.diff(at) - 1), pa.array(np.add.reduceat(known.astype(np.int64), at[:-1])),
                     pa.array(np.full(e - d, m["tokens"], np.int64)), pa.array(np.add.reduceat(base, at[:-1])), pa.array(np.add.reduceat(logp, at[:-1]))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def train(texts: DataFrame, ws: Workspace, size_bytes: int | None = None) -> dict:
    """Counts ``texts`` (column text) into array files below ``ws``; returns what scoring
    needs: folder, file names by shard (one per SHARD_TOKENS tokens or so), totals, discounts
    and the frequent words. ``size_bytes``: bytes of text, counted if not given; it sets the
    number of shards."""
    spark = texts.sparkSession
    folder = ws.folder("arrays")
    if size_bytes is None:
        size_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, -(-int(size_bytes) // (6 * SHARD_TOKENS)))
    counted = texts.select("text").mapInArrow(X.tidy(_count_words(shards)), "shard int, block binary")
    w = ws.table(counted.groupBy("shard").applyInPandas(_merge_words(folder), STATS), "words")
    rows = w.filter("path is not null").select("shard", "path", "total", "distinct").collect()     # one row per shard
    total, distinct = sum(r["total"] for r in rows), sum(r["distinct"] for r in rows)
    often = w.filter("block is not null").select("block").mapInArrow(_frequent(total), "h long").collect()   # HEAVY words at most
    heavy = np.append(np.sort(np.array([r["h"] for r in often], np.int64).view(np.uint64)), BEGIN)
    words = {r["shard"]: r["path"] for r in rows}
    b = ws.table(texts.select("text").mapInArrow(X.tidy(_count_bigrams(shards, heavy)), "shard int, block binary")
                 .groupBy("shard").applyInPandas(_merge_bigrams(folder, shards), STATS), "bigrams")
    rows = b.filter("path is not null").drop("block", "shard").collect()
    bigrams = {int(r["path"].split("-")[1]): r["path"] for r in rows}
    n2 = [sum(r[f"n{i}"] for r in rows) for i in (1, 2, 3, 4)]
    x = ws.table(b.filter("block is not null").select("shard", "block").groupBy("shard").applyInPandas(_merge_context(folder), STATS), "context")
    ctx = x.filter("path is not null").drop("block").collect()
    n1 = [sum(r[f"n{i}"] for r in ctx) for i in (1, 2, 3, 4)]
    pairs, followers = sum(r["total"] for r in ctx), sum(r["distinct"] for r in ctx)
    d1, d2 = discounts(n1), discounts(n2)
    rest = (d1[0] * n1[0] + d1[1] * n1[1] + d1[2] * (followers - n1[0] - n1[1])) / pairs if pairs else 1.0
    docs = _ends(w, shards)
    ws.drop(w, b, x)
    return {"folder": folder, "shards": shards, "words": words, "bigrams": bigrams, "context": {r["shard"]: r["path"] for r in ctx}, "tokens": total,
            "distinct": distinct, "docs": docs, "pairs": pairs, "d1": d1, "d2": d2, "rest": rest, "heavy": heavy}


def _ends(w, shards) -> int:
    """Documents counted, one END each."""
    s = int(shard_of(np.array([END]), shards)[0])
    r = w.filter((F.col("shard") == s) & F.col("path").isNotNull()).select("ends").first()
    return int(r[0]) if r else 0


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 1


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from rows whose crc32(doc_id as text) mod 5 is not 1 (a null doc_id is scored, with
    held_out null, but not learned from). Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z
    lowered, then one end. A null or empty text is the end alone. Repeated rows count each.
    Without training rows all words are unknown: p = 1 / (V + 1) with V = 0. Other columns
    are not read; an empty table gives an empty result."""
    ws = Workspace(docs.sparkSession, "kneser-ney")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(src.filter(~held_out()).select("text"), ws)
    return src.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        X.tidy(_score(model)), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
