"""Byte-level BPE by forced-boundary splitting.

A merge joins two neighbours into a vocabulary token, so a pair of bytes that occurs inside no
token of the vocabulary can never be joined: between them every encoding has a cut. Texts are
first cut into the tokenizer's words, then at all such pairs; the fragments between cuts are
encoded independently of each other, each distinct one once, and their ids are concatenated.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faresight.llm import textnum as X

GROUP = 1 << 21            # bytes of text whose fragments are looked up together (one document at least)
CACHE = 1 << 19            # fragments a worker remembers between batches (memory only, never results)
OTHER, LETTER, NUMBER, BLANK, SPACE = range(5)
_models: dict = {}
X.keeps(__name__, _models.clear)
_class = np.full(0x110000, 255, np.uint8)     # class of every code point seen so far


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [b for r in ((33, 127), (161, 173), (174, 256)) for b in range(*r)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def classes(cp: np.ndarray) -> np.ndarray:
    """Letter, number, blank (U+0020), other white space or other, by code point."""
    out = _class[cp]
    if (out == 255).any():
        import regex
        kinds = [(LETTER, regex.compile(r"\p{L}")), (NUMBER, regex.compile(r"\p{N}")), (SPACE, regex.compile(r"\s"))]
        for c in np.unique(cp[out == 255]).tolist():
            ch = chr(c)
            _class[c] = BLANK if c == 32 else next((k for k, r in kinds if r.match(ch)), OTHER)
        out = _class[cp]
    return out


def word_starts(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Flags of the code points that begin a word of the tokenizer's splitting pattern
    (contractions; runs of letters, numbers or others, with one blank before them; white space,
    whose last character goes with what follows). ``first`` flags the beginnings of texts."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, bool)
    c = classes(cp)
    white = c >= BLANK
    p = np.empty(n, np.uint8)
    p[0], p[1:] = OTHER, c[:-1]
    start = first.copy()
    start |= ~white & (p != c) & (p != BLANK)            # a run of its own, or after white space that is no blank
    start |= white & (p < BLANK)                         # white space begins
    last = np.zeros(n, bool)                             # its last character, when something follows
    last[:-1] = white[:-1] & ~white[1:] & ~first[1:]
    start |= last
    for q in np.flatnonzero(start & (cp == 39)).tolist():
        for tail in ((115,), (116,), (114, 101), (118, 101), (109,), (108, 108), (100,)):
            e = q + 1 + len(tail)
            if e <= n and tuple(cp[q + 1:e].tolist()) == tail and not first[q + 1:e].any():
                start[q + 1:e] = False
                if e < n:
                    start[e] = True
                break
    return start


class Bpe:
    """Vocabulary and merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                               "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or not plain or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("not a plain byte-level BPE tokenizer")
        sym = byte_symbols()
        vocab = {t: i for t, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pair = {}
        for rank, (a, b) in enumerate(merges):
            self.pair.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with options are not supported")
        raw = {i: bytes(sym[ch] for ch in t) for t, i in vocab.items()}
        size = max([*raw, *self.special.values()], default=-1) + 1
        raw.update({i: t.encode("utf-8") for t, i in self.special.items()})
        table = [raw.get(i, b"") for i in range(size)]
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.off = np.concatenate([[0], np.cumsum([len(t) for t in table])]).astype(np.int64)
        self.of_byte = np.zeros(256, np.int64)
        for ch, b in sym.items():
            self.of_byte[b] = vocab[ch]
        inside = np.zeros((256, 256), bool)              # pairs of bytes that some token holds side by side
        for t in vocab:
            b = [sym[ch] for ch in t]
            inside[b[:-1], b[1:]] = True
        self.forced = ~inside
        self._reset()

    def _reset(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def fragment(self, text: bytes) -> list[int]:
        """Ids of one fragment: the lowest-ranked pair is merged first, the leftmost of equals."""
        ids = self.of_byte[np.frombuffer(text, np.uint8)].tolist()
        pair = self.pair
        if len(ids) < 48:
            while len(ids) > 1:
                best = min(((pair[k], i) for i, k in enumerate(zip(ids, ids[1:])) if k in pair), default=None)
                if best is None:
                    break
                (_, new), i = best
                ids[i:i + 2] = [new]
            return ids
        nxt, prv = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(pair[k][0], i, k) for i, k in enumerate(zip(ids, ids[1:])) if k in pair]
        heapq.heapify(heap)
        while heap:
            _, i, k = heapq.heappop(heap)
            j = nxt[i] if ids[i] is not None else len(ids)
            if j >= len(ids) or ids[j] is None or (ids[i], ids[j]) != k:
                continue                                  # one side has been merged otherwise meanwhile
            ids[i], ids[j] = pair[k][1], None
            nxt[i] = nxt[j]
            if nxt[i] < len(ids):
                prv[nxt[i]] = i
            for a, b in ((prv[i], i), (i, nxt[i])):
                if a >= 0 and b < len(ids) and (ids[a], ids[b]) in pair:
                    heapq.heappush(heap, (pair[ids[a], ids[b]][0], a, (ids[a], ids[b])))
        return [x for x in ids if x is not None]

    def cuts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Starts of the fragments of the texts ``data[off[d]:off[d + 1]]``, in bytes: words,
        and the second byte of every pair that no token holds."""
        n = len(data)
        lead = (data & 0xC0) != 0x80
        pos = np.flatnonzero(lead)
        cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        begin = np.zeros(n + 1, bool)
        begin[off] = True
        flag = begin[:n].copy()
        flag[pos] |= word_starts(cp, begin[:n][pos])
        if n > 1:
            flag[1:] |= self.forced[data[:-1], data[1:]]
        return np.flatnonzero(flag)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts ``data[off[d]:off[d + 1]]`` (``off[0]`` = 0)."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        start = self.cuts(data, off)
        end = np.append(start[1:], n)
        h = _fragment_keys(data, start, end)
        u, first, inv = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, u)
        fresh = np.ones(len(u), bool)
        if len(self.known):
            at[at == len(self.known)] = 0
            fresh = self.known[at] != u
        if fresh.any():
            if len(self.known) + int(fresh.sum()) > CACHE:
                self._reset()
                fresh[:] = True
            raw = data.tobytes()
            new = [self.fragment(raw[start[f]:end[f]]) for f in first[fresh].tolist()]
            size = np.array([len(x) for x in new], np.int64)
            keys = np.concatenate([self.known, u[fresh]])
            order = np.argsort(keys, kind="stable")
            place = np.concatenate([self.at, len(self.ids) + np.cumsum(size) - size])
            self.known, self.at, self.size = keys[order], place[order], np.concatenate([self.size, size])[order]
            self.ids = np.concatenate([self.ids, np.array([i for x in new for i in x], np.uint32)])
            at = np.searchsorted(self.known, u)
        size, place = self.size[at][inv], self.at[at][inv]
        ids = self.ids[_runs(place, size)]
        by_fragment = np.concatenate([[0], np.cumsum(size)])
        return ids, by_fragment[np.searchsorted(start, off)]

    def texts(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the tokens ``ids[off[d]:off[d + 1]]``, joined by document."""
        size = self.off[ids + 1] - self.off[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.bytes[_runs(self.off[ids], size)], total[off]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenated ranges start[i] .. start[i] + size[i] - 1."""
    total = int(size.sum())
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(total)


def _fragment_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit key of every fragment: the bytes themselves up to seven, a hash beyond (whose
    top bit is set, so that both kinds never meet)."""
    size = end - start
    out = np.zeros(len(start), np.uint64)
    short = size <= 7
    s, m = start[short], size[short]
    key = m.astype(np.uint64)
    for j in range(7):
        has = j < m
        b = np.zeros(len(s), np.uint64)
        b[has] = data[s[has] + j]
        key = (key << X.U64(8)) | b
    out[short] = key
    if not short.all():
        s, e = start[~short], end[~short]
        h = np.empty(len(s), np.uint64)
        w = 0
        while w < len(s):                                 # blocks keep the table of powers small
            k = max(int(np.searchsorted(e, s[w] + X.BLOCK, side="right")), w + 1)
            lo, hi = int(s[w]), int(e[k - 1])
            p, ip = X.powers(hi - lo)
            c = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(X._BYTE[data[lo:hi]] * p, out=c[1:])
            h[w:k] = (c[e[w:k] - lo] - c[s[w:k] - lo]) * ip[s[w:k] - lo]
            w = k
        out[~short] = X.mix(h) | X.U64(1 << 63)
    return out


def model(path: str) -> Bpe:
    if path not in _models:
        _models[path] = Bpe(path)
    return _models[path]


def _split_special(b: Bpe, texts: list[bytes]):
    """Texts cut at the strings of added tokens (leftmost, the longest of equals): the parts,
    the document of each part and the id that follows it (-1: none)."""
    import re
    names = sorted(b.special, key=lambda t: -len(t.encode("utf-8")))
    find = re.compile(b"|".join(re.escape(t.encode("utf-8")) for t in names))
    parts, doc, then = [], [], []
    for d, t in enumerate(texts):
        at = 0
        for m in find.finditer(t):
            parts.append(t[at:m.start()])
            doc.append(d)
            then.append(b.special[m.group().decode("utf-8")])
            at = m.end()
        parts.append(t[at:])
        doc.append(d)
        then.append(-1)
    return parts, np.array(doc, np.int64), np.array(then, np.int64)


def encode_texts(b: Bpe, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of whole texts, the strings of added tokens included."""
    data, off = data[off[0]:off[-1]], off - off[0]
    raw = data.tobytes()
    if not any(t.encode("utf-8") in raw for t in b.special):
        return b.encode(data, off)
    parts, doc, then = _split_special(b, [raw[s:e] for s, e in zip(off[:-1].tolist(), off[1:].tolist())])
    cut = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    ids, at = b.encode(np.frombuffer(b"".join(parts), np.uint8), cut)
    has = then >= 0
    ids = np.insert(ids, at[1:][has], then[has].astype(np.uint32))
    size = np.diff(at) + has
    total = np.zeros(len(off) - 1, np.int64)
    np.add.at(total, doc, size)
    return ids, np.concatenate([[0], np.cumsum(total)])


def _task(docs: DataFrame, id_col: str, text_col: str, run, schema: str) -> DataFrame:
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(X.tidy(run), schema)


def _batches(b: Bpe, batches):
    for batch in batches:
        data, off = X.utf8(batch.column(1))
        for d, e in X.groups(off, GROUP):
            yield batch.column(0).slice(d, e - d), *encode_texts(b, data, off[d:e + 1])


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every row, as the tokenizers library encodes whole texts
    with the byte-level BPE file ``tokenizer`` (a path that executors can read) without special
    tokens added. The string of an added token in a text is that token, as there.

    Null and empty texts have no ids; texts of any length are encoded whole; repeated rows and
    null ids give a row each; other columns are not read; an empty table gives no rows."""
    def run(batches):
        for keys, ids, off in _batches(model(tokenizer), batches):
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])
    return _task(docs, id_col, text_col, run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of every row's ids, as the tokenizers library decodes them with special
    tokens kept: the tokens' bytes joined, malformed UTF-8 replaced by U+FFFD. Null ids give an
    empty text; ids outside the vocabulary, and null elements, stand for no bytes."""
    def run(batches):
        b = model(tokenizer)
        for batch in batches:
            col = batch.column(1)
            lists = col.fill_null([]) if col.null_count else col
            off = np.asarray(lists.offsets, np.int64)
            values = lists.values.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[off[0]:off[-1]]
            known = (values >= 0) & (values < len(b.off) - 1)
            kept = np.concatenate([[0], np.cumsum(known)])[off - off[0]]
            data, at = b.texts(values[known], kept)
            raw, at = data.tobytes(), at.tolist()
            texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    src = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return src.mapInArrow(X.tidy(run), "doc_id long, text string")


def digest(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: ``encode``, then ``decode`` of
    its ids, in one pass over the texts; only digests leave a task. Rules as in ``encode``."""
    def run(batches):
        b = model(tokenizer)
        for keys, ids, off in _batches(b, batches):
            data, at = b.texts(ids.astype(np.int64), off)
            little, raw = ids.astype("<u4").tobytes(), data.tobytes()
            coded = [hashlib.sha256(little[4 * s:4 * e]).hexdigest() for s, e in zip(off[:-1].tolist(), off[1:].tolist())]
            plain = [hashlib.sha256(raw[s:e].decode("utf-8", "replace").encode("utf-8")).hexdigest() for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(off)), pa.array(coded, pa.string()), pa.array(plain, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _task(docs, id_col, text_col, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
