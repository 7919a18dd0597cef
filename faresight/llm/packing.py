"""Packing of tokenized documents into fixed-length sequences by bin completion.

Documents are tokenized in Arrow tasks; the histogram of piece lengths (at most ``capacity``
rows, whatever the corpus) is packed by branch and bound over bins: around the largest
remaining length, undominated fillings are enumerated and the one of least waste is used as
often as its lengths allow, so every step exhausts a length and there are at most ``capacity``
steps. The last few hundred pieces are searched exactly, pruned by the waste still allowed,
with the best-fit solution as first incumbent. The resulting patterns (bounded by
``capacity`` too) are then dealt to the pieces by their running number within a length,
which is a prefix count over written partitions; no piece passes through the driver.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from faresight.llm import textnum as X
from faresight.llm.common import Workspace

CAPACITY = 2048
RESIDUE = 240
NODES = 1_000
_CACHE_WORDS = 120_000
_LETTER, _PUNCTUATION, _ACCENT = (np.zeros(256, bool) for _ in range(3))
_LETTER[[*range(97, 123), *range(48, 58)]] = True
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_ACCENT[[*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)]] = True     # after 0xC3: Latin letters
_tokenizers: dict = {}
X.keeps(__name__, _tokenizers.clear)


def _byte_chars() -> dict[int, str]:
    """Byte-level BPE's character for each byte (as Latin-1 text): itself where printable,
    else the next character from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


_CHARS = _byte_chars()
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")     # lower-case Latin letters, which normalisation keeps


class WordIds(dict):
    """Token ids of words, as little-endian unsigned 32-bit bytes, encoded on first use.

    The tokenizer drops white space and never joins across it or from a letter or digit to
    punctuation, so a text's ids are those of such parts in turn. A word of plain lower-case
    letters is one unit for the model and skips normalisation. The dictionary is bounded: when
    it is full it becomes the older generation, whose words are taken over on use."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        v = self.old.get(word)
        if v is None:
            if _PLAIN.fullmatch(word):
                ids = [t.id for t in self.model.tokenize(word.decode("latin-1").translate(_CHARS))]
            else:
                ids = self.tok.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
            v = np.array(ids, dtype="<u4").tobytes()
        if len(self) >= _CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = v
        return v

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Ids of the documents ``offsets[d]..offsets[d + 1]``. A-Z is lowered first, as the
        tokenizer does, and a space put before punctuation that follows a letter or digit;
        not in texts that may hold a special token, which is matched in the raw text."""
        raw = data[offsets[0]:offsets[-1]]
        a = X.LOWER[raw]
        at = np.flatnonzero(_LETTER[a[:-1]] & _PUNCTUATION[a[1:]]) + 1
        accent = np.flatnonzero((a[:-2] == 0xC3) & _ACCENT[a[1:-1]] & _PUNCTUATION[a[2:]]) + 2 if len(a) > 2 else at[:0]
        at = np.sort(np.concatenate([at, accent]))
        new = np.insert(a, at, 32)
        bounds = offsets - offsets[0]
        bounds = bounds + np.searchsorted(at, bounds, side="left")
        text, out, get = new.tobytes(), [], self.__getitem__
        special = b"<|" in raw.tobytes()
        for d in range(len(offsets) - 1):
            part = text[bounds[d]:bounds[d + 1]]
            if special and b"<|" in (whole := data[offsets[d]:offsets[d + 1]].tobytes()):
                part = whole
            out.append(b"".join(map(get, part.split())))
        return out


def _tokenizer(path: str) -> WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


def _cut(path: str, capacity: int, end_id: int, keep_ids: bool):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        enc, seen = _tokenizer(path), np.zeros(capacity + 1, np.int64)
        pid = TaskContext.get().partitionId()
        for batch in batches:
            data, off = X.utf8(batch.column(1))
            ids_in = batch.column(0).to_pylist()
            for d, e in X.groups(off):
                rows = []
                for i, ids in zip(range(d, e), enc.encode(data, off[d:e + 1])):
                    ids += end
                    n = len(ids) // 4
                    for p, s in enumerate(range(0, n, capacity)):
                        part = ids[4 * s:4 * (s + capacity)]
                        m = len(part) // 4
                        rows.append((ids_in[i], p, s, m, zlib.crc32(part), pid, int(seen[m]), part if keep_ids else None))
                        seen[m] += 1
                c = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "pid", "k", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(c, kinds)][:8 if keep_ids else 7], names=names[:8 if keep_ids else 7])
    return run


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello-Toth L2: for every threshold t, pieces over capacity - t need a bin each and
    take none of [t, ...]; the rest counts by volume."""
    sizes = sorted(counts)
    n = np.zeros(capacity + 1, np.int64)
    for s in sizes:
        n[s] = counts[s]
    vol = np.cumsum(n * np.arange(capacity + 1))
    num = np.cumsum(n)
    best = -(-int(vol[-1]) // capacity)
    for t in [0] + [s for s in sizes if s <= capacity // 2]:
        big = int(num[-1] - num[capacity - t])                     # > capacity - t
        mid_n = int(num[capacity - t] - num[capacity // 2])         # (capacity / 2, capacity - t]
        mid_v = int(vol[capacity - t] - vol[capacity // 2])
        small = int(vol[capacity // 2] - (vol[t - 1] if t else 0))
        best = max(best, big + mid_n + max(0, -(-(small - (mid_n * capacity - mid_v)) // capacity)))
    return best


def fillings(room: int, avail: np.ndarray, branch: int = 5, limit: int = 40) -> list[tuple[int, tuple[int, ...]]]:
    """(waste, lengths) of undominated fillings of ``room`` by available lengths, least waste
    first. One piece that fills the room dominates all others, then two that do; else the
    larger lengths are tried in turn. Only the first ``branch`` pieces of a filling are
    branched on, the next ones are the largest that fit until none does, so a filling has no
    limit on its pieces and none can take a further piece."""
    out: list[tuple[int, tuple[int, ...]]] = []
    left = [300]

    def go(room, top, picked):
        left[0] -= 1
        if len(picked) >= branch:
            out.append(greedy(room, top, picked))
            return
        sizes = np.flatnonzero(avail[:min(room, top) + 1])
        if not len(sizes):
            out.append((room, tuple(picked)))
            return
        if sizes[-1] == room:
            out.append((0, (*picked, room)))
            return
        rest = room - sizes
        pair = (rest <= sizes) & (rest > 0) & (avail[rest] > (rest == sizes))
        if pair.any():
            out.extend((0, (*picked, int(a), int(room - a))) for a in sizes[pair][::-1][:3])
            return
        for a in sizes[::-1][:12 if len(picked) < 2 else 4].tolist():
            avail[a] -= 1
            picked.append(a)
            go(room - a, a, picked)
            picked.pop()
            avail[a] += 1
            if left[0] <= 0 or out[-1][0] == 0:
                return

    def greedy(room, top, picked):
        use = list(picked)
        sizes = np.flatnonzero(avail[:min(room, top) + 1])
        while len(sizes):
            a = int(sizes[-1])
            take = min(int(avail[a]), room // a)
            use += [a] * take
            room -= take * a
            sizes = sizes[:-1]
            sizes = sizes[:int(np.searchsorted(sizes, room, side="right"))]
        return room, tuple(use)

    go(room, room, [])
    return sorted(set(out), key=lambda f: (f[0], len(f[1]), [-x for x in f[1]]))[:limit]


def best_fit(items: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing."""
    import bisect
    rooms: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for s in sorted(items, reverse=True):
        k = bisect.bisect_left(rooms, (s, -1))
        if k < len(rooms):
            r, b = rooms.pop(k)
        else:
            r, b = capacity, len(bins)
            bins.append([])
        bins[b].append(s)
        bisect.insort(rooms, (r - s, b))
    return bins


def best_fit_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over lengths with counts: bins of equal contents are one group."""
    groups: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for s in sorted(counts, reverse=True):
        n = counts[s]
        for room in range(s, capacity + 1):
            per, now = room // s, groups[room]
            while now and n:
                use, k = now.pop()
                full = min(k, n // per)
                n -= full * per
                if full:
                    groups[room - per * s].append((use + (s,) * per, full))
                if full < k:        # fewer than ``per`` pieces are left
                    if n:
                        groups[room - n * s].append((use + (s,) * n, 1))
                        full, n = full + 1, 0
                    if full < k:
                        now.append((use, k - full))
            if not n:
                break
        if n:
            per = capacity // s
            if n // per:
                groups[capacity - per * s].append(((s,) * per, n // per))
            if n % per:
                groups[capacity - n % per * s].append(((s,) * (n % per), 1))
    return [g for room in groups for g in room]


def complete_exactly(items: list[int], capacity: int, nodes: int = NODES) -> list[list[int]]:
    """Branch and bound over bins of a short list; the incumbent starts as best fit."""
    best = best_fit(items, capacity)
    avail = np.zeros(capacity + 1, np.int64)
    for s in items:
        avail[s] += 1
    total, left = sum(items), [nodes]
    counts = {int(s): int(avail[s]) for s in np.flatnonzero(avail)}
    low = lower_bound(counts, capacity)

    def go(bins, waste):
        nonlocal best
        if left[0] <= 0 or len(best) <= low:
            return
        left[0] -= 1
        sizes = np.flatnonzero(avail)
        if not len(sizes):
            if len(bins) < len(best):
                best = [list(b) for b in bins]
            return
        top = int(sizes[-1])
        allowed = (len(best) - 1) * capacity - total   # waste of any better solution
        avail[top] -= 1
        for w, fill in fillings(capacity - top, avail, limit=6):
            if waste + w > allowed:
                break
            for s in fill:
                avail[s] -= 1
            bins.append([top, *fill])
            go(bins, waste + w)
            bins.pop()
            for s in fill:
                avail[s] += 1
        avail[top] += 1

    import sys
    old = sys.getrecursionlimit()
    sys.setrecursionlimit(max(old, 10 * len(items) + 1000))
    try:
        go([], 0)
    finally:
        sys.setrecursionlimit(old)
    return best


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(piece lengths of a sequence, number of such sequences); all pieces are used. The
    best-fit solution stands where bin completion does not beat it."""
    avail = np.zeros(capacity + 1, np.int64)
    for s, n in counts.items():
        avail[s] = n
    out = [((capacity,), int(avail[capacity]))] if avail[capacity] else []
    avail[capacity] = 0
    while avail.sum() > RESIDUE:
        top = int(np.flatnonzero(avail)[-1])
        avail[top] -= 1
        _, fill = fillings(capacity - top, avail)[0]
        avail[top] += 1
        use = (top, *fill)
        sizes, mult = np.unique(use, return_counts=True)
        times = int((avail[sizes] // mult).min())
        avail[sizes] -= times * mult
        out.append((tuple(sorted(use, reverse=True)), times))
    rest = [int(s) for s in np.flatnonzero(avail) for _ in range(int(avail[s]))]
    if rest:
        out += [(tuple(sorted(b, reverse=True)), 1) for b in complete_exactly(rest, capacity)]
    fit = best_fit_patterns({s: n for s, n in counts.items() if n}, capacity)
    return fit if sum(n for _, n in fit) < sum(n for _, n in out) else out


def slots(found: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """(length, base, multiplicity, first sequence, offset) rows, sorted by length and base:
    pieces base, base + 1, ... of a length fill ``multiplicity`` places of each sequence."""
    base: dict[int, int] = {}
    rows, seq = [], 0
    for use, times in found:
        at = 0
        for s in sorted(set(use), reverse=True):
            m = use.count(s)
            rows.append((s, base.get(s, 0), m, seq, at))
            base[s] = base.get(s, 0) + m * times
            at += m * s
        seq += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _deal(table: np.ndarray):
    key = (table[:, 0] << 44) + table[:, 1]

    def run(batches):
        for b in batches:
            length, k = b.column("length").to_numpy(), b.column("k").to_numpy()
            r = table[np.searchsorted(key, (length << 44) + k, side="right") - 1]
            within = k - r[:, 1]
            seq = r[:, 3] + within // r[:, 2]
            at = r[:, 4] + (within % r[:, 2]) * length
            keep = [i for i, n in enumerate(b.schema.names) if n not in ("k", "pid")]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], pa.array(seq), pa.array(at)],
                                             names=[*[b.schema.names[i] for i in keep], "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = True,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    ``ids`` (little-endian unsigned 32-bit) when ``with_ids``.

    ``tokenizer`` is the path of a tokenizer file that executors can read. A null or empty
    text is the end id alone. Texts of more than ``capacity`` ids are cut into full pieces and
    a last shorter one; others stay whole. Rows of equal or null doc_id are packed each.
    Other columns are not read; an empty table gives an empty result."""
    spark = docs.sparkSession
    ws = Workspace(spark, "packing")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, pid int, k long" + (", ids binary" if with_ids else "")
    p = ws.table(src.mapInArrow(X.tidy(_cut(tokenizer, capacity, end_id, with_ids)), schema), "pieces")
    parts = ws.table(p.groupBy("pid", "length").agg((F.max("k") + 1).alias("n")), "counts")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    before = parts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("pid")) - F.col("n")).drop("n")
    numbered = p.join(before, ["pid", "length"]).withColumn("k", F.col("k") + F.col("before")).drop("before")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    out = numbered.select("k", *cols).mapInArrow(
        _deal(slots(patterns(counts, capacity))), schema.replace(", pid int, k long", "") + ", sequence_id long, offset long")
    return out
