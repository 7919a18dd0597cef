import random
import zlib

import numpy as np

from faresight.llm import packing as P
from faresight.llm.queries import tokenizer_path
from tests.llm.conftest import edge_texts


def test_pieces_are_the_tokenizers_and_fill_sequences(edge_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    got = P.pack(edge_docs, tokenizer_path(), capacity=256).toPandas()
    want = []
    for i, t in edge_texts():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want += [(-1 if i is None else i, p, s, len(ids[s:s + 256]), zlib.crc32(np.array(ids[s:s + 256], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), 256))]
    have = list(zip(got.doc_id.fillna(-1).astype(int), got.piece, got.start, got.length, got.ids_crc32))
    assert sorted(want) == sorted(have)
    assert all(zlib.crc32(x) == c and len(x) == 4 * n for x, c, n in zip(got.ids, got.ids_crc32, got.length))
    got = got.sort_values(["sequence_id", "offset"])
    sums = got.groupby("sequence_id").length.cumsum()
    assert (sums - got.length == got.offset).all() and sums.max() <= 256
    assert got.sequence_id.nunique() <= P.lower_bound(got.length.value_counts().to_dict(), 256) + 1


def test_empty(no_docs):
    assert P.pack(no_docs, tokenizer_path()).count() == 0


def optimum(items, cap):
    best = [len(items)]

    def go(rest, rooms):
        if len(rooms) >= best[0]:
            return
        if not rest:
            best[0] = len(rooms)
            return
        for k in {r: i for i, r in enumerate(rooms) if r >= rest[0]}.values():
            go(rest[1:], [*rooms[:k], rooms[k] - rest[0], *rooms[k + 1:]])
        go(rest[1:], [*rooms, cap - rest[0]])
    go(sorted(items, reverse=True), [])
    return best[0]


def test_small_lists_are_packed_optimally():
    r = random.Random(3)
    for _ in range(60):
        items = [r.randint(1, 30) for _ in range(r.randint(1, 9))]
        bins = P.complete_exactly(items, 30)
        assert sorted(x for b in bins for x in b) == sorted(items) and max(map(sum, bins)) <= 30
        assert len(bins) == optimum(items, 30)


def test_patterns_use_every_piece_and_come_close_to_the_bound():
    r = random.Random(4)
    for cap, near, draw in ((2048, True, lambda: min(2048, int(r.lognormvariate(5.5, 1)) + 1)), (2048, False, lambda: r.randint(600, 1100)), (512, True, lambda: r.randint(1, 512)), (2048, True, lambda: r.randint(1, 40))):
        counts = {}
        for _ in range(20_000):
            s = min(cap, draw())
            counts[s] = counts.get(s, 0) + 1
        used, bins = {}, 0
        for use, times in P.patterns(counts, cap):
            assert sum(use) <= cap and times > 0
            bins += times
            for s in use:
                used[s] = used.get(s, 0) + times
        low = P.lower_bound(counts, cap)
        assert used == counts and low <= bins <= len(P.best_fit([s for s, n in counts.items() for _ in range(n)], cap)), (bins, low)
        if near:
            assert bins <= low * 1.003 + 2, (bins, low)


def test_slots_number_pieces_without_gaps():
    t = P.slots([((5, 5, 3), 4), ((5, 3), 2), ((5,), 1)])
    assert t.tolist() == [[3, 0, 1, 0, 10], [3, 4, 1, 4, 5], [5, 0, 2, 0, 0], [5, 8, 1, 4, 0], [5, 10, 1, 6, 0]]


def test_best_fit_patterns_are_best_fit():
    r = random.Random(8)
    for cap in (20, 100):
        items = [r.randint(1, cap) for _ in range(300)]
        counts = {s: items.count(s) for s in set(items)}
        found = P.best_fit_patterns(counts, cap)
        assert sorted(x for use, n in found for x in use * n) == sorted(items) and all(sum(use) <= cap for use, _ in found)
        assert sum(n for _, n in found) == len(P.best_fit(items, cap))
