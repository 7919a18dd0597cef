"""Word-piece token counts by a linear longest-match automaton.

Greedy longest match over a vocabulary is run as a trie with failure links: a node's link
leads to where matching goes on once the tokens that are certain at that node are popped, and
only their number is stored, so a word's length in tokens comes from one pass over its bytes
and no piece is built. Distinct words of a batch advance through the automaton in lockstep.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faresight.llm import textnum as X

MARK = "▁"     # stands before a word, as in the vocabulary
GROUP = 1 << 22
_automata: dict = {}
X.keeps(__name__, _automata.clear)


class Automaton:
    """Trie over UTF-8 bytes of ``pieces``. ``fail[v]``: node to go on from (-1: no match is
    possible), ``pop[v]``: tokens certain by then."""

    def __init__(self, pieces: list[str]):
        child: list[dict[int, int]] = [{}]
        token = [False]
        for p in pieces:
            v = 0
            for b in p.encode("utf-8"):
                n = child[v].get(b)
                if n is None:
                    n = child[v][b] = len(child)
                    child.append({})
                    token.append(False)
                v = n
            token[v] = v != 0
        size = len(child)
        fail, pop = [-1] * size, [0] * size
        todo = [(0, b, n) for b, n in child[0].items()]
        for u, b, v in todo:            # breadth first: links lead to shallower nodes
            todo.extend((v, c, n) for c, n in child[v].items())
            if token[v]:
                fail[v], pop[v] = 0, 1
                continue
            z, count = fail[u], pop[u]
            while z != -1 and b not in child[z]:
                count += pop[z]
                z = fail[z]
            if z != -1:
                fail[v], pop[v] = child[z][b], count
        self.fail, self.pop = np.array(fail, np.int64), np.array(pop, np.int64)
        self.end = np.zeros(size, np.int64)      # tokens popped when the word ends at a node; -1: unknown
        for u, b, v in todo:
            at_end = self.end[fail[v]] if fail[v] >= 0 else -1
            self.end[v] = -1 if at_end < 0 else pop[v] + at_end
        edges = sorted((v * 256 + b, n) for v in range(size) for b, n in child[v].items())
        self.key = np.array([k for k, _ in edges], np.int64)
        self.to = np.array([n for _, n in edges], np.int64)
        v = 0
        for b in MARK.encode("utf-8"):
            v = child[v].get(b, -1) if v >= 0 else -1
        self.start = v

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each word ``data[start:end]``; 0 where some byte cannot be matched."""
        n = len(start)
        out, state = np.zeros(n, np.int64), np.full(n, self.start, np.int64)
        if self.start < 0 or not len(self.key):
            return out
        alive = np.arange(n)[np.argsort(end - start, kind="stable")]
        length = (end - start)[alive]
        p = 0
        while len(alive):
            first = int(np.searchsorted(length, p, side="right"))     # words that end here
            done = alive[:first]
            if len(done):
                tail = self.end[state[done]]
                out[done] = np.where(tail < 0, 0, out[done] + tail)
                alive, length = alive[first:], length[first:]
                if not len(alive):
                    break
            byte = data[start[alive] + p].astype(np.int64)
            open_ = np.arange(len(alive))
            dead = np.zeros(len(alive), bool)
            while len(open_):
                w = alive[open_]
                want = state[w] * 256 + byte[open_]
                at = np.searchsorted(self.key, want)
                at[at == len(self.key)] = 0
                hit = self.key[at] == want
                state[w[hit]] = self.to[at[hit]]
                miss = w[~hit]
                out[miss] += self.pop[state[miss]]
                state[miss] = self.fail[state[miss]]
                open_ = open_[~hit]
                stuck = state[alive[open_]] < 0
                dead[open_[stuck]] = True
                open_ = open_[~stuck]
            if dead.any():
                out[alive[dead]] = 0
                alive, length = alive[~dead], length[~dead]
            p += 1
        return out


def sentence_pieces(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece model file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))]


def _automaton(path: str) -> Automaton:
    if path not in _automata:
        _automata[path] = Automaton(sentence_pieces(path))
    return _automata[path]


def count_batch(a: Automaton, data: np.ndarray, off: np.ndarray):
    """(words, tokens, unknown words) by document."""
    n = len(off) - 1
    start, end, h, wo = X.words(data, off, lower=False)
    if not len(h):
        return [np.zeros(n, np.int64)] * 3
    _, first, inv = np.unique(h, return_index=True, return_inverse=True)
    c = a.counts(data, start[first], end[first])
    tokens, unknown = np.maximum(c, 1)[inv], (c == 0)[inv].astype(np.int64)
    total = lambda x: np.concatenate([[0], np.cumsum(x)])[wo]
    return np.diff(wo), np.diff(total(tokens)), np.diff(total(unknown))


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, case kept; each is matched greedily with the word mark
    before it. A word that cannot be matched to its end is one unknown token. Null and empty
    texts have 0 of each; a word of any length is matched whole. ``vocabulary``: path of a
    sentencepiece model that executors can read. Other columns are not read."""
    def run(batches):
        a = _automaton(vocabulary)
        for batch in batches:
            data, off = X.utf8(batch.column(1))
            for d, e in X.groups(off, GROUP):
                w, t, u = count_batch(a, data, off[d:e + 1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(d, e - d), pa.array(w), pa.array(t), pa.array(u)], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(X.tidy(run), "doc_id long, n_words long, n_tokens long, n_unknown long")
