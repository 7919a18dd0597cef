"""Merkle manifest of a dataset by cogrouped subtree exchange.

Leaves are placed in the order of their group and cut into pieces of 16**3; a superblock holds
the pieces that start in one window of that many places. Going up, each superblock reduces its
pieces to one node each; the nodes form the next, 4096 times smaller, level. Going down, a
superblock's leaves (or nodes) are cogrouped with the nodes outside it that their proofs need,
one short list per piece, and one ``applyInPandas`` does the local reduction, joins both parts
of every proof and folds them to the root. No node travels to more than its own superblock.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from faresight.llm.common import Workspace, join_back
from faresight.operators.prefix import row_index_and_count

ARITY = 16
LEVELS = 3                   # levels reduced inside one piece
SPAN = ARITY ** LEVELS       # places of a piece
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest_of(*columns: Column) -> Column:
    """Hex SHA-256 of the columns in turn: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for c in columns:
        c = c.cast("string")
        parts.append(F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def _reduce(nodes: list[str], n: int) -> list[list[str]]:
    """Levels of one piece of a group of ``n`` nodes: the piece itself first."""
    out = [nodes]
    for _ in range(min(LEVELS, _height(n))):
        last = out[-1]
        out.append([_hash("".join(last[i:i + ARITY])) for i in range(0, len(last), ARITY)])
    return out


def _siblings(levels: list[list[str]], level: int, i: int) -> tuple[int, list[str]]:
    lo = i - i % ARITY
    run = levels[level][lo:lo + ARITY]
    return i - lo, run[:i - lo] + run[i - lo + 1:]


def _pieces(pdf: pd.DataFrame):
    for start, piece in pdf.sort_values("g", kind="stable").groupby("start", sort=True):
        yield int(start), piece, _reduce(piece["digest"].tolist(), int(piece["n"].iloc[0]))


def _up(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = [(p["k"].iloc[0], start, levels[-1][0]) for start, p, levels in _pieces(pdf)]
    return pd.DataFrame(rows, columns=["k", "below", "digest"])


def _encode(path: list[tuple[int, list[str]]]) -> str:
    return "|".join(f"{pos}:{''.join(sib)}" for pos, sib in path)


def _decode(path: str) -> list[tuple[int, list[str]]]:
    out = []
    for step in path.split("|") if path else []:
        pos, sib = step.split(":")
        out.append((int(pos), [sib[i:i + 64] for i in range(0, len(sib), 64)]))
    return out


def _down(is_subroot: bool):
    """Proof part above each node of a superblock: its siblings in its piece, then the piece's."""
    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        above = {int(b): (s, p) for b, s, p in zip(outer["below"], outer["subroot"], outer["path"])}
        rows = []
        for start, piece, levels in _pieces(nodes):
            subroot, path = above[start]
            upper = {}
            for i, (below, digest) in enumerate(zip(piece["below"], piece["digest"])):
                j = i // ARITY
                if j not in upper:
                    steps, at = [], j
                    for lv in range(1, len(levels) - 1):
                        steps.append(_siblings(levels, lv, at))
                        at //= ARITY
                    upper[j] = "|".join(x for x in (_encode(steps), path) if x)
                own = _encode([_siblings(levels, 0, i)]) if len(levels) > 1 else ""
                rest = upper[j] if len(levels) > 1 else path
                rows.append((int(below), digest if is_subroot else subroot, "|".join(x for x in (own, rest) if x)))
        return pd.DataFrame(rows, columns=["below", "subroot", "path"])
    return run


def _finish(root: str):
    """Digest of every leaf's proof and the root that its (tampered) leaf folds to."""
    def fold(node: str, path: list[tuple[int, list[str]]]) -> str:
        for pos, sib in path:
            node = _hash("".join(sib[:pos]) + node + "".join(sib[pos:]))
        return node

    def run(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        above = {int(b): (s, _decode(p)) for b, s, p in zip(outer["below"], outer["subroot"], outer["path"])}
        rows = []
        for start, piece, levels in _pieces(leaves):
            subroot, path = above[start]
            upper, text = {}, {}
            for i, (doc, leaf, other) in enumerate(zip(piece["doc"], piece["digest"], piece["other"])):
                j = i // ARITY
                if j not in upper:
                    steps, at = [], j
                    for lv in range(1, len(levels) - 1):
                        steps.append(_siblings(levels, lv, at))
                        at //= ARITY
                    upper[j] = steps + path
                    text[j] = "".join("".join(sib) for _, sib in upper[j])
                own = [_siblings(levels, 0, i)] if len(levels) > 1 else []
                proof = _hash("".join("".join(sib) for _, sib in own) + text[j])
                folded = fold(other if isinstance(other, str) else leaf, own + upper[j])
                rows.append((doc, leaf, subroot, root, proof, folded, folded == root))
        return pd.DataFrame(rows, columns=["doc", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


def _placed(ws: Workspace, items: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """``items`` with their place ``g`` in the order (k, *order), their group's size ``n``, their
    piece's first place ``start`` and their ``superblock``; repeated rows lie in any order."""
    salted = items.withColumn("salt", F.monotonically_increasing_id())
    t, total = row_index_and_count(salted, ["k", *order, "salt"], "g")
    t = t.drop("salt")
    stats = ws.table(t.groupBy("k").agg(F.min("g").alias("s0"), F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("cnt")), f"{name}-groups")
    start = F.col("s0") + F.floor((F.col("g") - F.col("s0")) / SPAN) * SPAN
    out = join_back(t, stats, ["k"], max(total, 1)).withColumn("start", start.cast("long")) \
        .withColumn("superblock", F.floor(F.col("start") / SPAN)).drop("s0")
    return ws.table(out, name), total


def manifest(docs: DataFrame, tampered: dict[str, Column] | None = None, when: Column | None = None, id_col: str = "doc_id",
             group_col: str = "source", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """Merkle tree over all rows, by group: doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified.

    A leaf is ``digest_of(columns)``. In each group (null one of its own, first; then by UTF-8
    bytes) leaves ascend by id (null first, then by leaf); every 16 consecutive nodes become
    the hash of their digests, until one remains, the subroot; the subroots likewise give the
    root. The proof is the siblings from the leaf up to the root; ``proof_sha256`` hashes them in
    turn. ``folded_root`` is what the leaf and its proof give; where ``when`` holds, the leaf is
    that of the row with the columns ``tampered`` in place of its own, so ``verified`` tells
    whether the row is as in the manifest.

    Null columns, empty and very long texts are hashed as they are; a row that occurs twice has
    two leaves; a lone leaf is its group's subroot, a lone subroot the root; an empty table gives
    no rows. Other columns are not read."""
    spark = docs.sparkSession
    ws = Workspace(spark, "merkle")
    group = F.col(group_col).cast("string")
    own = [F.col(c) for c in columns]
    other = F.lit(None).cast("string")
    if tampered and when is not None:
        other = F.when(when, digest_of(*[tampered.get(c, F.col(c)) for c in columns]))
    items = docs.select(F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group)).alias("k"),
                        F.col(id_col).cast("long").alias("doc_id"), digest_of(*own).alias("digest"), other.alias("other"))
    level, total = _placed(ws, items, ["doc_id", "digest"], "leaves")
    if not total:
        ws.drop(ws.path)
        return spark.createDataFrame([], RESULT)
    # going up: (level table, whether its nodes are subroots)
    levels, top = [(level, False)], False
    while True:
        nodes = ws.table(level.select("superblock", "g", "k", "n", "start", "digest").groupBy("superblock")
                         .applyInPandas(_up, "k string, below long, digest string"), "nodes")
        if top and total <= SPAN:
            root = nodes.first()["digest"]
            break
        grouped = False
        if not top:
            grouped = nodes.groupBy("k").count().filter("count > 1").isEmpty()
        if grouped:
            level, total = _placed(ws, nodes.withColumn("name", F.col("k")).withColumn("k", F.lit("")), ["name"], "subroots")
            top = True
            levels.append((level, True))
        else:
            level, total = _placed(ws, nodes, ["below"], "level")
            levels.append((level, False))
    # going down: what each piece needs from outside it
    outer = spark.createDataFrame([(0, "", "")], "below long, subroot string, path string")
    for level, subroots in reversed(levels[1:]):
        keyed = outer.withColumn("superblock", F.floor(F.col("below") / SPAN))
        outer = ws.table(level.select("superblock", "g", "n", "start", "digest", "below").groupBy("superblock").cogroup(keyed.groupBy("superblock"))
                         .applyInPandas(_down(subroots), "below long, subroot string, path string"), "outer")
    keyed = outer.withColumn("superblock", F.floor(F.col("below") / SPAN))
    # ids travel as text: pandas would turn integers beside a null into floats
    return levels[0][0].select("superblock", "g", "n", "start", "digest", "other", F.col("doc_id").cast("string").alias("doc")).groupBy("superblock") \
        .cogroup(keyed.groupBy("superblock")).applyInPandas(_finish(root), RESULT.replace("doc_id long", "doc string")) \
        .select(F.col("doc").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame, every: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``manifest`` of documents in which the rows whose id's unsigned CRC-32 (of its decimal
    form) is divisible by ``every`` come back with A-Z of the text in lower case: a drill that
    shows which rows a proof would catch."""
    pick = F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0
    return manifest(docs, {text_col: lower_ascii(F.col(text_col))}, pick, id_col)
