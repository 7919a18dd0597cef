"""Prefix trie of conversations by depth-band rollup.

A node is named by its smallest member and its depth. Sums over subtrees do not explode a node
to all its ancestors: a node goes only to those in its own band of 16 depths; the totals of the
band roots (multiples of 16) form a trie of a sixteenth of the height, which is completed in the
same way, and the completed totals then go to the ancestors in the band above. So a row is
copied at most 16 times a pass, and the passes are logarithmic in the depth.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from faresight.llm.common import Workspace, join_back
from faresight.operators.prefix import row_index_and_count

HEIGHT = 16                 # depths of a band
CHUNK = 4096                # turns whose running state one window task holds
IDS = 512                   # conversation ids of one piece of a node's list
SHARED = 6                  # the shared beginning has fewer turns than this
FAMILY = 100
RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
EMPTY = hashlib.sha256(b"").hexdigest()


def _lanes(depth: Column) -> list[Column]:
    """Two independent 64-bit hashes of a turn at its depth. The exclusive or of those of a
    sequence's turns names the sequence: it needs no order of evaluation, so a conversation of
    any length is named by partial sums."""
    tagged = F.concat(depth.cast("string"), F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    wide = F.conv(F.substring(F.md5(tagged.cast("binary")), 1, 15), 16, 10).cast("long")
    return [F.xxhash64(F.lit("turn"), depth, F.col("role"), F.col("text")).alias("a"), wide.alias("b")]


def ordered_turns(ws: Workspace, conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str):
    """(turns with conv, pos from 1, role, text; conversations with their first place and number
    of turns). Rows without a conversation id take no part."""
    src = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("salt"))
    t, total = row_index_and_count(src, ["conv", "turn", "role", "text", "salt"], "g")
    convs = ws.table(t.groupBy("conv").agg(F.min("g").alias("s0"), F.count(F.lit(1)).alias("n")), "conversations")
    return t.select("conv", "g", "role", "text"), convs, total


def rebuilt_turns(ws: Workspace, turns: DataFrame, convs: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Conversations with the beginning of their family: the first h turns of conversation
    c - c % 100, then the own turns after the first h, h = CRC-32 of the decimal id modulo 6.
    Returns (conv, depth, a, b, size) and (conv, length)."""
    c = F.col("conv")
    h = (F.crc32(c.cast("string").cast("binary")) % SHARED).alias("h")
    base = convs.select(c.alias("base"), F.col("n").alias("base_n"))
    plan = ws.table(convs.select("conv", "s0", "n", h, (c - c % FAMILY).alias("base")).join(base, "base", "left")
                    .withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0)))).drop("base_n"), "plan")
    stats = plan.select("conv", "s0", "h", "m", F.col("n").alias("cnt"))
    own = join_back(turns, stats, ["conv"], total).withColumn("pos", F.col("g") - F.col("s0") + 1)
    tail = own.filter("pos > h").select("conv", (F.col("m") + F.col("pos") - F.col("h")).alias("depth"), "role", "text")
    # at most five turns of a family's first conversation go to its at most 199 members
    heads = join_back(turns.filter(f"conv % {FAMILY} = 0"), plan.filter(f"conv % {FAMILY} = 0").select("conv", "s0", F.col("n").alias("cnt")), ["conv"], total) \
        .withColumn("pos", F.col("g") - F.col("s0") + 1).filter(F.col("pos") < SHARED).select(F.col("conv").alias("base"), "pos", "role", "text")
    head = plan.filter("m > 0").select("conv", "base", "m").join(heads, "base").filter("pos <= m") \
        .select("conv", F.col("pos").alias("depth"), "role", "text")
    rows = tail.unionByName(head).select("conv", "depth", *_lanes(F.col("depth")), F.length("text").cast("long").alias("size"))
    length = plan.select("conv", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return ws.table(rows, "turns"), length


def sequence_names(ws: Workspace, rows: DataFrame) -> DataFrame:
    """Each row with (a, b) of the whole sequence up to it: running sums inside chunks of 4096
    turns, and what lies before a chunk from the chunks' totals."""
    rows = rows.withColumn("chunk", F.floor((F.col("depth") - 1) / CHUNK))
    w = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("conv", "depth", "size", "chunk", F.bit_xor("a").over(w).alias("a"), F.bit_xor("b").over(w).alias("b"))
    totals = ws.table(rows.groupBy("conv", "chunk").agg(F.bit_xor("a").alias("ta"), F.bit_xor("b").alias("tb")), "chunks")
    long_ones = totals.filter("chunk > 0").select("conv").distinct()
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.join(long_ones, "conv", "left_semi").select("conv", "chunk", F.bit_xor("ta").over(before).alias("ta"), F.bit_xor("tb").over(before).alias("tb"))
    cols = ["conv", "depth", "size"]
    first = run.filter("chunk = 0").select(*cols, "a", "b")
    later = run.filter("chunk > 0").join(offsets.filter("chunk > 0"), ["conv", "chunk"]) \
        .select(*cols, F.col("a").bitwiseXOR(F.col("ta")).alias("a"), F.col("b").bitwiseXOR(F.col("tb")).alias("b"))
    return ws.table(first.unionByName(later), "names")


class _Trie:
    """Nodes (conv, depth) and, for every conversation and depth, the node it passes."""

    def __init__(self, ws: Workspace, paths: DataFrame, root: int, depth: int):
        self.ws, self.paths, self.root, self.depth = ws, paths, root, depth

    def at(self, rows: DataFrame, depth: Column, name: str) -> DataFrame:
        """``rows`` with column ``name``: the node at ``depth`` on the way of their ``conv``."""
        rows = rows.withColumn("_d", depth)
        way = self.paths.select("conv", F.col("depth").alias("_d"), F.col("node").alias(name))
        top = rows.filter("_d = 0").withColumn(name, F.lit(self.root).cast("long"))
        return rows.filter("_d > 0").join(way, ["conv", "_d"]).unionByName(top)

    def _to_ancestors(self, rows: DataFrame, low: Column, high: Column, step: int) -> DataFrame:
        """Sums of ``rows`` at their ancestors at depths low, low + step, .. high."""
        spread = rows.withColumn("up", F.explode(F.sequence(low, high, F.lit(step).cast("long"))))
        return self.at(spread, F.col("up"), "to").groupBy(F.col("to").alias("conv"), F.col("up").alias("depth")) \
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    def totals(self, rows: DataFrame, height: int, step: int = 1) -> DataFrame:
        """Sums over the subtrees of ``rows`` (conv, depth, leaves, saved), whose depths are
        multiples of ``step``."""
        if self.depth < step:
            return rows
        band = step * height
        low = (F.floor(F.col("depth") / band) * band).cast("long")
        inside = self.ws.table(self._to_ancestors(rows, low, F.col("depth"), step), "band")
        if self.depth < band:
            return inside
        roots = self.totals(inside.filter(F.col("depth") % band == 0), height, band)
        above = self._to_ancestors(roots.filter("depth > 0"), F.col("depth") - band, F.col("depth") - step, step)
        return self.ws.table(inside.unionByName(above).groupBy("conv", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "totals")


def _hash_lists(batches):
    """SHA-256 of each node's list from its pieces, which come in order; a node's list is
    streamed, never held."""
    now, h = None, None
    for pdf in batches:
        out = []
        for conv, depth, ids in zip(pdf["conv"].tolist(), pdf["depth"].tolist(), pdf["ids"].tolist()):
            if (conv, depth) != now:
                if now is not None:
                    out.append((*now, h.hexdigest()))
                now, h = (conv, depth), hashlib.sha256(ids.encode("ascii"))
            else:
                h.update(("," + ids).encode("ascii"))
        yield pd.DataFrame(out, columns=["conv", "depth", "ends"])
    if now is not None:
        yield pd.DataFrame([(*now, h.hexdigest())], columns=["conv", "depth", "ends"])


def end_digests(ws: Workspace, ends: DataFrame) -> DataFrame:
    """(conv, depth, ends): hash of the ascending decimal ids of the conversations that end at
    each node (node, depth, conv), comma-joined. Ids are joined in pieces of 512 first, so a
    node where a third of all conversations end costs its task a 512th of them in rows."""
    t, total = row_index_and_count(ends, ["node", "depth", "conv"], "g")
    stats = ws.table(t.groupBy("node", "depth").agg(F.min("g").alias("s0"), F.count(F.lit(1)).alias("cnt")), "ends")
    placed = join_back(t, stats, ["node", "depth"], max(total, 1)).withColumn("piece", F.floor((F.col("g") - F.col("s0")) / IDS))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    pieces = placed.groupBy("node", "depth", "piece").agg(ids.alias("ids"))
    return pieces.repartition("node", "depth").sortWithinPartitions("node", "depth", "piece") \
        .select(F.col("node").alias("conv"), "depth", "ids").mapInPandas(_hash_lists, "conv long, depth long, ends string")


def prefix_trie(conversations: DataFrame, height: int = HEIGHT, id_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per distinct beginning of a rebuilt conversation (module functions), the empty
    one included: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn, null first, equal ones by role and text. Null roles and texts are
    empty; rows without conversation id take no part; repeated rows are turns of their own; a
    conversation may have any number of turns. Beginnings are told apart by 128 bits of hashes of
    their turns. An empty table has no conversations and so no nodes. Other columns are not read."""
    spark = conversations.sparkSession
    ws = Workspace(spark, "trie")
    turns, convs, total = ordered_turns(ws, conversations, id_col, turn_col, role_col, text_col)
    if not total:
        ws.drop(ws.path)
        return spark.createDataFrame([], RESULT)
    rows, length = rebuilt_turns(ws, turns, convs, total)
    length = ws.table(length, "lengths")
    named = sequence_names(ws, rows)
    one = length.agg(F.min("conv"), F.max("length"), F.count(F.lit(1)), F.sum("length")).first()
    root, depth, n_convs, n_rows = one[0], int(one[1]), one[2], max(int(one[3]), 1)
    key = ["depth", "a", "b"]
    nodes = ws.table(named.groupBy(*key).agg(F.min("conv").alias("node"), F.count(F.lit(1)).alias("cnt"), F.max("size").alias("size")), "nodes")
    paths = ws.table(join_back(named, nodes.select(*key, "node", "cnt"), key, n_rows).select("conv", "depth", "node"), "paths")
    trie = _Trie(ws, paths, root, depth)
    every = nodes.select(F.col("node").alias("conv"), "depth", F.col("cnt").alias("n_convs"), ((F.col("cnt") - 1) * F.col("size")).alias("saved")).unionByName(
        spark.createDataFrame([(root, 0, n_convs, 0)], "conv long, depth long, n_convs long, saved long"))
    parents = ws.table(trie.at(every.filter("depth > 0"), F.col("depth") - 1, "parent").select("conv", "depth", "parent"), "parents")
    children = parents.groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    full = ws.table(every.join(children, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
                    .withColumn("leaves", (F.col("n_children") == 0).cast("long")), "trie")
    sums = trie.totals(full.select("conv", "depth", "leaves", "saved"), height)
    ends = trie.at(length, F.col("length"), "node").select("node", F.col("length").alias("depth"), "conv")
    digests = ws.table(end_digests(ws, ends), "digests")
    at = ["conv", "depth"]
    out = full.select(*at, "n_convs", "n_children").join(sums.select(*at, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), at) \
        .join(parents, at, "left").join(digests, at, "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))
