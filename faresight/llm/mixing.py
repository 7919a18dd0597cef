"""Mixing sources to target weights by temperature, with DataFrame and SQL functions only.

Shares p_s of the sources' tokens are exponentiated, w_s = p_s^t / sum p^t. The exponent t in
[0, 1] is the greatest that still meets the targets, found by bisection: an entropy of the
weights of at least ``min_entropy`` (a share of the greatest possible one, ln S), and at the
other end a repetition, w_s * budget / tokens_s, of at most ``max_repeat`` for any source.
Each bisection step is one aggregate over the table of sources; no list of sources is
collected. The weights are realised as block permutations: every source's documents stand in
a fixed random order (by a hash), in blocks by hash prefix; whole passes first, then whole
blocks, then documents of one last block, while they fit the source's token budget. The
order's cut is found level by level (256 blocks, then 256 blocks of the cut block, then its
documents), so no window holds a source.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from faresight.llm.common import Workspace

STEPS = 40
LEVELS = 4      # bisection steps per aggregate: 2**LEVELS - 1 exponents at once


def words(text):
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def meets(sources: DataFrame, exponents: list[float], budget: float | None, min_entropy: float | None, max_repeat: float | None) -> list[bool]:
    """For each exponent: whether it has the entropy, or whether it exceeds the repetition limit.
    ``budget`` None is the "cover" budget of that exponent."""
    cols = []
    for k, t in enumerate(exponents):
        x = F.pow("p", F.lit(t))
        cols += [F.sum(x).alias(f"z{k}"), F.sum(x * F.ln("p")).alias(f"y{k}"), F.max(x / F.col("tokens")).alias(f"m{k}"), F.max(F.col("tokens") / x).alias(f"c{k}")]
    r = sources.agg(F.count(F.lit(1)).alias("n"), *cols).first()
    out = []
    for k, t in enumerate(exponents):
        if not r["n"]:
            out.append(True)
        elif min_entropy is not None:
            h = math.log(r[f"z{k}"]) - t * r[f"y{k}"] / r[f"z{k}"]
            out.append(h >= min_entropy * math.log(r["n"]))
        else:
            most = r[f"m{k}"] * r[f"c{k}"] if budget is None else r[f"m{k}"] / r[f"z{k}"] * budget
            out.append(most > max_repeat)
    return out


def bisect(sources: DataFrame, budget: float | None, min_entropy: float | None, max_repeat: float | None, steps: int = STEPS) -> float:
    """With ``min_entropy``: the greatest exponent whose weights have that entropy (0 if only
    equal weights do). With ``max_repeat``: the smallest whose sources repeat no more (1, the
    natural shares, if none does). Halves [0, 1] ``steps`` times."""
    lo, hi = 0.0, 1.0
    # invariant: the property holds at lo and not at hi
    edge = meets(sources, [0.0, 1.0], budget, min_entropy, max_repeat)
    if edge[1]:
        return 1.0
    if not edge[0]:
        return 0.0
    done = 0
    while done < steps:
        n = 1 << min(LEVELS, steps - done)
        width = (hi - lo) / n
        good = meets(sources, [lo + width * k for k in range(1, n)], budget, min_entropy, max_repeat)
        k = next((i for i, g in enumerate(good) if not g), n - 1)
        lo, hi = lo + width * k, lo + width * (k + 1)
        done += min(LEVELS, steps - done)
    return lo if min_entropy is not None else hi


def plan(docs: DataFrame, budget_tokens: float | str | None = None, min_entropy: float | None = None, max_repeat: float | None = None,
         seed: str = "mix", ws: Workspace | None = None) -> tuple[DataFrame, float]:
    """Source table (source, tokens, docs, weight, passes, cut) and the exponent.

    ``docs``: source (null is a source of its own), doc_id, n_tokens. ``budget_tokens``: None
    means all tokens; the string "cover" the least budget at which the source with the most
    tokens per weight is passed once, so that every document of every source is taken.
    ``passes`` whole passes are taken of each source, and once more the documents up to
    ``cut`` (hash, doc_id) in its order. Sources without tokens get no weight and no pass."""
    ws = ws or Workspace(docs.sparkSession, "mixing")
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    d = docs.select("source", "doc_id", "n_tokens", key.alias("h"))
    level1 = ws.table(d.groupBy("source", F.substring("h", 1, 2).alias("b1")).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "blocks")
    src = level1.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")).filter("tokens > 0")
    total = src.agg(F.sum("tokens")).first()[0] or 0
    s = ws.table(src.withColumn("p", F.col("tokens") / F.lit(float(max(total, 1)))), "sources")
    budget = float(total if budget_tokens in (None, "cover") else budget_tokens)
    t = bisect(s, None if budget_tokens == "cover" else budget, min_entropy, max_repeat) if (min_entropy is not None or max_repeat is not None) else 1.0
    z = s.agg(F.sum(F.pow("p", F.lit(t)))).first()[0] or 1.0
    w = s.withColumn("weight", F.pow("p", F.lit(t)) / F.lit(z))
    if budget_tokens == "cover":
        budget = float(w.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0)
    share = F.floor(F.col("weight") * F.lit(budget) + 0.5)
    passes = F.floor(share / F.col("tokens")).cast("long")
    w = ws.table(w.withColumn("passes", passes).withColumn("rest", (share - passes * F.col("tokens")).cast("long")), "weights")
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    # level 1: whole blocks that fit; the next block is cut
    before = F.sum("tokens").over(Window.partitionBy("source").orderBy("b1")) - F.col("tokens")
    c1 = level1.withColumn("before", before).alias("a").join(w.select("source", "rest").alias("b"), same("a", "b")) \
        .filter("before <= rest and before + tokens > rest").select("a.source", "b1", (F.col("rest") - F.col("before")).alias("room"))
    c1 = ws.table(c1.groupBy("source").agg(F.min(F.struct("b1", "room")).alias("c")).select("source", "c.b1", "c.room"), "cut-1")
    part = d.alias("a").join(c1.alias("b"), same("a", "b") & (F.substring("a.h", 1, 2) == F.col("b.b1"))) \
        .select("a.source", "doc_id", "n_tokens", "h", "b1", "room", F.substring("h", 3, 2).alias("b2"))
    part = ws.table(part, "cut-block")
    level2 = part.groupBy("source", "b1", "room", "b2").agg(F.sum("n_tokens").alias("tokens"))
    c2 = level2.withColumn("before", F.sum("tokens").over(Window.partitionBy("source").orderBy("b2")) - F.col("tokens")) \
        .filter("before <= room and before + tokens > room").groupBy("source").agg(F.min(F.struct("b2", (F.col("room") - F.col("before")).alias("room"))).alias("c"))
    c2 = ws.table(c2.select("source", F.col("c.b2").alias("b2"), F.col("c.room").alias("room2")), "cut-2")
    last = part.alias("a").join(c2.alias("b"), same("a", "b") & (F.col("a.b2") == F.col("b.b2"))).select("a.source", "doc_id", "n_tokens", "h", "b1", "a.b2", "room2")
    run = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("h", F.col("doc_id").asc_nulls_first()))
    c3 = last.withColumn("used", run).filter("used <= room2").groupBy("source").agg(F.max(F.struct("h", "doc_id")).alias("c"))
    cuts = c1.alias("x").join(c2.alias("y"), same("x", "y"), "left").select("x.source", F.concat("b1", "b2").alias("upto")).alias("x") \
        .join(c3.alias("y"), same("x", "y"), "left").select("x.source", "upto", F.col("c.h").alias("last_h"))
    out = w.alias("a").join(cuts.alias("b"), same("a", "b"), "left").select("a.source", "tokens", "docs", "weight", "passes", "upto", "last_h")
    return ws.table(out, "plan"), t


def copies(docs: DataFrame, found: DataFrame, seed: str = "mix", bare: int = 0) -> DataFrame:
    """``docs`` with weight, copies (``bare`` in sources without tokens) and block; the table of sources is joined by Spark's own
    choice (broadcast below its size threshold, else a shuffle that splits large sources)."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    f = found.select(F.col("source").alias("__source"), F.col("weight").alias("__weight"), F.col("passes").alias("__passes"),
                     F.col("upto").alias("__upto"), F.col("last_h").alias("__last"))
    extra = F.when(F.col("__passes").isNull(), 0).when(F.col("__upto").isNull(), 0) \
        .when(F.substring("__h", 1, 4) < F.col("__upto"), 1).when(F.coalesce(F.col("__h") <= F.col("__last"), F.lit(False)), 1).otherwise(0)
    return docs.withColumn("__h", h).join(f, F.col("source").eqNullSafe(F.col("__source")), "left") \
        .withColumn("weight", F.col("__weight")).withColumn("copies", (F.coalesce("__passes", F.lit(bare)) + extra).cast("long")) \
        .withColumn("block", F.substring("__h", 1, 2)).drop("__h", "__source", "__weight", "__passes", "__upto", "__last")


def mix(docs: DataFrame, budget_tokens: float | str | None = None, min_entropy: float | None = None, max_repeat: float | None = None) -> DataFrame:
    """One row per document: doc_id, source, n_tokens (words), weight of its source, copies
    (times it is taken) and block (of the permutation).

    A null source is a source; a null text has no tokens. Documents of a source without any
    tokens have a null weight and 0 copies (1 with the "cover" budget). Documents without tokens are taken with their
    place in the order. Rows of one doc_id share a place and are all taken or not together at
    the cut. Other columns are not read; an empty table gives an empty result."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text").cast("string")).alias("n_tokens"))
    ws = Workspace(docs.sparkSession, "mixing")
    t = ws.table(src, "tokens")
    found, _ = plan(t, budget_tokens, min_entropy, max_repeat, ws=ws)
    return copies(t, found, bare=int(budget_tokens == "cover")).select("doc_id", "source", "n_tokens", "weight", "copies", "block")


def realise(docs: DataFrame, budget_tokens: float | str | None = None, min_entropy: float | None = None, max_repeat: float | None = None) -> DataFrame:
    """Rows of ``docs`` (all columns), each repeated ``copies`` times. Texts are not shuffled
    while the table of sources is below the broadcast threshold."""
    t = Workspace(docs.sparkSession, "mixing")
    narrow = t.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                 words(F.col("text").cast("string")).alias("n_tokens")), "tokens")
    found, _ = plan(narrow, budget_tokens, min_entropy, max_repeat, ws=t)
    cols = docs.columns
    out = copies(docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(cols)], F.col("doc_id").cast("long").alias("doc_id"),
                             F.col("source").cast("string").alias("source")), found, bare=int(budget_tokens == "cover"))
    return out.withColumn("__k", F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(1).cast("long"), F.col("copies"))).otherwise(F.expr("array()")))) \
        .select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(cols)])
