"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors of one label (and length) are compared when their cosine can reach the threshold.
Equal vectors are collapsed first. A rotation to principal axes (from second moments summed
in Spark, a matrix of the vector length squared) puts most of the product into the leading
dimensions; the first coordinate of two unit vectors that link differs by at most
sqrt(2 - 2 * threshold), so vectors are dealt to cells of that width and only a cell and the
next one meet. Cells are split into blocks of bounded size, a pair of blocks is a tile. In a
tile products are accumulated over leading dimensions, what is left is bounded by the product
of the suffix norms, and a pair is given up when it cannot reach the threshold any more. A
tile returns link counts and edges to its local components, one row a vector, never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faresight.llm.common import Workspace, components, join_back

THRESHOLD = 0.93
BLOCK = 1024
LEADING = (8, 24)
MARGIN = 1e-9


def _unit(batches):
    for b in batches:
        vec = b.column(3)
        off = vec.offsets.to_numpy()
        flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        off = off - off[0]
        yield b, off, flat


def _moments(dim: int):
    def run(batches):
        g = np.zeros((dim, dim))
        for _, off, flat in _unit(batches):
            full = np.flatnonzero(np.diff(off) == dim)
            for k in range(0, len(full), 8192):
                at = off[full[k:k + 8192]]
                x = unit_rows(flat[at[:, None] + np.arange(dim)])
                g += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(list(g), pa.list_(pa.float64()))], names=["i", "row"])
    return run


def _project(axes: np.ndarray):
    """Bytes of the vector and its first principal coordinate (0 for other lengths)."""
    dim = len(axes)

    def run(batches):
        for b, off, flat in _unit(batches):
            out, first = [], np.zeros(b.num_rows)
            for i in range(b.num_rows):
                x = flat[off[i]:off[i + 1]]
                out.append(x.tobytes())
                if len(x) == dim:
                    scaled = x / np.abs(x).max()
                    first[i] = scaled @ axes[:, 0] / np.linalg.norm(scaled)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary()), pa.array(np.diff(off).astype(np.int32)), pa.array(first)],
                                             names=["label", "rep", "cnt", "vec", "dim", "first"])
    return run


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)       # no overflow or underflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked_pairs(x: np.ndarray, left: np.ndarray, right: np.ndarray, axes: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of rows of ``x`` (original vectors), i from ``left`` and j from ``right``, whose
    cosine reaches the threshold. Rounding near the threshold is settled by the direct product."""
    u = unit_rows(x)
    z = u @ axes if axes is not None and len(axes) == u.shape[1] else u
    dims = [0, *[d for d in LEADING if d < z.shape[1]], z.shape[1]]
    suffix = np.sqrt(np.maximum(np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1], 0))
    suffix = np.concatenate([suffix, np.zeros((len(z), 1))], axis=1)
    i = j = part = None
    for a, b in zip(dims, dims[1:]):
        if i is None:
            grid = z[left, a:b] @ z[right, a:b].T
            ok = grid + suffix[left, b][:, None] * suffix[right, b][None, :] >= threshold - MARGIN
            r, c = np.nonzero(ok)
            i, j, part = left[r], right[c], grid[r, c]
        else:
            keep = np.empty(len(i), bool)
            new = np.empty(len(i))
            for k in range(0, len(i), 1 << 16):
                s = slice(k, k + (1 << 16))
                new[s] = part[s] + np.einsum("ij,ij->i", z[i[s], a:b], z[j[s], a:b])
                keep[s] = new[s] + suffix[i[s], b] * suffix[j[s], b] >= threshold - MARGIN
            i, j, part = i[keep], j[keep], new[keep]
    close = np.flatnonzero(np.abs(part - threshold) <= 10 * MARGIN)
    sure = part >= threshold
    for k in close:
        p, q = x[i[k]], x[j[k]]
        p, q = p / np.abs(p).max(), q / np.abs(q).max()
        sure[k] = float(p @ q) / (float(np.sqrt(p @ p)) * float(np.sqrt(q @ q))) >= threshold
    return i[sure], j[sure]


def _tile(axes, threshold):
    def run(pdf):
        import pandas as pd
        pdf = pdf.sort_values(["first", "rep"])
        x = np.stack([np.frombuffer(v, np.float64) for v in pdf["vec"]])
        side, ids, cnt = pdf["side"].to_numpy(), pdf["rep"].to_numpy(), pdf["cnt"].to_numpy()
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)
        i, j = linked_pairs(x, left, right, axes, threshold)
        if side[0] == 0:
            up = i < j
            i, j = i[up], j[up]
        links = np.bincount(i, cnt[j], len(ids)) + np.bincount(j, cnt[i], len(ids))
        comp = ids.copy()
        while len(i):
            low = np.minimum(comp[i], comp[j])
            new = comp.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            if (new == comp).all():
                break
            comp = new
        on = links > 0
        return pd.DataFrame({"rep": ids[on], "links": links[on].astype("int64"), "hub": comp[on]})
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null, their lengths are equal and their
    cosine in double precision is at least ``threshold``. n_links counts the other rows that a
    row links with, component_id is the smallest vec_id reachable, kept = (vec_id =
    component_id). Null or zero vectors and those with null or non-finite components, and rows
    with a null label, link with nothing (n_links 0, their own component). A row with a null
    id takes no part: component_id null, kept false. Rows of one vec_id are one node. Other
    columns are not read; an empty table gives an empty result."""
    spark = vectors.sparkSession
    ws = Workspace(spark, "embed-dedup")
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    good = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)
                      & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
                      & F.exists("v", lambda x: x != 0), F.lit(False))
    t = src.withColumn("good", good)
    classes = ws.table(t.filter("good").groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("cnt"))
                       .select("label", "rep", "cnt", "v"), "classes")
    dim = classes.agg(F.max(F.size("v"))).first()[0]
    tail = t.filter("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if dim is None:
        return _finish(tail)
    rows = classes.mapInArrow(_moments(dim), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "x")) \
        .groupBy("i", "j").agg(F.sum("x").alias("x")).collect()                    # dim * dim numbers
    g = np.zeros((dim, dim))
    for r in rows:
        g[r["i"], r["j"]] = r["x"]
    axes = np.linalg.eigh((g + g.T) / 2)[1][:, ::-1].copy()
    width = float(np.sqrt(max(2 - 2 * threshold, 0))) * (1 + 1e-6) + 1e-9
    p = ws.table(classes.mapInArrow(_project(axes), f"label {classes.schema['label'].dataType.simpleString()}, rep long, cnt long, vec binary, dim int, first double")
                 .withColumn("cell", F.floor(F.col("first") / width).cast("int")), "projected")
    sizes = ws.table(p.groupBy("label", "dim", "cell").agg(F.count(F.lit(1)).alias("cnt")), "cells")
    nxt = sizes.select("label", "dim", (F.col("cell") - 1).alias("cell"), F.ceil(F.col("cnt") / BLOCK).cast("int").alias("up"))
    prv = sizes.select("label", "dim", (F.col("cell") + 1).alias("cell"), F.ceil(F.col("cnt") / BLOCK).cast("int").alias("down"))
    around = ws.table(sizes.withColumn("nb", F.ceil(F.col("cnt") / BLOCK).cast("int")).join(nxt, ["label", "dim", "cell"], "left")
                      .join(prv, ["label", "dim", "cell"], "left").fillna(0, ["up", "down"]), "around")
    total = around.agg(F.sum("cnt")).first()[0]
    m = join_back(p.withColumnRenamed("cnt", "weight"), around, ["label", "dim", "cell"], total) \
        .withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    own = F.transform(F.expr("sequence(0, nb - 1)"), lambda o: F.struct(
        F.lit(0).alias("d"), F.least("blk", o).alias("i"), F.greatest("blk", o).alias("j"),
        F.when(F.col("blk") == o, 0).when(F.col("blk") < o, 1).otherwise(2).alias("side")))
    up = F.when(F.col("up") > 0, F.transform(F.expr("sequence(0, greatest(up, 1) - 1)"), lambda o: F.struct(
        F.lit(1).alias("d"), F.col("blk").alias("i"), o.alias("j"), F.lit(1).alias("side")))).otherwise(F.expr("array()"))
    down = F.when(F.col("down") > 0, F.transform(F.expr("sequence(0, greatest(down, 1) - 1)"), lambda o: F.struct(
        F.lit(-1).alias("d"), o.alias("i"), F.col("blk").alias("j"), F.lit(2).alias("side")))).otherwise(F.expr("array()"))
    tiles = m.select("label", "dim", "cell", "rep", "vec", "first", F.col("weight").alias("cnt"), F.explode(F.concat(own, up, down)).alias("t")) \
        .select("label", "dim", (F.col("cell") + F.when(F.col("t.d") == -1, -1).otherwise(0)).alias("c"), F.abs("t.d").alias("d"), "t.i", "t.j", "t.side", "rep", "vec", "first", "cnt")
    found = ws.table(tiles.groupBy("label", "dim", "c", "d", "i", "j").applyInPandas(_tile(axes, threshold), "rep long, links long, hub long"), "links")
    comp = components(ws, found.select(F.col("rep").alias("u"), F.col("hub").alias("v")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    final = ws.table(classes.join(links, "rep", "left").join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
                     .select("label", "v", "cnt", (F.coalesce("links", F.lit(0)) + F.col("cnt") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "final")
    ws.drop(classes, p, sizes, around, found)
    out = join_back(t.filter("good").select("vec_id", "label", "v"), final, ["label", "v"], t.filter("good").count())
    return _finish(out.select("vec_id", "n_links", "component_id").unionByName(tail))


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
