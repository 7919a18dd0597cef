"""Isolation-forest outlier flag (no row is removed).

Each tree gets its own ``sample_size`` rows, those with the smallest hash of
(seed, tree, row content) among all complete rows of the frame, so the samples
cover the whole input and do not depend on its partitioning. Trees are grown on
the driver from these samples (25,600 rows by default), as the method
prescribes; every row is then scored in parallel by a vectorised pass
(of a forest over one column: by its steps), and the flag threshold is the exact (1 − contamination)
quantile of the scores, computed distributed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from faresight.operators.prefix import exact_quantiles
from faresight.operators.profile import scalars


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> tuple[np.ndarray, ...]:
    """One isolation tree as arrays (feature, split, left, right, size);
    feature −1 marks a leaf."""
    feat, split, left, right, size = [], [], [], [], []

    def new():
        for a in (feat, split, left, right, size):
            a.append(0)
        return len(feat) - 1
    stack = [(new(), np.arange(len(x)), 0)]
    while stack:
        me, idx, d = stack.pop()
        size[me] = len(idx)
        sub = x[idx]
        cand = np.where(sub.max(axis=0) > sub.min(axis=0))[0] if len(idx) > 1 else np.array([], int)
        if d >= limit or len(cand) == 0:
            feat[me], left[me], right[me] = -1, -1, -1
            continue
        f = int(rng.choice(cand))
        sp = float(rng.uniform(sub[:, f].min(), sub[:, f].max()))
        lo, hi = new(), new()
        feat[me], split[me], left[me], right[me] = f, sp, lo, hi
        stack.append((lo, idx[sub[:, f] < sp], d + 1))
        stack.append((hi, idx[sub[:, f] >= sp], d + 1))
    return (np.array(feat), np.array(split, dtype=float), np.array(left), np.array(right), np.array(size))


def _c_vec(n: np.ndarray) -> np.ndarray:
    n = n.astype(float)
    out = np.where(n > 2, 2.0 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2.0 * (n - 1) / np.maximum(n, 1), 0.0)
    return np.where(n == 2, 1.0, out)


def _path_lengths(x: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """Path length of every row of a batch, all rows advanced one level at a time."""
    feat, split, left, right, size = tree
    node = np.zeros(len(x), dtype=int)
    depth = np.zeros(len(x))
    rows = np.arange(len(x))
    while True:
        f = feat[node]
        go = f >= 0
        if not go.any():
            break
        r, nd = rows[go], node[go]
        node[go] = np.where(x[r, f[go]] < split[nd], left[nd], right[nd])
        depth[go] += 1
    return depth + _c_vec(size[node])


def _scores(x: np.ndarray, trees: Sequence[tuple[np.ndarray, ...]], cpsi: float) -> np.ndarray:
    return np.power(2.0, -np.mean([_path_lengths(x, t) for t in trees], axis=0) / cpsi)


def _steps(trees: Sequence[tuple[np.ndarray, ...]], cpsi: float) -> tuple[np.ndarray, np.ndarray]:
    """Scores of a forest over one column, which are constant between its splits: the sorted
    splits, and the score below the first and from each on."""
    at = np.unique(np.concatenate([t[1][t[0] >= 0] for t in trees]))
    return at, _scores(np.concatenate([[-np.inf], at])[:, None], trees, cpsi)


def tree_samples(df: DataFrame, cols: Sequence[str], n_trees: int, sample_size: int, seed: int = 42) -> DataFrame:
    """(tree, cols): ``sample_size`` complete rows of ``df`` per tree (all, if fewer). A row
    competes for a tree when its hash lies below a bound that about 2 · ``sample_size`` rows
    pass, so the per-tree ranking sees a bounded number of rows whatever the input."""
    x = df.select(*df.columns, *[F.col(c).cast("double").alias(f"_x_{c}") for c in cols]).na.drop(subset=[f"_x_{c}" for c in cols])
    n = scalars(x.agg(F.count(F.lit(1)).alias("n")))["n"]
    share = min(1.0, (2 * sample_size + 64) / max(n, 1))
    row = F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns])
    bound = int(-2 ** 63 + share * (2 ** 64 - 1)) if share < 1 else 2 ** 63 - 1

    def drawn(r):
        return F.filter(F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(t.alias("tree"), F.xxhash64(t, r).alias("h"))),
                        lambda s: s["h"] <= F.lit(bound))
    hits = F.flatten(F.transform(F.array(row), drawn))       # as a lambda's argument the row hash is taken once, not once per tree
    x = x.select(*[f"_x_{c}" for c in cols], F.explode(hits).alias("s"))
    w = Window.partitionBy("s.tree").orderBy("s.h", *[f"_x_{c}" for c in cols])
    return x.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= sample_size).select(
        F.col("s.tree").alias("tree"), *[F.col(f"_x_{c}").alias(c) for c in cols])


def isolation_forest(df: DataFrame, cols: Sequence[str], n_trees: int = 100, sample_size: int = 256,
                     contamination: float = 0.01, seed: int = 42) -> DataFrame:
    """Adds ``anomaly_score`` (higher = more isolated, 2^(−E[h]/c(ψ))) and
    ``is_outlier`` (score above the (1 − contamination) quantile). A row with
    a null among ``cols`` has a null score and is not flagged."""
    cols = list(cols)
    pool = tree_samples(df, cols, n_trees, sample_size, seed).toPandas()  # bounded: ψ · n_trees rows
    pool = pool.sort_values(["tree", *cols])
    rng = np.random.default_rng(seed)
    trees, psi = [], 0
    for _, part in pool.groupby("tree"):
        x = part[cols].to_numpy(dtype=float)
        psi = max(psi, len(x))
        trees.append(_grow(x, rng, int(math.ceil(math.log2(max(len(x), 2))))))
    cpsi = _c(psi)
    bc = df.sparkSession.sparkContext.broadcast(_steps(trees, cpsi) if len(cols) == 1 and cpsi > 0 else trees)  # n_trees × O(ψ) nodes

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        ts = bc.value
        for pdf in batches:
            x = pdf[cols].astype("float64").to_numpy()
            whole = ~np.isnan(x).any(axis=1)
            s = np.full(len(x), np.nan)
            if cpsi > 0 and whole.any():
                s[whole] = ts[1][np.searchsorted(ts[0], x[whole, 0], side="right")] if len(cols) == 1 else _scores(x[whole], ts, cpsi)
            else:
                s[whole] = 0.5
            yield pd.Series(pd.array(s, dtype="Float64"))
    # only ``cols`` go through Python; the other columns stay where they are
    scored = df.withColumn("anomaly_score", score(F.struct(*cols)))
    thr = scalars(exact_quantiles(scored, "anomaly_score", [1.0 - contamination]))["q_0"]
    return scored.withColumn("is_outlier", F.coalesce(F.col("anomaly_score") > F.lit(thr), F.lit(False)))


