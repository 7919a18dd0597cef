"""Linear learners from sufficient statistics.

One pass over the rows gives, per fold, the moment matrix of [1, x, y] (partial numpy
products inside Arrow tasks, summed by an aggregate of (d + 2)² rows a fold). Every ridge
and lasso solution, whole regularisation paths and fold-wise validation then cost d × d
solves, whatever the number of rows; a second pass scores any number of coefficient vectors
at once. The objectives are the usual ones on standardised features:

* ridge(α): ‖y − b − Xw‖² + α‖w‖²            * lasso(α): ‖y − b − Xw‖² / 2n + α‖w‖₁
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def moments(df: DataFrame, cols: Sequence[str], y: str, fold: str | None = None) -> dict[int, np.ndarray]:
    """Moment matrices (d + 2, d + 2) of [1, x, y] by fold (0 without one). Rows with a null
    or NaN among them are left out. Driver: (d + 2)² numbers a fold."""
    names, d = [*cols, y], len(cols) + 2

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            x = pdf[names].to_numpy(dtype=float)
            ok = ~np.isnan(x).any(axis=1)
            folds = pdf["_fold"].to_numpy()[ok]
            z = np.column_stack([np.ones(ok.sum()), x[ok]])
            for f in np.unique(folds):
                part = z[folds == f]
                acc[int(f)] = acc.get(int(f), 0.0) + part.T @ part
        for f, g in acc.items():
            yield pd.DataFrame({"fold": f, "k": np.arange(d * d), "v": g.ravel()})
    src = df.select(*[F.col(c).cast("double").alias(c) for c in names], (F.col(fold).cast("int") if fold else F.lit(0)).alias("_fold"))
    rows = src.where(F.col("_fold").isNotNull()).mapInPandas(partial, "fold int, k int, v double").groupBy("fold", "k").agg(F.sum("v").alias("v")).collect()
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["fold"], np.zeros(d * d))[r["k"]] = r["v"]
    return {f: g.reshape(d, d) for f, g in sorted(out.items())}


def _centred(m: np.ndarray) -> tuple[float, np.ndarray, float, np.ndarray, np.ndarray]:
    n, mx, my = m[0, 0], m[0, 1:-1] / m[0, 0], m[0, -1] / m[0, 0]
    return n, mx, my, m[1:-1, 1:-1] - n * np.outer(mx, mx), m[1:-1, -1] - n * mx * my


def ridge(m: np.ndarray, alpha: float) -> np.ndarray:
    """[intercept, w]; the intercept is not penalised."""
    n, mx, my, s, b = _centred(m)
    w = np.linalg.lstsq(s + alpha * np.eye(len(b)), b, rcond=None)[0]
    return np.concatenate([[my - mx @ w], w])


def lasso(m: np.ndarray, alpha: float, start: np.ndarray | None = None, rounds: int = 10_000, tol: float = 1e-10) -> np.ndarray:
    """[intercept, w] by coordinate descent on the moments, warm-started."""
    n, mx, my, s, b = _centred(m)
    s, b = s / n, b / n
    w = np.zeros(len(b)) if start is None else start[1:].copy()
    scale = max(float(np.abs(b).max(initial=0.0)), 1e-300)
    for _ in range(rounds):
        step = 0.0
        for j in np.flatnonzero(np.diag(s) > 0):
            old = w[j]
            rho = b[j] - s[j] @ w + s[j, j] * old
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0.0) / s[j, j]
            step = max(step, abs(w[j] - old) * s[j, j])
        if step <= tol * scale:
            break
    return np.concatenate([[my - mx @ w], w])


def r2_on(m: np.ndarray, coef: np.ndarray) -> float:
    """R² of a coefficient vector on the rows behind a moment matrix."""
    v = np.concatenate([-coef, [1.0]])
    n, my = m[0, 0], m[0, -1] / m[0, 0]
    sst = m[-1, -1] - n * my * my
    sse = float(v @ m @ v)
    return float(1.0 - sse / sst) if sst > 0 else float(sse <= 0)


def lasso_cv(folds: dict[int, np.ndarray], alphas: Sequence[float]) -> tuple[float, dict[float, float], np.ndarray]:
    """Best α by mean held-out squared error over the folds, the errors by α, and the
    coefficients fitted on all rows."""
    total = sum(folds.values())
    errors = {}
    for a in alphas:
        sse = []
        for f, held in folds.items():
            v = np.concatenate([-lasso(total - held, a), [1.0]])
            sse.append(float(v @ held @ v) / held[0, 0])
        errors[float(a)] = float(np.mean(sse))
    best = min(errors, key=lambda a: (errors[a], a))
    return best, errors, lasso(total, best)


def path(m: np.ndarray, alphas: Sequence[float], kind: str) -> list[np.ndarray]:
    """Solutions in the order of ``alphas`` (lasso from the strongest, each warm-started)."""
    if kind == "ridge":
        return [ridge(m, a) for a in alphas]
    out: dict[float, np.ndarray] = {}
    last = None
    for a in sorted(alphas, reverse=True):
        last = out[a] = lasso(m, a, last)
    return [out[a] for a in alphas]


def absolute_errors(df: DataFrame, cols: Sequence[str], y: str, coefs: Sequence[np.ndarray]) -> list[float]:
    """Mean absolute error of each coefficient vector, all in one pass."""
    names, w = [*cols, y], np.column_stack(coefs)

    def partial(batches):
        total, n = np.zeros(w.shape[1]), 0
        for pdf in batches:
            x = pdf[names].to_numpy(dtype=float)
            x = x[~np.isnan(x).any(axis=1)]
            total += np.abs(x[:, -1:] - (w[0] + x[:, :-1] @ w[1:])).sum(axis=0)
            n += len(x)
        yield pd.DataFrame({"k": np.arange(w.shape[1]), "s": total, "n": n})
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in names]).mapInPandas(partial, "k int, s double, n long") \
        .groupBy("k").agg((F.sum("s") / F.sum("n")).alias("mae")).collect()  # one row per vector
    return [r["mae"] for r in sorted(rows, key=lambda r: r["k"])]
