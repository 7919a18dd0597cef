"""Evaluation and model comparison.

Metrics of every group come from one aggregate; median errors use the
distributed exact quantiles by default (``median='builtin'`` uses Spark's
``percentile``, ``'approx'`` a bounded sketch, ``None`` skips it).
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faresight.functions import metrics as M
from faresight.functions.scalar import cut_labels
from faresight.operators.prefix import exact_quantiles
from faresight.operators.profile import _join_small, scalars, unpivot

# Fare segments used by the reference's segment report.
FARE_EDGES = (0, 10_000, 25_000, 50_000, 100_000, 200_000, float("inf"))
FARE_LABELS = ("<10K", "10-25K", "25-50K", "50-100K", "100-200K", ">200K")


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (), median: str | None = "exact",
                       mape_floor: float | None = 1.0) -> DataFrame:
    """V1: n, R², MAE, RMSE, MAPE (|e| ÷ max(y,1) · 100), MedAE, mean target,
    mean error (p − y), overall or per ``by`` group."""
    by = list(by)
    parts = list(M.metric_parts(y, p, mape_floor))
    if median == "builtin":
        parts.append(M.medae_builtin(y, p).alias("medae"))
    elif median == "approx":
        parts.append(M.medae_approx(y, p).alias("medae"))
    agg = df.groupBy(*by).agg(*parts)
    fin = M.finish()
    cols = [*by, *[v.alias(k) for k, v in fin.items()]]
    if median in ("builtin", "approx"):
        cols.append("medae")
    out = agg.select(*cols)
    if median == "exact":
        err = df.select(*by, F.abs(F.col(y) - F.col(p)).alias("_ae"))
        med = exact_quantiles(err, "_ae", [0.5], by).withColumnRenamed("q_0", "medae")
        out = _join_small(out, med, by)
    return out


def segment_column(y: str, edges: Sequence[float], labels: Sequence[str], closed: str = "right") -> Column:
    if closed == "right":
        return cut_labels(y, edges, labels, default=None)
    c = F.col(y)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c >= F.lit(lo)) & (c < F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def evaluate_by_segment(df: DataFrame, y: str, p: str, edges: Sequence[float] = FARE_EDGES,
                        labels: Sequence[str] = FARE_LABELS, closed: str = "right", min_n: int = 2,
                        r2_min_n: int = 11, mape_floor: float | None = 1.0) -> DataFrame:
    """V2/V4: metrics per target segment; rows outside every bin are
    ignored, segments with fewer than ``min_n`` rows dropped, R² null below
    ``r2_min_n`` rows."""
    seg = df.withColumn("segment", segment_column(y, edges, labels, closed)).where(F.col("segment").isNotNull())
    m = regression_metrics(seg, y, p, ["segment"], median=None, mape_floor=mape_floor)
    return m.where(F.col("n") >= min_n).select(
        "segment", F.col("n").alias("count"), F.col("mean_target").alias("mean_fare"),
        F.when(F.col("n") >= r2_min_n, F.col("r2")).alias("r2"), "mae", "mape")


def evaluate_by_column(df: DataFrame, y: str, p: str, col: str, min_n: int = 2, r2_min_n: int = 11) -> DataFrame:
    """V3: metrics per value of ``col`` (null group skipped)."""
    m = regression_metrics(df.where(F.col(col).isNotNull()), y, p, [col], median=None)
    return m.where(F.col("n") >= min_n).select(
        F.col(col).alias("group"), F.col("n").alias("count"), F.col("mean_target").alias("mean_fare"),
        F.when(F.col("n") >= r2_min_n, F.col("r2")).alias("r2"), "mae")


def error_share(df: DataFrame, y: str, p: str, segment: Column) -> DataFrame:
    """Per segment n, mean target, MAE, MAPE (unclipped) and share of
    the total absolute error (window over the few aggregated rows)."""
    ae = F.abs(F.col(y) - F.col(p))
    g = df.withColumn("segment", segment).where(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_fare"), F.avg(ae).alias("mae"),
        (F.avg(F.try_divide(ae, F.col(y))) * 100).alias("mape"), F.sum(ae).alias("_sae"))
    tot = scalars(df.agg(F.sum(ae).alias("t")))["t"]
    return g.withColumn("pct_of_total", F.try_divide(F.col("_sae"), F.lit(tot)) * 100).drop("_sae")


def error_quantiles(df: DataFrame, y: str, p: str) -> DataFrame:
    """Median target, median / p90 / p95 absolute error, MedAE ÷ median."""
    e = df.select(F.col(y).alias("_y"), F.abs(F.col(y) - F.col(p)).alias("_ae"))
    qe = scalars(exact_quantiles(e, "_ae", [0.5, 0.9, 0.95]))
    qy = scalars(exact_quantiles(e, "_y", [0.5]))
    spark = df.sparkSession
    med_y = qy["q_0"]
    return spark.createDataFrame([(med_y, qe["q_0"], qe["q_1"], qe["q_2"],
                                   (qe["q_0"] / med_y) if med_y else None)],
                                 "median_target double, medae double, p90 double, p95 double, medae_ratio double")


def residuals(df: DataFrame, y: str, p: str) -> DataFrame:
    """V6: residual and absolute error columns."""
    return df.withColumns({"residual": F.col(y) - F.col(p), "abs_error": F.abs(F.col(y) - F.col(p))})


def long_predictions(df: DataFrame, y: str, preds: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide prediction columns → (model, y, prediction)."""
    return unpivot(df.select(*keep, y, *preds), [*keep, y], preds, "model", "prediction")


def comparison_table(df: DataFrame, y: str, preds: Sequence[str], baseline: str | None = None,
                     median: str | None = "exact") -> DataFrame:
    """V7: metrics per model, deltas to ``baseline`` (absolute and %)."""
    long = long_predictions(df, y, preds)
    m = regression_metrics(long, y, "prediction", ["model"], median=median)
    if baseline is None:
        return m
    base = scalars(m.where(F.col("model") == baseline).select("r2", "mae"))
    return m.withColumns({
        "delta_r2": F.col("r2") - F.lit(base["r2"]),
        "delta_mae": F.col("mae") - F.lit(base["mae"]),
        "delta_mae_pct": F.try_divide(F.col("mae") - F.lit(base["mae"]), F.lit(base["mae"])) * 100})


def select_champion(results: DataFrame, metric: str = "r2", higher_is_better: bool = True,
                    name_col: str = "model") -> DataFrame:
    """The best row by ``metric``; a missing metric always loses
    (ties → smallest name). Raises on an empty table."""
    key = F.col(metric) if higher_is_better else -F.col(metric)
    best = results.agg(F.min_by(F.col(name_col), F.struct(
        F.col(metric).isNull(), -key, F.col(name_col))).alias("_b"), F.count(F.lit(1)).alias("_n"))
    row = scalars(best)
    if not row["_n"]:
        raise ValueError("No model results to compare.")
    return results.where(F.col(name_col) == F.lit(row["_b"]))


def overfit_check(df: DataFrame, y: str, p: str, split: str = "split", by: Sequence[str] = ("model",),
                  gap: float = 0.05) -> DataFrame:
    """V9: train R² − test R² per model, flagged above ``gap``."""
    m = regression_metrics(df, y, p, [*by, split], median=None)
    wide = m.groupBy(*by).agg(F.max(F.when(F.col(split) == "train", F.col("r2"))).alias("train_r2"),
                              F.max(F.when(F.col(split) == "test", F.col("r2"))).alias("test_r2"))
    return wide.withColumns({"gap": F.col("train_r2") - F.col("test_r2"),
                             "overfit": (F.col("train_r2") - F.col("test_r2")) > F.lit(gap)})


def blend(df: DataFrame, preds: Sequence[str], weights: Sequence[float], out: str = "blend") -> DataFrame:
    """Weighted sum of prediction columns (equal, R²-weighted or fixed)."""
    expr = sum((F.lit(float(w)) * F.col(c) for c, w in zip(preds, weights)), F.lit(0.0))
    return df.withColumn(out, expr)


def r2_weights(r2s: Sequence[float]) -> list[float]:
    s = sum(r2s)
    return [r / s for r in r2s]


def weight_grid(k: int, step: float = 0.1) -> list[tuple[float, ...]]:
    """All weight vectors on the simplex with the given step (k=2: 11 pairs, k=3: 66 triples)."""
    m = round(1 / step)
    out = []
    for combo in itertools.product(range(m + 1), repeat=k - 1):
        if sum(combo) <= m:
            out.append(tuple(round(c * step, 10) for c in combo) + (round((m - sum(combo)) * step, 10),))
    return out


def blend_grid_search(df: DataFrame, y: str, preds: Sequence[str], step: float = 0.1) -> DataFrame:
    """MAE of every blend on the grid in ONE aggregate (one column per
    weight vector, no row replication), returned long and ranked."""
    grid = weight_grid(len(preds), step)
    aggs = []
    for i, w in enumerate(grid):
        bl = sum((F.lit(wj) * F.col(c) for c, wj in zip(preds, w)), F.lit(0.0))
        aggs.append(F.avg(F.abs(F.col(y) - bl)).alias(f"g{i}"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("grid_id"), *[F.lit(wj).alias(f"w_{c}") for c, wj in zip(preds, w)],
                     F.col(f"g{i}").alias("mae")) for i, w in enumerate(grid)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def cv_summary(folds: DataFrame, metrics: Sequence[str] = ("r2", "mae")) -> DataFrame:
    """Mean and population std over folds."""
    return folds.agg(*[x for m in metrics for x in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))])
