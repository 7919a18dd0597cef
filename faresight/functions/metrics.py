"""Regression metric aggregates (V1) as Spark aggregate expressions.

All metrics of one frame (or of every group) come from one ``agg``:
SSE, |e|, |e|/max(y,1), population variance of y (Spark's merge is
numerically stable, unlike Σy² − nȳ²) and, when asked for, the median
absolute error.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def avg_exact(c, scale: int = 6) -> Column:
    """Mean over DECIMAL values: exact and independent of summation order,
    for small groups whose mean can land exactly on a rounding tie."""
    return F.avg(_c(c).cast(f"decimal(38,{scale})")).cast("double")


def r2_from(sse: Column, sst: Column) -> Column:
    """1 − SSE/SST; a constant target scores 1 when predicted exactly, else 0."""
    return (F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
             .otherwise(F.lit(1.0) - sse / sst))


def metric_parts(y, p, mape_floor: float | None = 1.0) -> list[Column]:
    """Partial aggregates ``_n _sse _sae _sape _sst _ybar _err``; combine with ``finish``."""
    y, p = _c(y), _c(p)
    e = y - p
    denom = F.greatest(y, F.lit(mape_floor)) if mape_floor is not None else y
    paired = F.when(p.isNotNull(), y)  # rows without a target or a prediction count nowhere
    return [
        F.count(e).alias("_n"),
        F.sum(e * e).alias("_sse"),
        F.sum(F.abs(e)).alias("_sae"),
        F.sum(F.try_divide(F.abs(e), denom)).alias("_sape"),
        (F.var_pop(paired) * F.count(e)).alias("_sst"),
        F.avg(paired).alias("_ybar"),
        F.avg(p - y).alias("_err"),
    ]


def finish(prefix: str = "") -> dict[str, Column]:
    n = F.col("_n")
    return {
        f"{prefix}n": n,
        f"{prefix}r2": r2_from(F.col("_sse"), F.col("_sst")),
        f"{prefix}mae": F.col("_sae") / n,
        f"{prefix}rmse": F.sqrt(F.col("_sse") / n),
        f"{prefix}mape": F.col("_sape") / n * F.lit(100.0),
        f"{prefix}mean_target": F.col("_ybar"),
        f"{prefix}mean_error": F.col("_err"),
    }


def medae_builtin(y, p) -> Column:
    """Exact median |e| with Spark's ``percentile`` (value→count map per group);
    use ``faresight.operators.evaluate.regression_metrics(median='exact')``
    for high-cardinality errors at scale."""
    return F.percentile(F.abs(_c(y) - _c(p)), F.lit(0.5))


def medae_approx(y, p, accuracy: int = 10_000) -> Column:
    return F.percentile_approx(F.abs(_c(y) - _c(p)), F.lit(0.5), F.lit(accuracy))


# DuckDB snippets for the oracle queries, same formulas.
def sql_metric_parts(y: str, p: str, mape_floor: float | None = 1.0) -> str:
    denom = f"greatest({y}, {mape_floor})" if mape_floor is not None else y
    return (f"count(*) AS _n, sum(({y} - {p}) * ({y} - {p})) AS _sse, sum(abs({y} - {p})) AS _sae, "
            f"sum(abs({y} - {p}) / {denom}) AS _sape, var_pop({y}) * count(*) AS _sst, avg({y}) AS _ybar, "
            f"avg({p} - {y}) AS _err")


def sql_r2(sse: str = "_sse", sst: str = "_sst") -> str:
    return f"(CASE WHEN {sst} = 0 THEN (CASE WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 - {sse} / {sst} END)"
