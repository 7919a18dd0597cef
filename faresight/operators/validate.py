"""Request validation as predicates, splitting rows into valid and
rejected with the first failing reason; domains are checked by a join
against the distinct allowed values (broadcast by AQE when small)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F




def validate_requests(df: DataFrame, required: Sequence[str] = (), non_negative: Sequence[str] = (),
                      domains: dict[str, DataFrame] | None = None) -> DataFrame:
    """Adds ``reason`` ('valid', 'missing_field', 'negative_<col>',
    'unknown_<col>') and ``valid``. Checks run in that order."""
    out = df
    flags = []
    for col, src in (domains or {}).items():
        dom = src.select(F.col(col).alias(f"_dom_{col}")).where(F.col(f"_dom_{col}").isNotNull()).distinct()
        dom = dom.withColumn(f"_ok_{col}", F.lit(True))  # AQE sizes it at runtime
        out = out.join(dom, out[col] == dom[f"_dom_{col}"], "left").drop(f"_dom_{col}")
        flags.append(col)
    reason = None
    if required:
        miss = F.lit(False)
        for c in required:
            miss = miss | F.col(c).isNull()
        reason = F.when(miss, F.lit("missing_field"))
    for c in non_negative:
        cond = F.col(c) < 0
        reason = F.when(cond, F.lit(f"negative_{c}")) if reason is None else reason.when(cond, F.lit(f"negative_{c}"))
    for c in flags:
        cond = F.col(f"_ok_{c}").isNull()
        reason = F.when(cond, F.lit(f"unknown_{c}")) if reason is None else reason.when(cond, F.lit(f"unknown_{c}"))
    reason = F.lit("valid") if reason is None else reason.otherwise(F.lit("valid"))
    return (out.withColumn("reason", reason).withColumn("valid", F.col("reason") == "valid")
               .drop(*[f"_ok_{c}" for c in flags]))
