"""Distributed prefix counts: global row index, running sums and exact
quantiles without ``Window.orderBy`` over the whole table (which would pull
every row into one task).

Pattern: range-partition on (group, order) so partition p holds only keys
below those of partition p+1, fix that layout with a reliable checkpoint
(range bounds come from sampling and could differ on recomputation), take
per-partition totals (a table bounded by #partitions + #groups), turn them
into offsets and add them to partition-local running sums. A hot group is
split over many range partitions, so no task holds more than one range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from faresight.session import materialize

def _sort_exprs(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _range_layout(df: DataFrame, keys: Sequence, n: int | None) -> DataFrame:
    """Range partitions on ``keys``, sorted within, tagged with their id.
    Without ``n`` the count is left to adaptive execution, which coalesces
    adjacent (hence still ordered) ranges to the advisory partition size."""
    keys = _sort_exprs(keys)
    ranged = df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).withColumn("_pid", F.spark_partition_id())


def _partition_offsets(counts: dict[int, int]) -> tuple[list[int], int]:
    """Exclusive running totals per partition id (ids without rows get the
    running total too); returns (offsets indexed by id, grand total)."""
    n_parts = (max(counts) + 1) if counts else 0
    offs, run = [], 0
    for p in range(n_parts):
        offs.append(run)
        run += counts.get(p, 0)
    return offs, run


def row_index_and_count(df: DataFrame, order: Sequence, idx_col: str = "row_idx",
                        num_partitions: int | None = None, keep: Sequence[str] | None = None) -> tuple[DataFrame, int]:
    """Add a 0-based global position in the total order ``order``; also
    return the row count. With ``keep`` only those columns are written, the
    others are left behind after the sort. ``drop_table`` takes the frame.

    Within a range partition the position comes from
    ``monotonically_increasing_id`` (partition id in the upper bits, row
    number in the lower 33). The per-partition counts are one row per
    partition, so they are collected and applied as a literal array indexed
    by partition id: no join, no extra shuffle.
    """
    laid = _range_layout(df, order, num_partitions).withColumn("_mid", F.monotonically_increasing_id())
    ck = materialize(laid.select(*keep, "_pid", "_mid") if keep is not None else laid)
    counts = {r["_pid"]: r["_n"] for r in ck.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()}
    offs, n = _partition_offsets(counts)
    off = F.element_at(F.array(*[F.lit(o) for o in offs]), F.col("_pid") + 1) if offs else F.lit(0)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = ck.withColumn(idx_col, (off + local).cast("long")).drop("_pid", "_mid")
    out._table = ck._table
    return out, n


def with_row_index(df: DataFrame, order: Sequence, idx_col: str = "row_idx",
                   num_partitions: int | None = None) -> DataFrame:
    return row_index_and_count(df, order, idx_col, num_partitions)[0]


def prefix_sums(df: DataFrame, order: Sequence, weights: Sequence[str], group: Sequence[str] = (),
                prefix: str = "cum_", num_partitions: int | None = None) -> DataFrame:
    """Running (inclusive) sums of ``weights`` within ``group`` along ``order``.

    Adds ``cum_<w>`` per weight. Equal order keys get successive running
    values; aggregate duplicates first (``groupBy(group, key)``) when ties
    must share one value.
    """
    return _prefix_sums(df, order, weights, group, prefix, num_partitions)[0]


def _prefix_sums(df: DataFrame, order: Sequence, weights: Sequence[str], group: Sequence[str] = (),
                 prefix: str = "cum_", num_partitions: int | None = None) -> tuple[DataFrame, dict | None]:
    group = list(group)
    laid = _range_layout(df, [*group, *order], num_partitions)
    ck = materialize(laid)
    local_w = Window.partitionBy("_pid", *group).orderBy(*_sort_exprs(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ck.select("*", *[F.sum(w).over(local_w).alias(f"_loc_{w}") for w in weights])
    totals = ck.groupBy("_pid", *group).agg(*[F.sum(w).alias(f"_tot_{w}") for w in weights])
    if not group:
        # one row per partition: collected, applied as literal arrays by partition id
        rows = {r["_pid"]: r for r in totals.collect()}
        grand = {}
        offs_cols = {}
        for w in weights:
            offs, grand[w] = _partition_offsets({p: (r[f"_tot_{w}"] or 0) for p, r in rows.items()})
            arr = F.array(*[F.lit(o) for o in offs]) if offs else None
            offs_cols[w] = F.element_at(arr, F.col("_pid") + 1) if arr is not None else F.lit(0)
        out = local.select(*[c for c in df.columns],
                           *[(F.col(f"_loc_{w}") + offs_cols[w]).alias(f"{prefix}{w}") for w in weights])
        return out, grand
    return _layout_sums(ck, order, weights, group, prefix, df.columns), None


def _layout_sums(ck: DataFrame, order: Sequence, weights: Sequence[str], group: list[str], prefix: str, columns: Sequence[str]) -> DataFrame:
    """Running sums within ``group`` over a written range layout."""
    local_w = Window.partitionBy("_pid", *group).orderBy(*_sort_exprs(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ck.select("*", *[F.sum(w).over(local_w).alias(f"_loc_{w}") for w in weights])
    totals = ck.groupBy("_pid", *group).agg(*[F.sum(w).alias(f"_tot_{w}") for w in weights])
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select("_pid", *group, *[F.coalesce(F.sum(f"_tot_{w}").over(before), F.lit(0))
                                            .alias(f"_off_{w}") for w in weights])
    # rename the offsets' keys: both sides derive from one checkpoint. The
    # table has at most #partitions + #groups rows; AQE sizes the join.
    offs = offs.select(F.col("_pid").alias("_opid"), *[F.col(g).alias(f"_og_{g}") for g in group],
                       *[f"_off_{w}" for w in weights])
    cond = [local["_pid"] == offs["_opid"]] + [local[g].eqNullSafe(offs[f"_og_{g}"]) for g in group]
    joined = local.join(offs, cond)
    return joined.select(*columns, *[(F.col(f"_loc_{w}") + F.col(f"_off_{w}")).alias(f"{prefix}{w}") for w in weights])


def _global_quantiles(df: DataFrame, value: str, probs: Sequence[float], num_partitions: int | None) -> DataFrame:
    vals = (df.select(F.col(value).alias("_v")).where(F.col("_v").isNotNull())
              .groupBy("_v").agg(F.count(F.lit(1)).alias("_c")))
    cum, tot = _prefix_sums(vals, ["_v"], ["_c"], num_partitions=num_partitions)
    n = tot["_c"]
    spark = df.sparkSession
    schema = ", ".join(f"q_{i} double" for i in range(len(probs)))
    if not n:
        return spark.createDataFrame([tuple(None for _ in probs)], schema)
    hs = [float(q) * (n - 1) for q in probs]
    ks = sorted({int(math.floor(h)) for h in hs} | {int(math.ceil(h)) for h in hs})
    prev = F.col("cum__c") - F.col("_c")
    # one array of positions: a condition per position would outgrow the generated code
    cond = F.exists(F.array(*[F.lit(k).cast("long") for k in ks]), lambda k: (prev <= k) & (k < F.col("cum__c")))
    hits = cum.where(cond).select("_v", prev.alias("_p"), F.col("cum__c").alias("_e")).collect()  # ≤ 2·len(probs) rows

    def at(k):
        return next(float(r["_v"]) for r in hits if r["_p"] <= k < r["_e"])
    row = []
    for h in hs:
        lo, hi = at(int(math.floor(h))), at(int(math.ceil(h)))
        row.append(lo + (h - math.floor(h)) * (hi - lo))
    return spark.createDataFrame([tuple(row)], schema)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = (),
                    num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy ``linear``, DuckDB
    ``quantile_cont``), distributed.

    Values are first reduced to (group, value, count); positions come from
    prefix sums, so no task ever holds a whole group. Returns one row per
    group with ``q_<i>`` columns in the order of ``probs``. Nulls are ignored.
    """
    group = list(group)
    if not group:
        return _global_quantiles(df, value, probs, num_partitions)
    vals = (df.select(*group, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
              .groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c")))
    laid = materialize(_range_layout(vals, [*group, "_v"], num_partitions))
    cum = _layout_sums(laid, ["_v"], ["_c"], group, "cum_", vals.columns)
    cum = cum.withColumn("_prev", F.col("cum__c") - F.col("_c"))
    n = laid.groupBy(*group).agg(F.sum("_c").alias("_n"))  # from the written layout, not the upstream plan again
    targets = n.select(*group, F.explode(F.array(*[
        F.struct(F.lit(i).alias("qi"), (F.lit(float(q)) * (F.col("_n") - 1)).alias("h"))
        for i, q in enumerate(probs)])).alias("t")).select(*group, "t.qi", "t.h")
    targets = targets.select(*group, "qi", "h", F.floor("h").cast("long").alias("k_lo"),
                             F.ceil("h").cast("long").alias("k_hi"))
    # Each target position k finds the one value with prev <= k < cum.
    tk = targets.select(*group, "qi", "h", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("k_lo").alias("k")),
        F.struct(F.lit(1).alias("side"), F.col("k_hi").alias("k")))).alias("s")).select(
        *group, "qi", "h", "s.side", "s.k")
    tk = tk.select(*[F.col(g).alias(f"_tg_{g}") for g in group], "qi", "h", "side", "k")
    cond = [(cum["_prev"] <= tk["k"]) & (tk["k"] < cum["cum__c"])] + [cum[g].eqNullSafe(tk[f"_tg_{g}"]) for g in group]
    hit = cum.join(tk, cond).select(*[tk[f"_tg_{g}"].alias(g) for g in group], tk["qi"], tk["h"], tk["side"], cum["_v"])
    per_q = (hit.groupBy(*group, "qi", "h")
                .agg(F.max(F.when(F.col("side") == 0, F.col("_v"))).alias("lo"),
                     F.max(F.when(F.col("side") == 1, F.col("_v"))).alias("hi"))
                .select(*group, "qi", (F.col("lo") + (F.col("h") - F.floor("h")) * (F.col("hi") - F.col("lo")))
                        .alias("qv")))
    wide = per_q.groupBy(*group).agg(*[F.max(F.when(F.col("qi") == i, F.col("qv"))).alias(f"q_{i}")
                                       for i in range(len(probs))])
    return wide
