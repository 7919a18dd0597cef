"""Lookups fitted on one set and applied to another (J1–J3, J6, J7, W2, W3,
V10, V11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from faresight.functions.scalar import cut_codes_array
from faresight.operators.prefix import exact_quantiles, prefix_sums
from faresight.operators.profile import scalars
from faresight.session import materialize

# A fitted lookup of at most this many bytes is broadcast (an executor holds it once per join of
# the plan: the ceiling test, the plan with most of them, joins eight).
LOOKUP_BROADCAST_BYTES = 32 << 20


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as a joined side holds it: 16 a column and the text of its strings."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return sum(texts, F.lit(16 * len(df.columns)))


def fit_lookup(lookup: DataFrame) -> tuple[DataFrame, int]:
    """Materialise a fitted lookup (an aggregate of the training side) once in the checkpoint
    folder and add up its bytes from there: joins then read the stored table, and the size
    check costs no recomputation."""
    ck = materialize(lookup)
    return ck, int(ck.agg(F.sum(row_bytes(ck))).first()[0] or 0)


def join_fitted(df: DataFrame, lookup: DataFrame, n_bytes: int, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join with a fitted lookup: broadcast when its measured size is within
    ``LOOKUP_BROADCAST_BYTES`` (the probe side is never shuffled), a shuffle
    join with AQE skew splitting beyond."""
    side = F.broadcast(lookup) if n_bytes <= LOOKUP_BROADCAST_BYTES else lookup
    return df.join(side, list(keys), how)


def join_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join with a derived lookup whose size is unknown. No hint: AQE
    broadcasts it when its materialised size is under the threshold and
    otherwise keeps a shuffle join."""
    return df.join(lookup, list(keys), how)

def fit_group_mean(train: DataFrame, keys: Sequence[str], target: str, out: str = "_pred") -> DataFrame:
    """Group means of the target on train, null keys left out (a null key
    never matches in an equi-join, as in a pandas groupby lookup)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return train.where(cond).groupBy(*keys).agg(F.avg(target).alias(out))

def apply_group_mean(test: DataFrame, lookup: DataFrame, keys: Sequence[str], global_mean: float,
                     out: str = "prediction", lookup_col: str = "_pred", n_bytes: int | None = None) -> DataFrame:
    """Left join, ``matched`` flag, missing → global train mean."""
    if n_bytes is None:
        lookup, n_bytes = fit_lookup(lookup)
    j = join_fitted(test, lookup, n_bytes, keys)
    return (j.withColumn("matched", F.col(lookup_col).isNotNull())
             .withColumn(out, F.coalesce(F.col(lookup_col), F.lit(global_mean))).drop(lookup_col))

def group_mean_predictor(train: DataFrame, test: DataFrame, keys: Sequence[str], target: str,
                         out: str = "prediction") -> DataFrame:
    gm = scalars(train.agg(F.avg(target).alias("m")))["m"]
    return apply_group_mean(test, fit_group_mean(train, keys, target), keys, gm, out)

def fit_nested_group_means(train: DataFrame, keys: Sequence[str], target: str, levels: Sequence[int]
                           ) -> tuple[DataFrame, dict[int, int], float]:
    """Group means for nested key sets (the first L keys, for each L in
    ``levels``) from ONE ``rollup`` aggregation instead of one scan per key
    set. Rows with a missing key are left out of that level only (a rollup
    null is told from a data null by ``grouping_id``). The table is
    materialised once; returns it, the rows per level and the global mean.
    """
    keys = list(keys)
    k = len(keys)
    agg = train.rollup(*keys).agg(F.avg(target).alias("_pred"), F.grouping_id().alias("_gid"))
    want = {(1 << (k - lv)) - 1: lv for lv in levels}
    cond = None
    for gid, lv in want.items():
        c = F.col("_gid") == gid
        for key in keys[:lv]:
            c = c & F.col(key).isNotNull()
        cond = c if cond is None else cond | c
    gm_gid = (1 << k) - 1
    table = materialize(agg.where(cond | (F.col("_gid") == gm_gid)))
    sizes = {want[r["_gid"]]: r["n"] for r in table.groupBy("_gid").agg(F.sum(row_bytes(table)).alias("n")).collect()
             if r["_gid"] in want}  # one row per level
    gm = table.where(F.col("_gid") == gm_gid).select("_pred").first()
    return table, {lv: sizes.get(lv, 0) for lv in levels}, (gm[0] if gm else None)


def apply_nested_level(test: DataFrame, table: DataFrame, keys: Sequence[str], level: int, n_bytes: int,
                       global_mean: float, out: str = "prediction") -> DataFrame:
    """Score ``test`` with the level-``level`` lookup of ``fit_nested_group_means``."""
    k = len(keys)
    lk = table.where(F.col("_gid") == (1 << (k - level)) - 1).select(*keys[:level], "_pred")
    return apply_group_mean(test, lk, list(keys[:level]), global_mean, out, n_bytes=n_bytes)


def fit_frequency(train: DataFrame, col: str) -> DataFrame:
    """A9 for one column: (value, freq), nulls out of both counts."""
    counts = train.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    total = scalars(counts.agg(F.sum("_c").alias("t")))["t"] or 0
    return counts.select(col, (F.col("_c") / F.lit(float(total) if total else 1.0)).alias(f"{col}_freq"))

def apply_frequency(df: DataFrame, lookup: DataFrame, col: str) -> DataFrame:
    """Map value → frequency, unseen or null → 0."""
    return join_lookup(df, lookup, [col]).withColumn(f"{col}_freq", F.coalesce(F.col(f"{col}_freq"), F.lit(0.0)))

def ecdf_against(ref: DataFrame, df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """For each row of ``df``, the share of ``ref`` values ≤ its value
    ((ref <= x).mean()); null → null. Distinct values of both sides are
    merged and prefix-counted — no nested loop."""
    out = out or f"{col}_pctrank"
    rv = ref.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).groupBy("_v").agg(
        F.count(F.lit(1)).alias("_w"))
    qv = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).distinct().withColumn("_w", F.lit(0))
    n_ref = scalars(rv.agg(F.sum("_w").alias("n")))["n"] or 0
    merged = rv.unionByName(qv).groupBy("_v").agg(F.sum("_w").alias("_w"))
    cum = prefix_sums(merged, ["_v"], ["_w"]).select(
        F.col("_v").alias(col), (F.col("cum__w") / F.lit(float(n_ref) if n_ref else float("nan"))).alias(out))
    return join_lookup(df, cum, [col])

def average_rank_pct(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """``rank(pct=True)`` — average rank of ties divided by the number of
    non-null values (not ``percent_rank``)."""
    out = out or f"{col}_pctrank"
    vals = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).groupBy("_v").agg(
        F.count(F.lit(1)).alias("_c"))
    n = scalars(vals.agg(F.sum("_c").alias("n")))["n"] or 0
    cum = prefix_sums(vals, ["_v"], ["_c"])
    avg_rank = (F.col("cum__c") - F.col("_c")) + (F.col("_c") + F.lit(1)) / F.lit(2.0)
    lk = cum.select(F.col("_v").alias(col), (avg_rank / F.lit(float(n) if n else float("nan"))).alias(out))
    return join_lookup(df, lk, [col])

def out_of_fold_group_mean(df: DataFrame, keys: Sequence[str], target: str, fold: str, out: str) -> DataFrame:
    """Group mean of ``target`` over the other folds, per row; a group that no other fold has
    (or a null key) gets the other folds' overall mean. One aggregate by (keys, fold): a
    fold's complement is the total less its own sums."""
    keys = list(keys)
    known = df.where(F.col(target).isNotNull())
    per = known.dropna(subset=keys).groupBy(*keys, fold).agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    w = Window.partitionBy(*keys)  # one row per fold
    comp = per.select(*keys, fold, F.try_divide(F.sum("_s").over(w) - F.col("_s"), F.sum("_n").over(w) - F.col("_n")).alias(out))
    folds = known.groupBy(fold).agg(F.sum(target).alias("_s"), F.count(target).alias("_n")).collect()  # one row per fold
    s, n = sum(r["_s"] for r in folds), sum(r["_n"] for r in folds)
    rest = {r[fold]: (s - r["_s"]) / (n - r["_n"]) if n > r["_n"] else None for r in folds}
    overall = F.coalesce(*[F.when(F.col(fold) == f, F.lit(v)) for f, v in rest.items()]) if rest else F.lit(None).cast("double")
    return df.join(comp, [*keys, fold], "left").withColumn(out, F.coalesce(F.col(out), overall))

def qcut_edges_many(train: DataFrame, col: str, qs: Sequence[int]) -> dict[int, list[float]]:
    """F13 for several bin counts from one exact-quantile pass: q → edges of
    ``pd.qcut(x, q, retbins=True, duplicates='drop')``."""
    probs = sorted({i / q for q in qs for i in range(q + 1)})
    row = scalars(exact_quantiles(train, col, probs))
    at = {p: row[f"q_{i}"] for i, p in enumerate(probs)}
    return {q: sorted({float(at[i / q]) for i in range(q + 1) if at[i / q] is not None}) for q in qs}

def qcut_edges(train: DataFrame, col: str, q: int) -> list[float]:
    """``pd.qcut(x, q, retbins=True, duplicates='drop')`` edges from
    exact quantiles (one row of q+1 numbers, bounded by ``q``)."""
    return qcut_edges_many(train, col, [q])[q]

def with_qcut_bin(df: DataFrame, col: str, edges: Sequence[float], out: str) -> DataFrame:
    """``pd.cut(x, edges, include_lowest=True, labels=False)``."""
    arr = F.array(*[F.lit(float(e)) for e in edges])
    return df.withColumn(out, cut_codes_array(F.col(col), arr, include_lowest=True))

def reindex_domain(df: DataFrame, key: str, domain: Sequence[str]) -> DataFrame:
    """Keep a fixed domain order (e.g. Monday…Sunday), missing → null."""
    spark = df.sparkSession
    dom = spark.createDataFrame([(i, v) for i, v in enumerate(domain)], f"ordinal int, {key} string")
    return dom.join(df, key, "left")
