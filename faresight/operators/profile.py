"""Profiles and group statistics.

Every operator fuses its statistics into one aggregate per pass (the main
gain over per-column loops), keeps aggregation partial (map-side combine)
and never places a whole group in one task: group medians and quartiles go
through the distributed exact quantiles of ``faresight.operators.prefix``,
top-k per group is two-stage, and group means are attached to rows by a
join on the aggregated table rather than a window over raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from faresight.functions.metrics import r2_from
from faresight.operators.prefix import exact_quantiles

def scalars(one_row: DataFrame) -> dict:
    """Values of a global aggregate (exactly one row) as a dict of Python scalars."""
    return one_row.first().asDict()


def with_literals(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "column",
            value: str = "value", cast: str | None = None) -> DataFrame:
    """Wide → long (``stack``), optionally casting every value to one type."""
    vals = [F.col(c).cast(cast) if cast else F.col(c) for c in cols]
    return df.select(*ids, F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), v.alias(value)) for c, v in zip(cols, vals)])).alias("_kv")
    ).select(*ids, f"_kv.{name}", f"_kv.{value}")


# A1 / A7 / A19 ---------------------------------------------------------------
def _value_counts(df: DataFrame) -> DataFrame:
    """(position, nulls, distinct) of every column, exact. Columns of one type share a pass
    that groups (position, value), so each of the copies of a row is one value wide; distinct
    counts of several columns in one aggregate would copy all columns once per column."""
    by_type: dict[str, dict[str, str]] = {}
    for i, f in enumerate(df.schema.fields):
        by_type.setdefault(f.dataType.simpleString(), {})[str(i)] = f.name
    parts = []
    for cols in by_type.values():
        long = df.select(*[F.col(c).alias(i) for i, c in cols.items()]).unpivot([], list(cols), "position", "v")
        values = long.groupBy(F.col("position").cast("int").alias("position"), "v").agg(F.count(F.lit(1)).alias("n"))
        parts.append(values.groupBy("position").agg(
            F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(F.lit(0))).alias("nulls"),
            F.count("v").alias("distinct")))
    return reduce(DataFrame.union, parts)


def audit(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column: type, null count, distinct non-null count. Exact counts read ``df``
    once per type of column: pass a stored table, not a plan that joins."""
    aggs = []
    for i, c in enumerate(df.columns):
        at = F.col("position") == i
        n = F.sum(F.col(c).isNull().cast("long")) if approx else F.max(F.when(at, F.col("nulls")))
        d = F.approx_count_distinct(c) if approx else F.coalesce(F.max(F.when(at, F.col("distinct"))), F.lit(0))
        aggs += [n.alias(f"n__{c}"), d.cast("long").alias(f"d__{c}")]
    one = (df if approx else _value_counts(df)).agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                 F.col(f"n__{c}").alias("nulls"), F.col(f"d__{c}").alias("distinct"))
        for i, c in enumerate(df.columns)])).alias("r")).select("r.*")


def total_nulls(df: DataFrame) -> DataFrame:
    """Null count over the whole frame."""
    expr = sum((F.sum(F.col(c).isNull().cast("long")) for c in df.columns), F.lit(0))
    return df.agg(expr.cast("long").alias("null_count"))


def cardinality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values per column and the one-hot width (their sum)."""
    one = df.agg(*[F.countDistinct(c).cast("long").alias(c) for c in cols])
    long = unpivot(one, [], cols, "column", "n_unique")
    w = Window.partitionBy()  # over len(cols) rows only
    return long.withColumn("ohe_width", F.sum("n_unique").over(w))


# A2 / A3 / A4 / A5 -------------------------------------------------------------
def group_mean(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(target).alias("mean"), F.count(F.lit(1)).alias("n"))


def group_mean_median(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    stats = df.groupBy(*keys).agg(F.avg(target).alias("mean"), F.count(F.lit(1)).alias("n"))
    med = exact_quantiles(df, target, [0.5], keys).withColumnRenamed("q_0", "median")
    return _join_small(stats, med, keys, "left")


def _join_small(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` (null-safe). ``small`` is an aggregate; AQE
    broadcasts it when its runtime size is under the threshold, else the
    join shuffles. Its keys are renamed first, so frames derived from one
    source never meet as an ambiguous self-join."""
    if not keys:
        return with_literals(big, scalars(small))
    ren = small.select(*[F.col(c).alias(f"_rk_{c}") if c in keys else F.col(c) for c in small.columns])
    cond = [big[k].eqNullSafe(ren[f"_rk_{k}"]) for k in keys]
    return big.join(ren, cond, how).drop(*[f"_rk_{k}" for k in keys])


def mode_of(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent value (ties → smallest), via partial ``min_by``."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_c"))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(col), F.struct(-F.col("_c"), F.col(col))).alias("mode"))


def describe_numeric(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """A4/A5: count, mean, sample std, min, quartiles, max, mode, range, IQR,
    bias-corrected skewness/kurtosis (pandas ``skew``/``kurt``) and CoV."""
    n = F.count(F.col(col))
    g1, g2 = F.skewness(col), F.kurtosis(col)
    nn = n.cast("double")
    base = df.groupBy(*keys).agg(
        n.alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"), F.max(col).alias("max"),
        F.try_divide(g1 * F.sqrt(nn * (nn - 1)), nn - 2).alias("skew"),
        F.try_divide(((nn + 1) * g2 + 6) * (nn - 1), (nn - 2) * (nn - 3)).alias("kurtosis"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], keys).select(
        *keys, F.col("q_0").alias("p25"), F.col("q_1").alias("median"), F.col("q_2").alias("p75"))
    out = _join_small(_join_small(base, q, keys), mode_of(df, col, keys), keys)
    return out.withColumns({"range": F.col("max") - F.col("min"), "iqr": F.col("p75") - F.col("p25"),
                            "cov": F.try_divide(F.col("std"), F.col("mean"))})


def numeric_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """mean/std/min/max/median per numeric column in long form
    (feature, stat, value); an all-null column reports 0.0."""
    long = unpivot(df, [], cols, "feature", "v", cast="double")
    base = long.groupBy("feature").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                                       F.min("v").alias("min"), F.max("v").alias("max"),
                                       F.count("v").alias("_nn"))
    med = exact_quantiles(long, "v", [0.5], ["feature"]).withColumnRenamed("q_0", "median")
    both = _join_small(base, med, ["feature"])
    stats = ["mean", "std", "min", "max", "median"]
    return unpivot(both.select("feature", "_nn", *stats), ["feature", "_nn"], stats, "stat", "value").select(
        "feature", "stat", F.when(F.col("_nn") == 0, F.lit(0.0)).otherwise(F.col("value")).alias("value"))


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A8 (categorical part): count, unique, top (ties → smallest), freq."""
    long = unpivot(df, [], cols, "column", "value", cast="string").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))
    return counts.groupBy("column").agg(
        F.sum("_c").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("_c"), F.col("value"))).alias("top"),
        F.max("_c").alias("freq"))


# A9 ---------------------------------------------------------------------------
def relative_frequency(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value shares per column, nulls out of numerator and denominator:
    (column, value, count, freq)."""
    long = unpivot(df, [], cols, "column", "value", cast="string").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    tot = counts.groupBy("column").agg(F.sum("count").alias("_tot"))
    return _join_small(counts, tot, ["column"]).select(
        "column", "value", "count", F.try_divide(F.col("count"), F.col("_tot")).alias("freq"))


# A10 / T6 ---------------------------------------------------------------------
def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    salt_buckets: int = 64, salt_on: Column | None = None) -> DataFrame:
    """Top ``k`` rows per group in two stages: top k within (group, salt)
    then top k over at most salt_buckets·k survivors per group, so a group
    with millions of candidates is ranked by many tasks."""
    salt = F.abs(F.xxhash64(salt_on if salt_on is not None else F.struct(*df.columns))) % salt_buckets
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    stage1 = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return (stage1.drop("_salt", "_r").withColumn("rank", F.row_number().over(w2))
                  .where(F.col("rank") <= k))


def top_category_counts(df: DataFrame, cols: Sequence[str], k: int = 30) -> DataFrame:
    """A10: the ``k`` most frequent values per column (ties → smallest value)."""
    long = unpivot(df, [], cols, "column", "value", cast="string").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return top_k_per_group(counts, ["column"], [F.desc("count"), F.asc("value")], k,
                           salt_on=F.col("value"))


# A12 / A13 / F16 ----------------------------------------------------------------
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise-complete rows), one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}||{b}") for a, b in pairs])
    rows = []
    for a, b in pairs:
        rows.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"`{a}||{b}`").alias("corr")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"`{a}||{b}`").alias("corr")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def target_correlations(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    one = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    return unpivot(one, [], cols, "feature", "corr")


# A14 ----------------------------------------------------------------------------
def eta_squared(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """R² of the in-sample group mean per categorical column = SSB/SST, from
    one groupBy over (column, value); a missing value is its own group."""
    long = unpivot(df.select(*cols, target), [target], cols, "feature", "value", cast="string")
    g = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("m"),
                                              F.var_pop(target).alias("v"))
    # SST = SSW + SSB from the per-group table; group means are taken from the overall mean, so
    # the between-group sum of squares is one plain aggregate without loss of digits
    centre = scalars(df.agg(F.avg(target).alias("c")))["c"] or 0.0
    d = F.col("m") - F.lit(float(centre))
    parts = g.groupBy("feature").agg(
        (F.sum(F.col("n") * d * d) - F.try_divide(F.sum(F.col("n") * d) * F.sum(F.col("n") * d), F.sum("n"))).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"))
    sst = F.col("ssb") + F.col("ssw")
    return parts.select("feature", F.when(sst == 0, F.lit(0.0)).otherwise(F.col("ssb") / sst).alias("eta2"))


# A15 / P8 -----------------------------------------------------------------------
def group_spread(df: DataFrame, keys: Sequence[str], target: str, min_count: int = 10) -> DataFrame:
    """Per group: mean, sample std, count, min, max, cv, range; groups with
    at least ``min_count`` rows (HAVING)."""
    g = df.groupBy(*keys).agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"),
                              F.count(F.lit(1)).alias("count"), F.min(target).alias("min"),
                              F.max(target).alias("max"))
    return (g.where(F.col("count") >= min_count)
             .withColumns({"cv": F.try_divide(F.col("std"), F.col("mean")), "range": F.col("max") - F.col("min")}))


def group_spread_summary(spread: DataFrame) -> DataFrame:
    """A15 summary: number of groups, mean cv, mean and median range."""
    base = spread.agg(F.count(F.lit(1)).alias("n_groups"), F.avg("cv").alias("mean_cv"),
                      F.avg("range").alias("mean_range"))
    med = exact_quantiles(spread, "range", [0.5]).select(F.col("q_0").alias("median_range"))
    return with_literals(base, scalars(med))


# W1 / A16 -----------------------------------------------------------------------
def attach_group_mean(df: DataFrame, keys: Sequence[str], target: str, out: str = "group_mean") -> DataFrame:
    """``groupby(keys)[t].transform('mean')`` as aggregate + join back. The
    aggregate is partial per partition; a hot key then meets a one-row
    lookup (broadcast if the table is small, AQE skew split otherwise)
    instead of filling one window task."""
    means = df.groupBy(*keys).agg(F.avg(target).alias(out))
    return _join_small(df, means, keys, "left")


def equal_width_bins(df: DataFrame, cols_bins: dict[str, int], suffix: str = "_bin") -> DataFrame:
    """``pd.cut(x, bins=k, labels=False)`` codes for several columns
    (one min/max pass)."""
    from faresight.functions.scalar import equal_width_code
    mm = scalars(df.agg(*[x for c in cols_bins for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]))
    return df.withColumns({f"{c}{suffix}": equal_width_code(c, F.lit(mm[f"lo_{c}"]), F.lit(mm[f"hi_{c}"]), k)
                           for c, k in cols_bins.items()})


def in_sample_ceiling(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """R² and MAE of predicting each row by its own group's mean."""
    withm = attach_group_mean(df.select(*keys, target), keys, target, "_gm")
    e = F.col(target) - F.col("_gm")
    agg = withm.agg(F.sum(e * e).alias("_sse"), (F.var_pop(target) * F.count(F.lit(1))).alias("_sst"),
                    F.avg(F.abs(e)).alias("mae"))
    return agg.select(r2_from(F.col("_sse"), F.col("_sst")).alias("r2"), "mae")


# A17 ----------------------------------------------------------------------------
def noise_floor(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Rows sharing every feature value: number of groups, groups with 2+
    rows, mean within std and range, pooled std √(Σ std²·n / Σ n)."""
    g = df.groupBy(*features).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(target).alias("std"),
                                  F.min(target).alias("mn"), F.max(target).alias("mx"))
    multi = F.col("n") > 1
    return g.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.sum(multi.cast("long")).alias("n_multi"),
        F.avg(F.when(multi, F.col("std"))).alias("within_std"),
        F.avg(F.when(multi, F.col("mx") - F.col("mn"))).alias("within_range"),
        F.sqrt(F.try_divide(F.sum(F.when(multi, F.col("std") * F.col("std") * F.col("n"))),
                            F.sum(F.when(multi, F.col("n"))))).alias("pooled_std"))


# A18 ----------------------------------------------------------------------------
def monthly_trend(df: DataFrame, ts: str, target: str) -> DataFrame:
    m = F.date_format(F.col(ts), "yyyy-MM")
    return df.groupBy(m.alias("month")).agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"),
                                            F.count(F.col(target)).alias("count"))


# A22 ----------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int | None = None, edges: Sequence[float] | None = None,
              density: bool = False) -> DataFrame:
    """Equal-width bins between min and max (``bins``) or fixed ``edges``;
    bins are [lo, hi) except the last, which is closed. Empty bins appear
    with count 0 (the bin domain is generated, not collected)."""
    spark = df.sparkSession
    vals = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    if edges is not None:
        e = [float(x) for x in edges]
        k = len(e) - 1
        arr = F.array(*[F.lit(x) for x in e])
        idx = F.size(F.filter(arr, lambda x: x <= F.col("v"))) - 1
        idx = F.when(F.col("v") == F.lit(e[-1]), F.lit(k - 1)).otherwise(idx)
        counted = (vals.where((F.col("v") >= e[0]) & (F.col("v") <= e[-1])).groupBy(idx.alias("bin"))
                       .agg(F.count(F.lit(1)).alias("count")))
        dom = spark.createDataFrame([(i, e[i], e[i + 1]) for i in range(k)], "bin int, lo double, hi double")
        n_total = scalars(vals.agg(F.count(F.lit(1)).alias("n")))["n"] if density else None
    else:
        mm = scalars(vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")))
        lo, hi, n_total = mm["lo"], mm["hi"], mm["n"]
        if lo is None:
            lo = hi = 0.0
        width = (hi - lo) / bins
        idx = (F.lit(0) if width == 0 else
               F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))).cast("int")
        counted = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
        dom = spark.range(bins).select(F.col("id").cast("int").alias("bin")).select(
            "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"))
    out = dom.join(counted, "bin", "left").select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count"))
    if density:
        out = out.withColumn("density", F.try_divide(F.col("count"), F.lit(n_total) * (F.col("hi") - F.col("lo"))))
    return out


# A23 ----------------------------------------------------------------------------
def boxplot_stats(df: DataFrame, keys: Sequence[str], col: str, whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the furthest points within whis·IQR of the box,
    and the outlier count, per group."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], keys).select(
        *keys, F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
    q = q.withColumns({"_lo": F.col("q1") - whis * (F.col("q3") - F.col("q1")),
                       "_hi": F.col("q3") + whis * (F.col("q3") - F.col("q1"))})
    j = _join_small(df.select(*keys, col), q, keys, "inner")
    inside = (F.col(col) >= F.col("_lo")) & (F.col(col) <= F.col("_hi"))
    stats = j.groupBy(*keys).agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_lo"), F.max(F.when(inside, F.col(col))).alias("whisker_hi"),
        F.sum((~inside).cast("long")).alias("n_outliers"))
    return _join_small(q.drop("_lo", "_hi"), stats, keys, "inner")


# A24 / P9 / P10 / P12 / T9 ----------------------------------------------------------
def ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    one = df.agg(*[x for c in cols for x in (F.min(c).cast("double").alias(f"{c}__min"),
                                              F.max(c).cast("double").alias(f"{c}__max"))])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__min").alias("min"),
                                                   F.col(f"{c}__max").alias("max")) for c in cols])).alias("r")
                      ).select("r.*")


def equality_rate(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Share of rows where a == b (a null comparison counts as unequal)."""
    one = df.agg(*[F.avg(F.coalesce((F.col(a) == F.col(b)), F.lit(False)).cast("double")).alias(f"{a}||{b}")
                   for a, b in pairs])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                                   F.col(f"`{a}||{b}`").alias("match_rate"))
                                          for a, b in pairs])).alias("r")).select("r.*")


def additive_identity(df: DataFrame, a: str, b: str, total: str, tol: float = 0.01) -> DataFrame:
    """P10: does total = a + b? max and mean |diff|, all within ``tol``."""
    d = F.abs(F.col(total) - (F.col(a) + F.col(b)))
    return df.agg(F.max(d).alias("max_diff"), F.avg(d).alias("mean_diff"),
                  F.coalesce(F.bool_and(d < F.lit(tol)), F.lit(True)).alias("exact_match"))


def option_domains(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, long form (column, value),
    so no column's domain is ever gathered into one array or task."""
    long = unpivot(df, [], cols, "column", "value", cast="string").where(F.col("value").isNotNull())
    return long.distinct()


def key_is_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows vs distinct keys."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct(F.struct(*keys)).alias("n_keys")).withColumn(
        "is_unique", F.col("n_rows") == F.col("n_keys"))
