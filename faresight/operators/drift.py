"""Data drift, data quality and concept drift between a reference and a
current frame (M1–M6, J8).

Both sides are tagged and unioned once; every per-feature statistic comes
from aggregated (feature, value, side) counts, never from row pairs:

* numeric: two-sample Kolmogorov–Smirnov D from prefix-summed ECDFs of the
  distinct values (p from the Kolmogorov limit series), Wasserstein-1
  distance ∫|F_ref − F_cur| divided by the reference std;
* categorical: PSI and Jensen–Shannon distance on value shares, chi-square
  homogeneity test on the same counts for a p-value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faresight.functions.metrics import r2_from
from faresight.operators.prefix import prefix_sums, with_row_index
from faresight.operators.profile import unpivot
from faresight.session import materialize
from faresight.sources.tables import bounded_broadcast

# Default detection thresholds.
P_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
PSI_THRESHOLD = 0.2
DATASET_DRIFT_SHARE = 0.3
PSI_FLOOR = 1e-4
KS_TERMS = 10


def tag_sides(reference: DataFrame, current: DataFrame, cols: Sequence[str], side: str = "side") -> DataFrame:
    """Both frames in one, with side 0 = reference, 1 = current."""
    return (reference.select(*cols).withColumn(side, F.lit(0))
            .unionByName(current.select(*cols).withColumn(side, F.lit(1))))


def kolmogorov_sf(lam: Column, terms: int = KS_TERMS) -> Column:
    """Q(λ) = P(K > λ) of the Kolmogorov distribution. Below λ = 1.18 the
    theta form 1 − √(2π)/λ Σ exp(−(2j−1)²π²/(8λ²)) converges fast, above it
    the alternating series 2 Σ (−1)^{j−1} exp(−2j²λ²); ten terms each reach
    double precision."""
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * sum(
        (F.exp(F.lit(-((2 * j - 1) ** 2) * math.pi ** 2 / 8.0) / (lam * lam)) for j in range(1, terms + 1)), F.lit(0.0))
    large = sum((F.lit(2.0 * (-1) ** (j - 1)) * F.exp(F.lit(-2.0 * j * j) * lam * lam) for j in range(1, terms + 1)),
                F.lit(0.0))
    q = F.when(lam < F.lit(1.18), small).otherwise(large)
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0)))


def sql_kolmogorov_sf(lam: str, terms: int = 10) -> str:
    """The same Q(λ) as a DuckDB expression (oracle form)."""
    small = " + ".join(f"exp({-((2 * j - 1) ** 2) * math.pi ** 2 / 8.0!r} / ({lam} * {lam}))" for j in range(1, terms + 1))
    large = " + ".join(f"{2.0 * (-1) ** (j - 1)!r} * exp({-2.0 * j * j!r} * {lam} * {lam})" for j in range(1, terms + 1))
    return (f"CASE WHEN {lam} <= 0 THEN 1.0 ELSE least(greatest(CASE WHEN {lam} < 1.18 THEN "
            f"1.0 - {math.sqrt(2 * math.pi)!r} / {lam} * (0.0 + {small}) ELSE 0.0 + {large} END, 0.0), 1.0) END")


def value_counts(df: DataFrame, cols: Sequence[str], cast: str, n: str) -> DataFrame:
    """(feature, v, n): how often each non-null value of each column occurs."""
    long = unpivot(df, [], cols, "feature", "v", cast=cast).where(F.col("v").isNotNull())
    return long.groupBy("feature", "v").agg(F.count(F.lit(1)).alias(n))


def _paired_counts(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, v, r, c) from the value counts of both sides."""
    zero = F.lit(0).cast("long")
    both = reference.select("feature", "v", "r", zero.alias("c")).unionByName(current.select("feature", "v", zero.alias("r"), "c"))
    return both.groupBy("feature", "v").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


def _numeric_ecdf(counts: DataFrame) -> DataFrame:
    cum = prefix_sums(counts, ["v"], ["r", "c"], ["feature"])
    tot = counts.groupBy("feature").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    tot = bounded_broadcast(tot.select(F.col("feature").alias("_f"), "nr", "nc"))  # one row per feature
    return cum.join(tot, cum["feature"] == tot["_f"]).drop("_f").withColumns({
        "fr": F.try_divide(F.col("cum_r"), F.col("nr")), "fc": F.try_divide(F.col("cum_c"), F.col("nc"))})


def exact_ks_p(d: float, n: int, m: int) -> float:
    """P(D >= d) of the two-sample Kolmogorov–Smirnov statistic for samples of n and m values
    without ties: the share of lattice paths from (0, 0) to (n, m) that leave the band
    |x / n - y / m| < d. Work n x m, memory m."""
    import numpy as np
    if n == 0 or m == 0:
        return 1.0
    step = round(d * n * m)               # |x m - y n| is an integer
    y = np.arange(m + 1)
    inside = np.zeros(m + 1)              # share of the paths to (x, y) that stayed inside
    for x in range(n + 1):
        allowed = np.abs(x * m - y * n) < step
        if x == 0:
            inside = np.cumprod(allowed).astype(float)
            continue
        # to (x, y) a path comes from (x - 1, y) with share x / (x + y), from (x, y - 1) with y / (x + y)
        left = inside * x / (x + y)
        run, now = 0.0, np.empty(m + 1)
        for j in range(m + 1):
            run = (left[j] + (run * j / (x + j) if j else 0.0)) if allowed[j] else 0.0
            now[j] = run
        inside = now
    return float(min(1.0, max(0.0, 1.0 - inside[m])))


def _numeric_from_counts(counts: DataFrame, spread: DataFrame, exact_up_to: int = 0) -> DataFrame:
    counts = materialize(counts)
    ecdf = _numeric_ecdf(counts)
    ks = ecdf.groupBy("feature").agg(F.max(F.abs(F.col("fr") - F.col("fc"))).alias("ks_d"),
                                     F.first("nr").alias("n_ref"), F.first("nc").alias("n_cur"))
    ne = F.try_divide(F.col("n_ref") * F.col("n_cur"), F.col("n_ref") + F.col("n_cur"))
    ks = ks.withColumn("ks_p", kolmogorov_sf(F.sqrt(ne) * F.col("ks_d")))
    if exact_up_to:
        def exact(batches):
            for pdf in batches:          # one row per feature
                for i, (d, n, m) in enumerate(zip(pdf["ks_d"], pdf["n_ref"], pdf["n_cur"])):
                    if d == d and n * m <= exact_up_to:
                        pdf.loc[pdf.index[i], "ks_p"] = exact_ks_p(float(d), int(n), int(m))
                yield pdf
        ks = ks.mapInPandas(exact, ks.schema)
    # W1 = Σ |F_ref(v_i) − F_cur(v_i)| (v_{i+1} − v_i): pair each value with the next by a dense index
    idx = with_row_index(ecdf.select("feature", "v", "fr", "fc"), [F.col("feature"), F.col("v")], "_i")
    nxt = idx.select((F.col("_i") - 1).alias("_i"), F.col("feature").alias("_nf"), F.col("v").alias("_nv"))
    steps = idx.join(nxt, "_i").where(F.col("feature") == F.col("_nf"))
    w = steps.groupBy("feature").agg(F.sum(F.abs(F.col("fr") - F.col("fc")) * (F.col("_nv") - F.col("v"))).alias("w1"))
    out = ks.join(w, "feature", "left").join(spread, "feature", "left")
    return out.select("feature", "n_ref", "n_cur", "ks_d", "ks_p",
                      F.when(F.col("ref_std") > 0, F.coalesce(F.col("w1"), F.lit(0.0)) / F.col("ref_std"))
                      .otherwise(F.coalesce(F.col("w1"), F.lit(0.0))).alias("wasserstein"))


def _spread(reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    return unpivot(reference.select(*cols), [], cols, "feature", "v", cast="double").groupBy("feature").agg(F.stddev_pop("v").alias("ref_std"))


def numeric_drift(reference: DataFrame, current: DataFrame, cols: Sequence[str], exact_up_to: int = 0) -> DataFrame:
    """Per numeric feature: n_ref, n_cur, ks_d, ks_p, wasserstein (÷ ref std). ``ks_p`` is that
    of the limit distribution; with ``exact_up_to``, features with n_ref x n_cur up to it get the
    exact small-sample value (``exact_ks_p``)."""
    counts = _paired_counts(value_counts(reference, cols, "double", "r"), value_counts(current, cols, "double", "c"))
    return _numeric_from_counts(counts, _spread(reference, cols), exact_up_to)


def categorical_drift(reference: DataFrame, current: DataFrame, cols: Sequence[str], floor: float = PSI_FLOOR
                      ) -> DataFrame:
    """Per categorical feature: PSI, Jensen–Shannon distance (natural log) and
    the chi-square goodness-of-fit statistic of current counts against
    reference shares (over categories seen in the reference)."""
    counts = _paired_counts(value_counts(reference, cols, "string", "r"), value_counts(current, cols, "string", "c"))
    return _categorical_from_counts(counts, floor)


def _categorical_from_counts(counts: DataFrame, floor: float = PSI_FLOOR) -> DataFrame:
    tot = counts.groupBy("feature").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    tot = bounded_broadcast(tot.select(F.col("feature").alias("_f"), "nr", "nc"))  # one row per feature
    sh = counts.join(tot, counts["feature"] == tot["_f"]).drop("_f").withColumns({
        "p": F.coalesce(F.try_divide(F.col("r"), F.col("nr")), F.lit(0.0)),
        "q": F.coalesce(F.try_divide(F.col("c"), F.col("nc")), F.lit(0.0))})
    pf, qf = F.greatest(F.col("p"), F.lit(floor)), F.greatest(F.col("q"), F.lit(floor))
    m = (F.col("p") + F.col("q")) / 2

    def kl(a: Column) -> Column:
        return F.when(a > 0, a * F.log(a / m)).otherwise(F.lit(0.0))
    exp_c = F.col("p") * F.col("nc")
    return sh.groupBy("feature").agg(
        F.first("nr").alias("n_ref"), F.first("nc").alias("n_cur"),
        F.sum((qf - pf) * F.log(qf / pf)).alias("psi"),
        F.sqrt(F.greatest(F.sum(kl(F.col("p")) + kl(F.col("q"))) / 2, F.lit(0.0))).alias("jensen_shannon"),
        F.sum(F.when(F.col("p") > 0, (F.col("c") - exp_c) * (F.col("c") - exp_c) / exp_c)).alias("chi2"),
        F.sum((F.col("r") > 0).cast("long")).alias("n_categories_ref"),
        F.sum(((F.col("c") > 0) & (F.col("r") == 0)).cast("long")).alias("n_new_categories"))


# A stored reference ------------------------------------------------------------------------
def save_reference(reference: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], path: str) -> None:
    """Write the drift state of a reference: how often each value of each feature occurs, and
    each numeric feature's spread. Its size depends on the numbers of distinct values."""
    value_counts(reference, num_cols, "double", "r").write.mode("overwrite").parquet(f"{path}/numeric")
    value_counts(reference, cat_cols, "string", "r").write.mode("overwrite").parquet(f"{path}/categorical")
    _spread(reference, num_cols).write.mode("overwrite").parquet(f"{path}/spread")


def drift_against(spark, path: str, current: DataFrame) -> DataFrame:
    """Per-feature report (feature, kind, method, score, drift_detected, n_ref, n_cur) of a
    current frame against a written state, without the reference's rows: the same numbers as
    ``drift_report`` with both frames and the default methods."""
    num, cat, spread = (spark.read.parquet(f"{path}/{k}") for k in ("numeric", "categorical", "spread"))
    n_cols = sorted(r["feature"] for r in spread.select("feature").collect())               # one row per feature
    c_cols = sorted(r["feature"] for r in cat.select("feature").distinct().collect())
    nd = _numeric_from_counts(_paired_counts(num, value_counts(current, n_cols, "double", "c")), spread)
    cd = _categorical_from_counts(_paired_counts(cat, value_counts(current, c_cols, "string", "c")))
    return nd.select("feature", F.lit("numeric").alias("kind"), F.lit("wasserstein").alias("method"), F.col("wasserstein").alias("score"),
                     (F.col("wasserstein") >= DISTANCE_THRESHOLD).alias("drift_detected"), "n_ref", "n_cur").unionByName(
        cd.select("feature", F.lit("categorical").alias("kind"), F.lit("jensenshannon").alias("method"), F.col("jensen_shannon").alias("score"),
                  (F.col("jensen_shannon") >= DISTANCE_THRESHOLD).alias("drift_detected"), "n_ref", "n_cur"))


def chi_square_sf(x: float, dof: int) -> float:
    """P(χ²_dof > x): the regularised upper incomplete gamma Q(dof/2, x/2), by its series
    below a + 1 and its continued fraction above."""
    a, z = dof / 2.0, x / 2.0
    if dof <= 0 or z <= 0:
        return 1.0
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = z + 1 - a
    c, d = 1 / tiny, 1 / b
    h, i = d, 1
    while True:
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or tiny)
        c = (b + an / c) or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15 or i > 100_000:
            return min(1.0, front * h)
        i += 1


def chi_square_homogeneity(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Chi-square test of homogeneity (side × category contingency, a null is the
    category "nan"): (feature, chi2_p, chi2_dof). The statistic is one aggregate over
    (feature, category, count by side), for any number of categories; the p-value is
    computed on the one row per feature."""
    import pandas as pd
    both = tag_sides(reference, current, cols)
    long = unpivot(both, ["side"], cols, "feature", "value", cast="string")
    counts = long.groupBy("feature", F.coalesce("value", F.lit("nan")).alias("value")).agg(
        F.sum((F.col("side") == 0).cast("long")).alias("r"), F.sum((F.col("side") == 1).cast("long")).alias("c"))
    tot = counts.groupBy("feature").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    x = counts.join(bounded_broadcast(tot), "feature")  # one row per feature
    n = F.col("nr") + F.col("nc")
    er, ec = F.col("nr") * (F.col("r") + F.col("c")) / n, F.col("nc") * (F.col("r") + F.col("c")) / n
    d = F.col("r") - er
    stat = x.groupBy("feature").agg(F.sum(F.try_divide(d * d, er) + F.try_divide(d * d, ec)).alias("chi2"),
                                    (F.count(F.lit(1)) - 1).alias("chi2_dof"))

    def p_values(batches):
        for pdf in batches:
            p = [None if pd.isna(s) else chi_square_sf(float(s), int(k)) for s, k in zip(pdf["chi2"], pdf["chi2_dof"])]
            yield pd.DataFrame({"feature": pdf["feature"], "chi2_p": pd.array(p, dtype="Float64"), "chi2_dof": pdf["chi2_dof"].astype("int64")})
    return stat.mapInPandas(p_values, "feature string, chi2_p double, chi2_dof long")


def drift_report(reference: DataFrame, current: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                 num_method: str = "wasserstein", cat_method: str = "jensenshannon", with_p_values: bool = True) -> DataFrame:
    """M1: one row per feature — kind, method, score, threshold, drift_detected.

    The method is the caller's and never depends on the number of rows:
    ``wasserstein`` (≥ 0.1) or ``ks`` (p < 0.05) for numeric columns,
    ``jensenshannon`` (≥ 0.1), ``psi`` (≥ 0.2) or ``chisquare`` (p < 0.05,
    needs ``with_p_values``) for categorical ones.
    """
    if num_method not in ("wasserstein", "ks") or cat_method not in ("jensenshannon", "psi", "chisquare"):
        raise ValueError(f"unknown drift method {num_method!r} / {cat_method!r}")
    parts = []
    if num_cols:
        nd = numeric_drift(reference, current, num_cols)
        nd = nd.withColumn("method", F.lit(num_method))
        score = F.when(F.col("method") == "ks", F.col("ks_p")).otherwise(F.col("wasserstein"))
        det = F.when(F.col("method") == "ks", F.col("ks_p") < P_THRESHOLD).otherwise(
            F.col("wasserstein") >= DISTANCE_THRESHOLD)
        parts.append(nd.select("feature", F.lit("numeric").alias("kind"), "method", score.alias("score"),
                               det.alias("drift_detected"), "n_ref", "n_cur"))
    if cat_cols:
        cd = categorical_drift(reference, current, cat_cols)
        if with_p_values:
            cd = cd.join(chi_square_homogeneity(reference, current, cat_cols), "feature", "left")
        else:
            cd = cd.withColumn("chi2_p", F.lit(None).cast("double"))
        cd = cd.withColumn("method", F.lit(cat_method))
        score = (F.when(F.col("method") == "chisquare", F.col("chi2_p"))
                  .when(F.col("method") == "psi", F.col("psi")).otherwise(F.col("jensen_shannon")))
        det = (F.when(F.col("method") == "chisquare", F.col("chi2_p") < P_THRESHOLD)
                .when(F.col("method") == "psi", F.col("psi") >= PSI_THRESHOLD)
                .otherwise(F.col("jensen_shannon") >= DISTANCE_THRESHOLD))
        parts.append(cd.select("feature", F.lit("categorical").alias("kind"), "method", score.alias("score"),
                               F.coalesce(det, F.lit(False)).alias("drift_detected"), "n_ref", "n_cur"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dataset_drift(report: DataFrame, share_threshold: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """M2: n_features, n_drifted, drift_share, dataset_drift (share ≥ threshold),
    drifted_features (sorted)."""
    return report.agg(
        F.count(F.lit(1)).alias("n_features"), F.sum(F.col("drift_detected").cast("long")).alias("n_drifted"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))).alias("drifted_features"),
    ).withColumn("drift_share", F.coalesce(F.try_divide(F.col("n_drifted"), F.col("n_features")), F.lit(0.0))
                 ).withColumn("dataset_drift", F.col("drift_share") >= share_threshold)


def data_quality(reference: DataFrame, current: DataFrame, cols: Sequence[str], cat_cols: Sequence[str],
                 determining: Sequence[str] | None = None) -> DataFrame:
    """M3: per side the rows, null cells and duplicate rows; per categorical
    the categories new in current and missing from current (anti-joins of
    the distinct values, both ways). ``determining``: columns of which all others are
    functions; rows that agree in them agree in all, so only they are compared."""
    both = tag_sides(reference, current, cols)
    nulls = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0))
    per_side = both.groupBy("side").agg(F.count(F.lit(1)).alias("rows"), F.sum(nulls).alias("null_cells"))
    dups = both.groupBy("side", *(determining or cols)).count().where(F.col("count") > 1).groupBy("side").agg(
        F.sum(F.col("count") - 1).alias("duplicate_rows"))
    sides = per_side.join(dups, "side", "left").withColumn("duplicate_rows", F.coalesce("duplicate_rows", F.lit(0)))
    long = unpivot(both, ["side"], list(cat_cols), "feature", "value", cast="string").where(F.col("value").isNotNull())
    dist = long.distinct()
    ref, cur = dist.where(F.col("side") == 0).drop("side"), dist.where(F.col("side") == 1).drop("side")
    new = cur.join(ref, ["feature", "value"], "left_anti").groupBy("feature").agg(F.count(F.lit(1)).alias("n_new"))
    gone = ref.join(cur, ["feature", "value"], "left_anti").groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_missing"))
    feats = dist.select("feature").distinct()
    cats = feats.join(new, "feature", "left").join(gone, "feature", "left").fillna(0, ["n_new", "n_missing"])
    return sides, cats


def concept_drift(reference: DataFrame, current: DataFrame, y: str, p: str) -> DataFrame:
    """M4: R², MAE, RMSE, MAPE (÷ max(y,1)) and mean error per side, long
    form (metric, reference, current)."""
    both = tag_sides(reference, current, [y, p])
    e = F.col(y) - F.col(p)
    m = both.groupBy("side").agg(
        F.sum(e * e).alias("_sse"), (F.var_pop(F.when(F.col(p).isNotNull(), F.col(y))) * F.count(e)).alias("_sst"),
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(e) / F.greatest(F.col(y), F.lit(1.0))) * 100).alias("mape"), F.avg(-e).alias("mean_error"))
    m = m.withColumn("r2", r2_from(F.col("_sse"), F.col("_sst")))
    metrics = ["r2", "mae", "rmse", "mape", "mean_error"]
    long = unpivot(m, ["side"], metrics, "metric", "value")
    return long.groupBy("metric").agg(F.max(F.when(F.col("side") == 0, F.col("value"))).alias("reference"),
                                      F.max(F.when(F.col("side") == 1, F.col("value"))).alias("current"))


def performance_summary(concept: DataFrame, factor: float = 0.9) -> DataFrame:
    """M5: degraded = current R² < factor · reference R² (false when either is missing)."""
    r2 = concept.where(F.col("metric") == "r2")
    return r2.select(F.col("reference").alias("ref_r2"), F.col("current").alias("cur_r2"),
                     F.coalesce(F.col("current") < F.lit(factor) * F.col("reference"), F.lit(False)).alias("degraded"))


def retrain_decision(summary: DataFrame, share_threshold: float = DATASET_DRIFT_SHARE,
                     performance: DataFrame | None = None) -> DataFrame:
    """M6 over a dataset-drift row: needs_retraining, drift_detected,
    drift_share, n_drifted_features, triggers (array<string>). An optional
    M5 row adds a degradation trigger."""
    pct = F.format_number(F.col("drift_share") * 100, 1)
    trig = F.when(F.col("drift_share") >= share_threshold, F.array(F.concat(
        F.lit("Data drift detected: "), F.col("n_drifted").cast("string"), F.lit("/"),
        F.col("n_features").cast("string"), F.lit(" features ("), pct,
        F.lit(f"%) exceeded {share_threshold:.0%} threshold")))).otherwise(F.array().cast("array<string>"))
    out = summary.select(F.col("drift_share"), F.col("n_drifted").alias("n_drifted_features"),
                         (F.col("drift_share") >= share_threshold).alias("drift_detected"), trig.alias("triggers"))
    if performance is not None:
        perf = performance.select("degraded", "ref_r2", "cur_r2")
        out = _attach_one_row(out, perf)
        out = out.withColumn("triggers", F.when(F.col("degraded"), F.concat(F.col("triggers"), F.array(F.concat(
            F.lit("Performance degraded: R² "), F.format_number("cur_r2", 4), F.lit(" < 0.9 × "),
            F.format_number("ref_r2", 4))))).otherwise(F.col("triggers"))).drop("degraded", "ref_r2", "cur_r2")
    return out.withColumn("needs_retraining", F.size("triggers") > 0).select(
        "needs_retraining", "drift_detected", "drift_share", "n_drifted_features", "triggers")


def _attach_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    row = one.first()
    vals = row.asDict() if row is not None else {c: None for c in one.columns}
    return df.withColumns({k: F.lit(v) for k, v in vals.items()})

