"""Operators use all of their input, whatever its size, order or partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faresight.functions.metrics import finish, metric_parts
from faresight.operators import drift as DR, encode as EN, outliers as OU, split as SP, tracking as TR


def test_tree_samples_cover_the_input_and_ignore_partitioning(spark):
    df = spark.range(60_000).select("id", (F.col("id") % 997).cast("double").alias("v"))
    s = OU.tree_samples(df, ["v"], 20, 64).groupBy("tree").count().collect()
    assert sorted(r["tree"] for r in s) == list(range(20)) and {r["count"] for r in s} == {64}
    with_id = OU.tree_samples(df.withColumn("w", F.col("id").cast("double")), ["w"], 20, 64)
    deciles = [r["n"] for r in with_id.groupBy(F.floor(F.col("w") / 6000).alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()]
    assert len(deciles) == 10 and min(deciles) > 70
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(OU.tree_samples(df.repartition(7), ["v"], 5, 32)) == key(OU.tree_samples(df.coalesce(1), ["v"], 5, 32))


def test_isolation_forest_flags_the_far_rows_and_leaves_nulls(spark):
    rows = [(float(i % 50), i) for i in range(2000)] + [(1e6 + i, 5000 + i) for i in range(5)] + [(None, 9000)]
    out = OU.isolation_forest(spark.createDataFrame(rows, "v double, id long"), ["v"], n_trees=50, contamination=0.004)
    r = {x["id"]: x for x in out.collect()}
    assert len(r) == len(rows) and all(r[5000 + i]["is_outlier"] for i in range(5))
    assert r[9000]["anomaly_score"] is None and r[9000]["is_outlier"] is False


def test_drift_method_does_not_follow_the_row_count(spark):
    for n in (50, 3000):
        a = spark.range(n).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("k"))
        m = {r["feature"]: r["method"] for r in DR.drift_report(a, a, ["x"], ["k"], with_p_values=False).collect()}
        assert m == {"x": "wasserstein", "k": "jensenshannon"}
    with pytest.raises(ValueError):
        DR.drift_report(a, a, ["x"], ["k"], num_method="auto")


def test_chi_square_agrees_with_mllib(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest
    rng = np.random.default_rng(2)
    a = spark.createDataFrame([(f"c{int(v)}",) for v in rng.poisson(3, 800)], "k string")
    b = spark.createDataFrame([(f"c{int(v)}",) for v in rng.poisson(3.3, 500)] + [(None,)] * 4, "k string")
    got = DR.chi_square_homogeneity(a, b, ["k"]).first()
    both = a.withColumn("y", F.lit(0.0)).unionByName(b.withColumn("y", F.lit(1.0))).fillna("nan", ["k"])
    x = StringIndexer(inputCol="k", outputCol="i").fit(both).transform(both)
    want = ChiSquareTest.test(VectorAssembler(inputCols=["i"], outputCol="f").transform(x), "f", "y", flatten=True).first()
    assert got["chi2_dof"] == want["degreesOfFreedom"] and got["chi2_p"] == pytest.approx(want["pValue"], rel=1e-9)
    for x, dof, p in ((3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (124.34211340400408, 100, 0.05), (0.0, 3, 1.0)):
        assert DR.chi_square_sf(x, dof) == pytest.approx(p, rel=1e-9)   # fixed values: 5 % points


def test_chi_square_takes_many_categories(spark):
    a = spark.range(25_000).select(F.col("id").cast("string").alias("k"))
    r = DR.chi_square_homogeneity(a, a, ["k"]).first()
    assert r["chi2_dof"] == 24_999 and r["chi2_p"] == 1.0


def test_target_encoder_keeps_small_variances_of_large_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(f"c{i % 4}", 1e9 + (i % 4) * 1e-2 + float(e)) for i, e in enumerate(rng.normal(0, 0.01, 4000))]
    df = spark.createDataFrame(rows, "c string, y double")
    v = {r["value"]: r["m2"] / r["n"] for r in EN.TargetEncoder(["c"], "y")._stats(df).collect()}
    for k in v:
        ys = np.array([y - 1e9 for c, y in rows if c == k])
        assert v[k] == pytest.approx(ys.var(), rel=1e-3)
    model, oof = EN.TargetEncoder(["c"], "y").fit_transform_oof(df)
    enc = {r["c"]: r["e"] - 1e9 for r in oof.groupBy("c").agg(F.avg("c_te").alias("e")).collect()}
    assert enc["c0"] < enc["c1"] < enc["c2"] < enc["c3"]


def test_out_of_fold_encoding_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, f"c{int(rng.integers(6))}", float(rng.normal(100, 10))) for i in range(400)], "id long, c string, y double")
    enc = EN.TargetEncoder(["c"], "y")
    _, oof = enc.fit_transform_oof(df)
    rows = {r["id"]: r for r in df.withColumn("f", EN.hash_fold(df.columns, enc.folds, enc.seed)).collect()}
    for r in oof.collect():
        rest = [x for x in rows.values() if x["f"] != rows[r["id"]]["f"]]
        ally, y = np.array([x["y"] for x in rest]), np.array([x["y"] for x in rest if x["c"] == r["c"]])
        lam = len(y) * ally.var() / (len(y) * ally.var() + y.var())
        assert r["c_te"] == pytest.approx(lam * y.mean() + (1 - lam) * ally.mean(), rel=1e-9)


def test_metrics_count_pairs_only(spark):
    full = [(1.0, 2.0), (4.0, 3.0), (9.0, 9.5)]
    a = spark.createDataFrame(full, "y double, p double")
    b = spark.createDataFrame([*full, (None, 5.0), (7.0, None)], "y double, p double")
    m = [d.agg(*metric_parts("y", "p")).select(*[c.alias(k) for k, c in finish().items()]).first() for d in (a, b)]
    assert m[0] == m[1] and m[0]["n"] == 3
    c = [{r["metric"]: r["current"] for r in DR.concept_drift(a, d, "y", "p").collect()} for d in (a, b)]
    assert c[0] == c[1]


def test_too_few_rows_for_the_folds(spark):
    with pytest.raises(ValueError):
        SP.walk_forward_bounds(5, 5)


def test_run_ids_are_stable_and_versions_count_on(spark, tmp_path):
    runs = TR.runs_from_metrics(spark.createDataFrame([("a", 0.5), ("b", 0.6)], "model string, r2 double"), "exp")
    assert [r["run_id"] for r in runs.collect()] == [r["run_id"] for r in runs.collect()] and runs.select("run_id").distinct().count() == 2
    base = str(tmp_path)
    TR.log_runs(runs, base)
    TR.log_runs(runs, base)
    assert TR.read_runs(spark, base).count() == 4
    assert [TR.register_version(spark, base, "m", "r") for _ in range(3)] == [1, 2, 3] and TR.register_version(spark, base, "other", "r") == 1
    TR.set_alias(spark, base, "m", "production", 2)
    got = TR.resolve_version(spark.read.parquet(f"{base}/versions"), spark.read.parquet(f"{base}/aliases"), "m").first()
    assert (got["version"], got["source"]) == (2, "alias")
