import datetime as dt
import json

import numpy as np
from pyspark.sql import functions as F

from faresight.operators import drift as DR
from faresight.operators import tracking as TR
from faresight.sources.io import decision_from_report


def _num(spark, vals):
    return spark.createDataFrame([(float(v), k) for v, k in vals], "x double, k string")


def test_identical_frames_no_drift(spark):
    rng = np.random.default_rng(0)
    rows = [(float(v), "abc"[i % 3]) for i, v in enumerate(rng.normal(size=300))]
    df = spark.createDataFrame(rows, "x double, k string")
    nd = DR.numeric_drift(df, df, ["x"]).first()
    assert nd["ks_d"] == 0.0 and nd["ks_p"] == 1.0 and nd["wasserstein"] == 0.0
    cd = DR.categorical_drift(df, df, ["k"]).first()
    assert abs(cd["psi"]) < 1e-12 and abs(cd["jensen_shannon"]) < 1e-12 and cd["chi2"] == 0.0


def test_ks_and_wasserstein_brute_force(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(0, 1, 400).round(2)
    b = rng.normal(0.5, 1, 300).round(2)
    ref = spark.createDataFrame([(float(v),) for v in a], "x double")
    cur = spark.createDataFrame([(float(v),) for v in b], "x double")
    r = DR.numeric_drift(ref, cur, ["x"]).first()
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert np.isclose(r["ks_d"], np.max(np.abs(fa - fb)))
    w1 = np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)) / a.std()
    assert np.isclose(r["wasserstein"], w1)
    assert r["ks_p"] < 0.05


def test_new_and_missing_categories(spark):
    ref = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "k string, x double")
    cur = spark.createDataFrame([("a", 1.0), ("c", 1.0), ("c", 2.0)], "k string, x double")
    sides, cats = DR.data_quality(ref, cur, ["k", "x"], ["k"])
    c = cats.first()
    assert (c["n_new"], c["n_missing"]) == (1, 1)
    dup = {r["side"]: r["duplicate_rows"] for r in sides.collect()}
    assert dup == {0: 0, 1: 0}


def test_dataset_drift_and_decision(spark):
    rep = spark.createDataFrame([("a", True), ("b", False), ("c", False)], "feature string, drift_detected boolean")
    s = DR.dataset_drift(rep).first()
    assert s["n_features"] == 3 and s["n_drifted"] == 1 and s["dataset_drift"]  # 1/3 ≥ 0.3
    d = DR.retrain_decision(DR.dataset_drift(rep), share_threshold=0.3).first()
    assert d["needs_retraining"] is True and d["drift_share"] == 1 / 3  # 33% ≥ 30%


def test_report_reader_layouts_missing_and_malformed(spark, tmp_path):
    lay1 = {"metric_results": [{"type": "DriftedColumnsCount", "value": {"count": 1}},
                               {"type": "ValueDrift", "column": "a", "value": {"drift_detected": True}},
                               {"type": "ValueDrift", "column": "b", "value": {"drift_detected": False}}]}
    lay2 = {"metrics": [{"metric": "DriftedColumnsCount", "result": {"number_of_drifted_columns": 0}},
                        {"metric": "ValueDrift", "column_name": "a", "result": {"drift_detected": False}}]}
    p1, p2, p3 = tmp_path / "r1.json", tmp_path / "r2.json", tmp_path / "bad.json"
    p1.write_text(json.dumps(lay1))
    p2.write_text(json.dumps(lay2))
    p3.write_text("{not json")
    r1 = decision_from_report(spark, str(p1)).first()
    assert r1["needs_retraining"] and r1["drift_share"] == 0.5 and r1["n_drifted_features"] == 1
    r2 = decision_from_report(spark, str(p2)).first()
    assert not r2["needs_retraining"] and r2["drift_share"] == 0.0
    r3 = decision_from_report(spark, str(p3)).first()
    assert r3["needs_retraining"] and "parse" in r3["triggers"][0]
    r4 = decision_from_report(spark, str(tmp_path / "nope.json")).first()
    assert r4["needs_retraining"] and "No drift report" in r4["triggers"][0]


def test_concept_drift_and_degradation(spark):
    ref = spark.createDataFrame([(1.0, 1.0), (2.0, 2.1), (3.0, 2.9)], "y double, p double")
    cur = spark.createDataFrame([(1.0, 3.0), (2.0, 1.0), (3.0, 1.0)], "y double, p double")
    perf = DR.performance_summary(DR.concept_drift(ref, cur, "y", "p")).first()
    assert perf["degraded"] is True and perf["ref_r2"] > 0.9


def test_registry_numeric_versions_and_alias(spark):
    t = dt.datetime(2024, 1, 1)
    versions = spark.createDataFrame([("m", 9, "r9", t), ("m", 10, "r10", t)], "name string, version int, run_id string, ts timestamp")
    assert TR.resolve_version(versions, None, "m").first()["version"] == 10  # 10 > 9 numerically
    aliases = spark.createDataFrame([("m", "production", 9, t), ("m", "production", 10, t + dt.timedelta(1)),
                                     ("m", "production", 9, t + dt.timedelta(2))], "name string, alias string, version int, ts timestamp")
    r = TR.resolve_version(versions, aliases, "m").first()
    assert (r["version"], r["source"]) == (9, "alias")


def test_best_run_missing_metric_loses(spark):
    res = spark.createDataFrame([("a", 0.5, 10.0), ("b", None, 5.0), ("c", 0.7, None)], "model string, r2 double, mae double")
    runs = TR.runs_from_metrics(res, "exp")
    assert TR.best_run(runs, "MAE", ascending=True).first()["model"] == "b"
    assert TR.best_run(runs, "R2").first()["model"] == "c"
    assert runs.where(F.col("metrics")["MAE"].isNull()).count() == 1


def test_versions_are_unique_under_concurrent_writers(spark, tmp_path):
    import threading

    from faresight.operators import tracking as TR
    base, got, errors = str(tmp_path / "registry"), [], []

    def write(who):
        try:
            for i in range(12):
                got.append(TR.register_version(spark, base, "model", f"{who}-{i}"))
        except Exception as e:      # shown by the assertion below
            errors.append(e)
    threads = [threading.Thread(target=write, args=(w,)) for w in "abc"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = spark.read.parquet(f"{base}/versions").collect()
    assert not errors and sorted(got) == list(range(1, 37)) == sorted(r["version"] for r in rows)
    assert {r["run_id"] for r in rows} == {f"{w}-{i}" for w in "abc" for i in range(12)}
    assert TR.register_version(spark, base, "other model/é", "x") == 1 and TR.register_version(spark, base, "model", "y") == 37


def test_exact_ks_equals_enumeration():
    import itertools

    from faresight.operators.drift import exact_ks_p
    for n, m in ((1, 1), (1, 4), (3, 3), (4, 6), (5, 3), (7, 4), (8, 8)):
        ds = []
        for at in itertools.combinations(range(n + m), n):
            mine = set(at)
            x = y = 0
            d = 0.0
            for i in range(n + m):
                x, y = (x + 1, y) if i in mine else (x, y + 1)
                d = max(d, abs(x / n - y / m))
            ds.append(d)
        for d in sorted({round(v, 12) for v in ds}):
            want = sum(v >= d - 1e-9 for v in ds) / len(ds)
            assert abs(exact_ks_p(d, n, m) - want) < 1e-12, (n, m, d)


def test_stored_reference_gives_the_same_report(spark, tmp_path):
    import random

    from faresight.operators import drift as DR
    from faresight.streaming.monitor import drift_stream
    r = random.Random(2)

    def rows(n, shift):
        return [(r.gauss(shift, 1), float(r.randint(0, 3)), None if r.random() < 0.1 else r.choice("abc" if shift else "ab")) for _ in range(n)]
    schema = "x double, y double, k string"
    ref, cur = (spark.createDataFrame(rows(n, s), schema).repartition(3) for n, s in ((700, 0), (300, 0.5)))
    DR.save_reference(ref, ["x", "y"], ["k"], str(tmp_path / "state"))
    key = lambda d: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in x) for x in d.collect())
    want = key(DR.drift_report(ref, cur, ["x", "y"], ["k"], with_p_values=False))
    assert key(DR.drift_against(spark, str(tmp_path / "state"), cur)) == want and any(x[4] for x in want)
    exact = {x["feature"]: x["ks_p"] for x in DR.numeric_drift(ref.limit(30), cur.limit(20), ["x", "y"], exact_up_to=10_000).collect()}
    plain = {x["feature"]: (x["ks_d"], x["ks_p"]) for x in DR.numeric_drift(ref.limit(30), cur.limit(20), ["x", "y"]).collect()}
    assert abs(exact["x"] - DR.exact_ks_p(plain["x"][0], 30, 20)) < 1e-12 and 0 <= exact["x"] <= 1 and exact["x"] != plain["x"][1]
    src = str(tmp_path / "in")
    cur.coalesce(1).write.parquet(src)
    q = drift_stream(spark.readStream.schema(schema).parquet(src), str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert key(got.drop("batch")) == want and got.select("batch").distinct().count() == 1
