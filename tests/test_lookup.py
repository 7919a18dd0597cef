import numpy as np
import pandas as pd

from faresight.operators import lookup as LK


def test_ecdf_against_reference_brute_force(spark):
    ref = [1.0, 2.0, 2.0, 3.0, 5.0, 5.0, 5.0, 8.0]
    cur = [0.0, 2.0, 4.0, 5.0, 9.0, None]
    r = spark.createDataFrame([(v,) for v in ref], "x double")
    c = spark.createDataFrame([(i, v) for i, v in enumerate(cur)], "i int, x double")
    got = {row["i"]: row["x_pctrank"] for row in LK.ecdf_against(r, c, "x").collect()}
    for i, v in enumerate(cur):
        exp = None if v is None else float(np.mean(np.array(ref) <= v))
        assert got[i] == exp


def test_average_rank_pct_equals_pandas(spark):
    vals = [4.0, 1.0, 4.0, 2.0, 4.0, 3.0, 1.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r["i"]: r["x_pctrank"] for r in LK.average_rank_pct(df, "x").collect()}
    exp = pd.Series(vals).rank(pct=True)
    for i in range(len(vals)):
        if pd.isna(exp[i]):
            assert got[i] is None
        else:
            assert abs(got[i] - exp[i]) < 1e-12


def test_ecdf_differs_from_average_rank_on_ties(spark):
    # (source <= x).mean() counts every tie, rank(pct=True) averages their ranks
    vals = [1.0, 2.0, 3.0, 3.0, 3.0, 3.0, 5.0, 6.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = LK.ecdf_against(df, df.where("x = 3.0").limit(1), "x").first()["x_pctrank"]
    b = LK.average_rank_pct(df, "x").where("x = 3.0").first()["x_pctrank"]
    assert a == float(np.mean(np.array(vals) <= 3.0)) == 0.75
    assert b == float(pd.Series(vals).rank(pct=True)[2]) == 0.5625


def test_group_mean_predictor_unseen_and_null_keys(spark):
    train = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 40.0), (None, 100.0)], "k string, y double")
    test = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    got = {r["k"]: (r["prediction"], r["matched"]) for r in LK.group_mean_predictor(train, test, ["k"], "y").collect()}
    gm = (10 + 20 + 40 + 100) / 4
    assert got["a"] == (15.0, True) and got["c"] == (gm, False) and got[None] == (gm, False)


def test_qcut_edges_drop_duplicates_and_bin_codes(spark):
    vals = [1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    edges = LK.qcut_edges(df, "x", 4)
    exp = sorted(set(np.percentile(vals, [0, 25, 50, 75, 100]).tolist()))
    assert edges == exp
    codes = [r["b"] for r in LK.with_qcut_bin(df, "x", edges, "b").collect()]
    exp_codes = pd.cut(pd.Series(vals), bins=edges, include_lowest=True, labels=False).tolist()
    assert codes == exp_codes


def test_frequency_fit_apply(spark):
    tr = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    lk = LK.fit_frequency(tr, "c")
    assert abs(sum(r["c_freq"] for r in lk.collect()) - 1.0) < 1e-12
    te = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = {r["c"]: r["c_freq"] for r in LK.apply_frequency(te, lk, "c").collect()}
    assert got == {"a": 2 / 3, "z": 0.0, None: 0.0}
