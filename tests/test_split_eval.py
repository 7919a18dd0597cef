import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from faresight.operators import evaluate as EV
from faresight.operators import split as SP


def _frame(spark, n=103):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(days=i % 17) if i % 29 else None, float(i % 7)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, ts timestamp, y double")


def test_temporal_split_invariants(spark):
    df = _frame(spark)
    s = SP.temporal_split(df, "ts", 0.2).cache()
    n = df.count()
    tr, te = s.where("split = 'train'"), s.where("split = 'test'")
    assert tr.count() == int(n * 0.8) and tr.count() + te.count() == n
    assert tr.agg(F.max("ts")).first()[0] <= te.where("ts IS NOT NULL").agg(F.min("ts")).first()[0]
    assert te.where("ts IS NULL").count() == df.where("ts IS NULL").count()  # missing times go last
    assert sorted(r[0] for r in s.select("row_idx").collect()) == list(range(n))


def test_walk_forward_bounds_and_blocks(spark):
    n, k = 103, 5
    b = SP.walk_forward_bounds(n, k)
    m = n // (k + 1)
    assert b[0] == (n - k * m, n - (k - 1) * m) and b[-1][1] == n
    idx = spark.range(n).withColumnRenamed("id", "row_idx")
    blocks = {r["row_idx"]: r["block"] for r in SP.walk_forward_blocks(idx, n, k).collect()}
    for i, (lo, hi) in enumerate(b):
        assert all(blocks[j] == i for j in range(lo, hi))
    assert all(blocks[j] == -1 for j in range(b[0][0]))


def test_hash_folds_disjoint_and_stable(spark):
    df = _frame(spark)
    a = df.withColumn("f", SP.hash_fold(["id"], 5)).collect()
    b = df.repartition(7).withColumn("f", SP.hash_fold(["id"], 5)).collect()
    assert {r["id"]: r["f"] for r in a} == {r["id"]: r["f"] for r in b}
    assert set(r["f"] for r in a) <= set(range(5))


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.uniform(100, 1000, 200)
    p = y + rng.normal(0, 50, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    m = EV.regression_metrics(df, "y", "p").first()
    e = y - p
    assert np.isclose(m["r2"], 1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert np.isclose(m["mae"], np.abs(e).mean()) and np.isclose(m["rmse"], np.sqrt((e ** 2).mean()))
    assert np.isclose(m["mape"], np.mean(np.abs(e) / np.clip(y, 1, None)) * 100)
    assert np.isclose(m["medae"], np.median(np.abs(e)))


def test_r2_constant_target(spark):
    df = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "y double, p double")
    assert EV.regression_metrics(df, "y", "p", median=None).first()["r2"] == 1.0
    df2 = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, p double")
    assert EV.regression_metrics(df2, "y", "p", median=None).first()["r2"] == 0.0


def test_segments_drop_small_and_null_r2(spark):
    rows = [(5000.0 + i, 5000.0) for i in range(11)] + [(30000.0, 1.0)] + [(15000.0 + i, 15000.0) for i in range(3)]
    df = spark.createDataFrame(rows, "y double, p double")
    seg = {r["segment"]: r for r in EV.evaluate_by_segment(df, "y", "p").collect()}
    assert set(seg) == {"<10K", "10-25K"}  # the one-row 25-50K segment is dropped
    assert seg["<10K"]["r2"] is not None and seg["10-25K"]["r2"] is None


def test_champion_missing_metric_loses_and_empty_raises(spark):
    t = spark.createDataFrame([("a", None), ("b", 3.0), ("c", 1.0)], "model string, mae double")
    assert EV.select_champion(t, "mae", higher_is_better=False).first()["model"] == "c"
    assert EV.select_champion(t, "mae", higher_is_better=True).first()["model"] == "b"
    with pytest.raises(ValueError):
        EV.select_champion(t.limit(0), "mae")


def test_blend_grid(spark):
    assert len(EV.weight_grid(3, 0.1)) == 66 and len(EV.weight_grid(2, 0.1)) == 11
    df = spark.createDataFrame([(10.0, 10.0, 0.0), (20.0, 20.0, 0.0)], "y double, a double, b double")
    g = EV.blend_grid_search(df, "y", ["a", "b"])
    best = g.orderBy("mae").first()
    assert best["w_a"] == 1.0 and best["mae"] == 0.0
