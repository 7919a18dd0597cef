import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from faresight.operators import encode as EN


def test_ordinal_alphabetical_unknown_minus_one(spark):
    tr = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", None)], "c1 string, c2 string")
    m = EN.OrdinalEncoder(["c1", "c2"]).fit(tr)
    te = spark.createDataFrame([("a", "y"), ("z", None)], "c1 string, c2 string")
    got = [(r["c1_code"], r["c2_code"]) for r in m.transform(te).orderBy("c1").collect()]
    assert got == [(0, 1), (-1, -1)]


def test_target_encoding_auto_smoothing(spark):
    rows = [("a", 10.0), ("a", 12.0), ("b", 30.0), ("b", 50.0), ("b", 40.0), ("c", 7.0)]
    tr = spark.createDataFrame(rows, "k string, y double")
    m = EN.TargetEncoder(["k"], "y").fit(tr)
    y = np.array([r[1] for r in rows])
    gv, gm = y.var(), y.mean()
    got = {r["k"]: r["k_te"] for r in m.transform(spark.createDataFrame([("a",), ("c",), ("q",)], "k string")).collect()}
    ya = np.array([10.0, 12.0])
    lam = 2 * gv / (2 * gv + ya.var())
    assert np.isclose(got["a"], lam * ya.mean() + (1 - lam) * gm)
    assert np.isclose(got["c"], 7.0)  # one row: no within-variance, λ = 1
    assert np.isclose(got["q"], gm)


def test_target_encoding_oof_rows(spark):
    rows = [(i, "a" if i % 2 else "b", float(i)) for i in range(40)]
    tr = spark.createDataFrame(rows, "i int, k string, y double")
    _, oof = EN.TargetEncoder(["k"], "y", folds=4).fit_transform_oof(tr)
    assert oof.count() == 40 and oof.where(F.col("k_te").isNull()).count() == 0


def test_one_hot_unknown_all_zero(spark):
    tr = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    pm = EN.feature_pipeline(["c"], [], encoding="onehot").fit(tr)
    te = spark.createDataFrame([("b",), ("zzz",)], "c string")
    vecs = [r[0] for r in pm.transform(te).select(vector_to_array("oh_c_vec")).collect()]
    assert vecs[0] == [0.0, 1.0] and vecs[1] == [0.0, 0.0]


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, b double")
    out = EN.PopulationScaler(["a", "b"]).fit(df).transform(df).select("a_z", "b_z").collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


def test_frequency_encoder_persist_roundtrip(spark, tmp_path):
    tr = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    m = EN.FrequencyEncoder(["c"]).fit(tr)
    m.save(str(tmp_path / "fe"))
    m2 = EN.FrequencyEncoderModel.load(spark, str(tmp_path / "fe"))
    te = spark.createDataFrame([("a",), ("q",)], "c string")
    assert sorted(r["c_freq"] for r in m2.transform(te).collect()) == [0.0, 2 / 3]


def test_ordered_statistics_never_see_their_own_target(spark):
    import random

    from faresight.operators.encode import OrderedTargetEncoder
    r = random.Random(4)
    rows = [(i, r.choice(["hot"] * 6 + ["b", "c", None]), r.choice("xy"), None if i % 11 == 0 else round(r.uniform(0, 10), 2)) for i in range(900)]
    df = spark.createDataFrame(rows, "i long, c string, d string, y double").repartition(5)
    enc = OrderedTargetEncoder(["c", "d"], "y", ["i"], strength=2.0)
    model, out = enc.fit_transform_ordered(df)
    got = {x["i"]: x for x in out.collect()}
    assert len(got) == 900
    from faresight.operators.split import row_hash
    h = {x["i"]: x["h"] for x in df.select("i", row_hash(["i"], 42, portable=True).alias("h")).collect()}
    known = [y for *_, y in rows if y is not None]
    prior = sum(known) / len(known)
    for col, at in (("c", 1), ("d", 2)):
        total = {}
        for x in sorted(rows, key=lambda x: (h[x[0]], x[0])):
            v = "nan" if x[at] is None else x[at]
            s, n = total.get(v, (0.0, 0))
            assert abs(got[x[0]][f"{col}_ots"] - (s + 2.0 * prior) / (n + 2.0)) < 1e-9
            if x[3] is not None:
                total[v] = (s + x[3], n + 1)
        new = {x["c"]: x["c_ots"] for x in model.transform(spark.createDataFrame([("hot", "x"), (None, "x"), ("unseen", "x")], "c string, d string")).collect()}
        if col == "c":
            for v, name in (("hot", "hot"), (None, "nan")):
                assert abs(new[v] - (total[name][0] + 2.0 * prior) / (total[name][1] + 2.0)) < 1e-9
            assert abs(new["unseen"] - prior) < 1e-9


def test_ordered_statistics_over_many_buckets_move_each_row_once(spark, monkeypatch):
    """Equal to a plain loop however many buckets there are, with rows that repeat a key, lack a key, a
    category or a target; nothing with a row per row and column is written."""
    from decimal import Decimal
    import hashlib
    import random
    from faresight.operators import encode as EN, prefix
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", None]), r.choice(["x", "nan"]), r.choice([None, round(r.uniform(0, 9), 2)])) for i in range(200)] + [(7, "c", "x", 1.0), (None, "a", "x", 5.0)]
    df = spark.createDataFrame(rows, "i int, c string, d string, y double")
    written, real = [], EN.materialize
    for m in (EN, prefix):
        monkeypatch.setattr(m, "materialize", lambda f: written.append(f.count()) or real(f))
    ys = [Decimal(str(y)) for *_, y in rows if y is not None]
    prior = float(sum(ys)) / len(ys)
    h = {i: int(hashlib.md5("|".join(["42"] + ([] if i is None else [str(i)])).encode()).hexdigest()[:15], 16) for i, *_ in rows}
    order = sorted(rows, key=lambda x: (h[x[0]], x[0] if x[0] is not None else -1))
    want: dict = {}
    for col in (1, 2):
        sums: dict = {}
        for x in order:
            s, n = sums.get(x[col] or "nan", (Decimal(0), 0))
            k = (x[0], col)
            want[k] = max(want.get(k, -1e9), (float(s) + 2 * prior) / (n + 2))
            if x[3] is not None:
                sums[x[col] or "nan"] = (s + Decimal(str(x[3])), n + 1)
    for size in (1 << 18, 9):
        monkeypatch.setattr(EN, "BUCKET_ROWS", size)
        written.clear()
        _, out = EN.OrderedTargetEncoder(["c", "d"], "y", ["i"], strength=2.0).fit_transform_ordered(df)
        got = out.collect()
        assert len(got) == 201 and all(abs(g["c_ots"] - want[g["i"], 1]) < 1e-9 and abs(g["d_ots"] - want[g["i"], 2]) < 1e-9 for g in got)
        assert max(written) < len(rows)
