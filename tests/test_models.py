import numpy as np
from pyspark.sql import functions as F

from faresight.operators import models as MD
from faresight.operators.outliers import isolation_forest


def test_ridge_regparam_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 3))
    y = X @ np.array([2.0, -1.0, 0.5]) + 3 + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(X, y)],
                               "a double, b double, c double, y double")
    from pyspark.ml.feature import VectorAssembler
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    alpha = 10.0
    reg = MD.make_regressor("Ridge", {"alpha": alpha, "elasticNetParam": 0.0, "solver": "normal"}, "y",
                            n_rows=300, label_std=float(y.std()))
    m = reg.fit(v)
    Xs = (X - X.mean(0)) / X.std(0)
    w = np.linalg.solve(Xs.T @ Xs + alpha * np.eye(3), Xs.T @ (y - y.mean()))
    assert np.allclose(m.coefficients.toArray() * X.std(0), w, atol=1e-6)


def test_planted_signal_learned(spark, sf_dir):
    # a planted fare signal on the flight view: fare = 1000·duration + class premium
    from faresight.plans.common import split_flights
    s = split_flights(spark, sf_dir)
    prem = F.when(F.col("travel_class") == "First Class", 20000.0).when(F.col("travel_class") == "Business", 8000.0) \
        .otherwise(0.0)
    s = s.withColumn("total_fare", F.col("duration_hrs") * 1000.0 + prem)
    tr, te = s.where("split = 'train'"), s.where("split = 'test'")
    table, models = MD.train_all(tr, te, ("DecisionTree", "Linear"))
    r2 = {r["model"]: r["r2"] for r in table.collect()}
    assert r2["Linear"] > 0.99 and r2["DecisionTree"] > 0.95
    imp = dict(MD.importances(models["DecisionTree"]))
    assert max(imp, key=imp.get) in ("travel_class_code", "duration_hrs", "log_duration", "duration_sq",
                                      "haul_type_code", "airline_class_code")


def test_isolation_forest_flags_planted_outlier(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(500, 2)))] + [(999, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    out = isolation_forest(df, ["a", "b"], n_trees=50, contamination=0.01)
    top = out.orderBy(F.desc("anomaly_score")).first()
    assert top["i"] == 999 and top["is_outlier"]
    assert out.count() == 501  # nothing removed


def test_nnls_and_stacking(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(100, 10, 400)
    b = rng.normal(100, 10, 400)
    y = 0.7 * a + 0.3 * b
    df = spark.createDataFrame([(float(x), float(z), float(t), i % 4) for i, (x, z, t) in enumerate(zip(a, b, y))],
                               "a double, b double, y double, fold int")
    w = MD.nonnegative_blend_weights(df, "y", ["a", "b"])
    assert np.allclose(w, [0.7, 0.3], atol=1e-6)
    alpha, ws, icpt = MD.ridge_stack_weights(df, "y", ["a", "b"], alphas=(0.001, 1.0))
    assert alpha == 0.001 and np.allclose(ws, [0.7, 0.3], atol=1e-3)


def test_permutation_importance_finds_the_signal(spark, sf_dir):
    from faresight.plans.common import split_flights
    s = split_flights(spark, sf_dir)
    s = s.withColumn("total_fare", F.col("duration_hrs") * 1000.0)
    tr, te = s.where("split = 'train'"), s.where("split = 'test'")
    m = MD.fit_model(tr, "DecisionTree", MD.preset("DecisionTree")[1])
    imp = {r["feature"]: r["mae_increase"] for r in
           MD.permutation_importance(m, te.drop("split", "row_idx"), ["duration_hrs", "airline"]).collect()}
    assert imp["duration_hrs"] > 1000 and abs(imp["airline"]) < imp["duration_hrs"] / 10
    # the permutation keeps the multiset of values
    from faresight.operators.prefix import with_row_index
    base = with_row_index(te, [F.col("row_idx")], "_pos")
    assert base.count() == te.count()


def test_registered_queries_fit_reference_sizes(monkeypatch):
    from faresight.plans import q_models as Q
    seen = []

    class Enough(Exception):
        pass

    def fit(train, name, params, *args, **kwargs):
        seen.append((name, dict(params)))
        raise Enough

    def boosted(train, variants, *args, **kwargs):
        seen.append(dict(variants))
        raise Enough

    def staged(train, test, stage, params, **kwargs):
        seen.append((stage, dict(params)))
        raise Enough
    monkeypatch.setattr(Q, "_train_test", lambda *a: (None, None))
    monkeypatch.setattr(MD, "fit_model", fit)
    monkeypatch.setattr(MD, "fit_boosted", boosted)
    monkeypatch.setattr(MD, "two_stage_predictions", staged)
    monkeypatch.setattr(Q, "inverse_sqrt_weight", lambda *a: None)

    def run(q):
        try:
            q(None, None)
        except Enough:
            return seen.pop()
    for q, name in ((Q.l13_feature_importances, "RandomForest"), (Q.l15_batch_scoring, "DecisionTree"),
                    (Q.l17_save_load_roundtrip, "DecisionTree"), (Q.l14_permutation_importance, "DecisionTree")):
        got = run(q)
        assert got[0] == name and MD.REFERENCE_CONFIGS[name][1].items() <= got[1].items()
    assert run(Q.l11_two_stage_tax) == ("tax", MD.REFERENCE_CONFIGS["CatBoost"][1])
    losses = run(Q.l3_loss_variants)
    assert sorted(v["rounds"] for v in losses.values()) == [2000, 3000, 3000, 3000, 3000, 3000] and {v["patience"] for v in losses.values()} == {100}
    assert {v.get("alpha") for v in losses.values() if v.get("loss") == "quantile"} == {0.1, 0.5, 0.9}
    assert run(Q.l10_weighted_training)["weighted"]["rounds"] == 3000
    for f in (MD.train_all, MD.preset):
        assert "reference" in f.__defaults__ and "quick" not in f.__defaults__
    c = MD.REFERENCE_CONFIGS
    assert c["RandomForest"][1]["trees"] == 500 and c["RandomForest"][1]["depth"] == 20
    assert all(c[n][1]["rounds"] == 2000 and c[n][1]["rate"] == 0.02 and c[n][1]["depth"] == 8 for n in ("XGBoost", "LightGBM", "CatBoost"))
    assert c["LightGBM"][1]["leaves"] == 63 and c["CatBoost"][1]["symmetric"] and c["XGBoost"][1]["l1"] == 0.1


def test_search_spaces_are_the_references():
    import inspect
    maps = MD.draw(MD.BOOSTING_SPACE, 500)
    for key, low, high in (("rounds", 100, 499), ("depth", 3, 9), ("min_child", 1, 9)):
        got = {m[key] for m in maps}
        assert min(got) >= low and max(got) <= high and len(got) == high - low + 1 or key == "rounds" and max(got) > 480 and min(got) < 120
    for key, low, high in (("rate", 0.01, 0.21), ("rows", 0.6, 1.0), ("columns", 0.5, 1.0)):
        got = [m[key] for m in maps]
        assert low <= min(got) < low + 0.02 and high - 0.02 < max(got) <= high
    other = MD.draw(MD.SYMMETRIC_SPACE, 500)
    assert {k: sorted({m[k] for m in other}) for k in MD.SYMMETRIC_SPACE} == {
        "depth": [6, 7, 8, 9, 10], "rate": [0.01, 0.015, 0.02, 0.03, 0.05], "l2": [1, 3, 5, 7, 10], "noise": [0.5, 1, 2, 4],
        "temperature": [0, 0.5, 1, 2], "borders": [128, 254], "min_child": [1, 5, 10, 20]}
    assert maps[:30] == MD.draw(MD.BOOSTING_SPACE, 30)
    first, second = (inspect.signature(f).parameters for f in (MD.random_search, MD.patience_search))
    assert first["trials"].default == 30 and first["folds"].default == 3
    assert (second["trials"].default, second["rounds"].default, second["patience"].default, second["final_rounds"].default) == (40, 2000, 100, 3000)


def planted(spark, sf_dir):
    from faresight.plans.common import split_flights
    s = split_flights(spark, sf_dir)
    prem = F.when(F.col("travel_class") == "First Class", 20000.0).when(F.col("travel_class") == "Business", 8000.0).otherwise(0.0)
    s = s.withColumn("total_fare", F.col("duration_hrs") * 1000.0 + prem)
    return s.where("split = 'train'"), s.where("split = 'test'")


def test_searches_rank_maps_by_held_out_rows(spark, sf_dir):
    tr, te = planted(spark, sf_dir)
    space = {**MD.BOOSTING_SPACE, "rounds": (3, 12), "rate": [0.02, 0.5]}
    got = MD.random_search(tr, te, trials=4, folds=2, space=space, together=3).collect()
    best = max(got, key=lambda r: (r["cv_r2"], -r["trial"]))
    assert len(got) == 4 and [r["best"] for r in got] == [r["trial"] == best["trial"] for r in got]
    assert best["test_r2"] > 0.5 and sum(r["test_r2"] is not None for r in got) == 1
    small = {**MD.SYMMETRIC_SPACE, "depth": [3, 4], "rate": [0.3], "noise": [0]}
    got = MD.patience_search(tr, te, trials=3, space=small, rounds=25, patience=5, final_rounds=30).collect()
    assert len(got) == 3 and max(r["cv_r2"] for r in got) > 0.8
    assert [r["test_r2"] > 0.8 for r in got if r["best"]] == [True]


def test_two_stages_and_strata(spark, sf_dir):
    tr, te = planted(spark, sf_dir)
    quick = {"rounds": 12, "rate": 0.4, "depth": 4, "symmetric": True, "l2": 1.0, "patience": 5}
    got = MD.two_stage_predictions(tr, te, "tax", quick).toPandas()
    assert len(got) == te.count() and all(np.corrcoef(got["total_fare"], got[f"by_{v}"])[0, 1] > 0.9 for v in ("actual", "predicted", "out_of_fold", "none"))
    p = MD.tree_params(quick, 0)
    by = MD.per_stratum_models(tr, te, "travel_class", p, ("Business",), valid_share=10).toPandas()
    assert len(by) == te.count() and np.corrcoef(by["total_fare"], by["prediction"])[0, 1] > 0.9


def test_strata_equal_separate_fits(spark):
    """A thousand strata in one grouped fit; each model is that of its rows alone."""
    from faresight.operators import boosting as B, trees as T
    rng = np.random.default_rng(5)
    n, k = 20_000, 1000
    s = rng.integers(0, k, n)
    x = rng.normal(size=(n, 2)).round(2)
    y = x[:, 0] * (s % 7) + (x[:, 1] > 0) * 3 + s
    df = spark.createDataFrame([(int(a), float(b), float(c), float(d)) for a, (b, c), d in zip(s, x, y)], "s int, a double, b double, y double")
    binning = B.fit_binning(df, ["a", "b"])
    p = T.TreeParams(rounds=3, rate=0.5, depth=3, min_child=2)
    fits = [B.Fit(str(i), p, (i,)) for i in range(k)]
    got = B.fit_all(B.row_blocks(df, binning, "y", None, "s"), binning.sizes, fits, disjoint=True)
    for i in (0, 3, 500, 999):
        alone = B.fit_all(B.row_blocks(df.where(F.col("s") == i), binning, "y"), binning.sizes, [B.Fit("one", p)])[0]
        assert np.isclose(alone.base, got[i].base) and len(alone.trees) == len(got[i].trees) == 3
        for a, b in zip(alone.trees, got[i].trees):
            assert (a["id"] == b["id"]).all() and (a["feature"] == b["feature"]).all() and np.allclose(a["value"], b["value"])
    out = B.transform_by([B.BoostedTrees(binning, g) for g in got], df, "s", ["s", "y"]).toPandas()
    assert np.corrcoef(out["y"], out["prediction"])[0, 1] > 0.999


def test_permutation_query_takes_every_raw_column(monkeypatch):
    from unittest.mock import MagicMock

    from faresight.plans import q_models as Q
    seen = []
    monkeypatch.setattr(Q, "_train_test", lambda *a: (MagicMock(), MagicMock()))
    monkeypatch.setattr(MD, "fit_model", MagicMock())
    monkeypatch.setattr(MD, "permutation_importance", lambda m, raw, cols: seen.extend(cols))
    Q.l14_permutation_importance(None, None)
    assert sorted(seen) == sorted(["airline", "source", "destination", "travel_class", "stopovers", "aircraft_type", "booking_source",
                                   "seasonality", "duration_hrs", "days_before", "departure"])


def test_saved_tree_is_loaded_as_a_tree(spark, sf_dir, monkeypatch):
    """The round trip query fits a tree, so it must read back a tree."""
    from faresight.plans import q_models as Q
    tr, te = planted(spark, sf_dir)
    monkeypatch.setattr(Q, "_train_test", lambda *a: (tr, te))
    got = Q.l17_save_load_roundtrip(spark, sf_dir).collect()
    assert [(r["n"], r["max_abs_diff"]) for r in got] == [(te.count(), 0.0)]


def test_forest_over_one_column_scores_by_its_steps(spark):
    from faresight.operators import outliers as O
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 1)).round(1)
    trees = [O._grow(x[rng.choice(400, 64)], rng, 6) for _ in range(9)]
    at, score = O._steps(trees, O._c(64))
    probe = np.concatenate([x[:, 0], at, at - 1e-9, [-np.inf, np.inf]])
    assert (score[np.searchsorted(at, probe, side="right")] == O._scores(probe[:, None], trees, O._c(64))).all()
    df = spark.createDataFrame([(i, None if i == 7 else float(v), "t") for i, v in enumerate(x[:, 0])], "id int, v double, other string")
    out = O.isolation_forest(df, ["v"], n_trees=9, sample_size=64)
    got = {r["id"]: r for r in out.collect()}
    assert got[7]["anomaly_score"] is None and not got[7]["is_outlier"] and len(got) == 400 and got[3]["other"] == "t"
    assert "MapInPandas" not in out._jdf.queryExecution().toString()      # the other columns do not go through Python


def test_linear_attribution_of_sparse_vectors(spark):
    from types import SimpleNamespace

    from pyspark.ml.linalg import DenseVector, Vectors
    x = np.array([[0.0, 2.0, 1.0], [0.0, 0.0, 1.0], [0.0, -1.0, 1.0], [0.0, 0.0, 0.0]])
    coef = np.array([3.0, -2.0, 0.5])
    df = spark.createDataFrame([(Vectors.sparse(3, [(j, float(v)) for j, v in enumerate(r) if v]),) for r in x], ["features"])
    model = SimpleNamespace(transform=lambda raw: raw, learner=SimpleNamespace(coefficients=DenseVector(coef)), encoding="", num_cols=["a", "b", "c"])
    out = MD.linear_attribution(model, df)
    got = {r["feature"]: r["mean_abs_attr"] for r in out.collect()}
    assert np.allclose([got[c] for c in "abc"], np.abs(coef * (x - x.mean(0))).mean(0))
    assert "posexplode" not in out._jdf.queryExecution().toString()       # a zero makes no row
