"""Registered model-training, scoring and tracking analyses (L*, V14, V15,
E11, M8–M10, S9). Learners have no SQL form, so these are rows-only
checks; their building blocks are unit-tested against brute force."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from faresight.operators import evaluate as EV
from faresight.operators import linear as LN
from faresight.operators import models as MD
from faresight.operators import tracking as TR
from faresight.operators.encode import inverse_sqrt_weight
from faresight.operators.features import engineer_features
from faresight.operators.lookup import out_of_fold_group_mean
from faresight.operators.outliers import isolation_forest
from faresight.operators.split import hash_fold
from faresight.plans.common import FEATURE_RAW, FLIGHT_COLUMNS, split_flights
from faresight.plans.q_eval import _CMP_CTES as CMP_CTES
from faresight.plans.registry import register, rnd
from faresight.roles import FLIGHT_ROLES
from faresight.session import materialize
from faresight.sources.flights import with_flights

Y = "total_fare"


# What the preprocessing reads; the position keeps the rows in their order, which row draws follow.
_MODEL_ROWS = (*FEATURE_RAW, "row_idx")


def _train_test(spark, sf_dir, *columns):
    s = split_flights(spark, sf_dir, *columns)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


def _metrics(df, p="prediction", keys=()):
    scored = materialize(df.select(*keys, Y, p))          # scored once for the sums and the median
    m = EV.regression_metrics(scored, Y, p, list(keys))
    return m.select(*keys, "n", *[rnd(c).alias(c) for c in ("r2", "mae", "rmse", "mape", "medae")])


@register("l12_train_all_models")
def l12_train_all_models(spark, sf_dir):
    """L1/L2/L4/L5/L12/L13 + V7/V8: every configured learner at its reference size
    on the temporal split, with failures kept, seconds and champion flag."""
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS)
    table, _ = MD.train_all(tr, te)
    champ = EV.select_champion(table.where(F.col("error").isNull()), "r2").select("model").first()[0]
    return table.withColumn("champion", F.col("model") == F.lit(champ)).drop("importances", "params")


@register("l13_feature_importances")
def l13_feature_importances(spark, sf_dir):
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS)
    m = MD.fit_model(tr, "RandomForest", MD.preset("RandomForest")[1])
    rows = [(i, f, v) for i, (f, v) in enumerate(MD.importances(m))]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


# The reference's loss variants; the two outer quantiles are added.
_SLOW = {"rounds": 3000, "rate": 0.01, "depth": 10, "symmetric": True, "l2": 1.0, "min_child": 5, "noise": 0.5, "temperature": 1.0, "patience": 100}
LOSS_VARIANTS = {
    "depth 10 squared": _SLOW,
    "depth 8 absolute": {**_SLOW, "rounds": 2000, "rate": 0.02, "depth": 8, "l2": 3.0, "noise": 1.0, "loss": "absolute"},
    "depth 10 absolute": {**_SLOW, "loss": "absolute"},
    "depth 10 quantile 0.5": {**_SLOW, "loss": "quantile", "alpha": 0.5},
    "depth 8 quantile 0.1": {**_SLOW, "rate": 0.02, "depth": 8, "l2": 3.0, "loss": "quantile", "alpha": 0.1},
    "depth 8 quantile 0.9": {**_SLOW, "rate": 0.02, "depth": 8, "l2": 3.0, "loss": "quantile", "alpha": 0.9},
}
MEDIAN_LOSS = {"rounds": 3000, "rate": 0.02, "depth": 8, "symmetric": True, "l2": 3.0, "loss": "absolute", "patience": 100}


@register("l3_loss_variants")
def l3_loss_variants(spark, sf_dir):
    """L3: squared, absolute and quantile losses (leaf values are exact quantiles of the
    residuals), grown in the same rounds; metrics, rounds kept and the share of test fares at
    or below the prediction."""
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS)
    outs = []
    for name, m in MD.fit_boosted(tr, LOSS_VARIANTS).items():
        scored = materialize(m.transform(te).select(Y, "prediction"))
        share = scored.agg(F.avg((F.col(Y) <= F.col("prediction")).cast("double"))).first()[0]     # one row
        outs.append(_metrics(scored).withColumns({"variant": F.lit(name), "rounds": F.lit(m.core.fitted.rounds), "share_below": F.lit(share)}))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


@register("l9_per_class_models")
def l9_per_class_models(spark, sf_dir):
    """One absolute-loss model per travel class in one grouped fit, with log1p fares in the
    two upper classes."""
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS)
    p = MD.per_stratum_models(tr, te, "travel_class", MD.tree_params(MEDIAN_LOSS, 0), ("Business", "First Class"), valid_share=10)
    return _metrics(p, keys=["stratum"])


@register("l10_weighted_training")
def l10_weighted_training(spark, sf_dir):
    """L10 + F21: absolute loss with inverse-sqrt fare weights normalised to mean 1 (leaf
    values are weighted medians)."""
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS)
    return _metrics(MD.fit_boosted(inverse_sqrt_weight(tr, Y, "w"), {"weighted": MEDIAN_LOSS}, weight_col="w")["weighted"].transform(te))


@register("e11_log_target_ridge")
def e11_log_target_ridge(spark, sf_dir):
    tr, te = _train_test(spark, sf_dir, *FEATURE_RAW)
    trl = tr.withColumn("log_fare", F.log1p(Y))
    m = MD.fit_model(trl, "Ridge", MD.preset("Ridge")[1], keep=["log_fare"], target="log_fare")
    return _metrics(m.transform(te).withColumn("prediction", F.expm1("prediction")))


@register("l11_two_stage_tax")
def l11_two_stage_tax(spark, sf_dir):
    """Predict the unavailable tax column, then feed it to the fare model. Variants:
    trained on actual tax / on tax predicted in sample / on tax predicted out of fold (five
    folds) / without tax; at test time only the predicted tax exists."""
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS, "tax")
    p = materialize(MD.two_stage_predictions(tr, te, "tax", MD.preset("CatBoost")[1]))
    long = p.select(Y, F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.col(f"by_{v}").alias("prediction"))
                                           for v in ("actual", "predicted", "out_of_fold", "none")])).alias("_v")).select(Y, "_v.variant", "_v.prediction")
    return _metrics(long, keys=["variant"])


def linear_matrix(spark, sf_dir, row_idx: bool = True):
    """Train and test matrices of the linear and nearest-neighbour learners: every categorical
    → smoothed train mean, then population z-scores fitted on train (null → 0). The features
    and their encodings are each built once, for both sides, and written."""
    from faresight.operators.encode import PopulationScaler, TargetEncoder
    from faresight.operators.preprocess import FarePreprocessor

    keep = ["row_idx", Y] if row_idx else [Y]
    s = split_flights(spark, sf_dir, *FEATURE_RAW, *keep)
    prep = FarePreprocessor(keep=[*keep, "split"]).fit(s.where(F.col("split") == "train"))
    cats, nums = prep.cat_feature_names, [c for c in prep.num_feature_names if c not in (*keep, "split")]
    x = materialize(prep.transform(s))
    enc = TargetEncoder(cats, Y).fit(x.where(F.col("split") == "train"))
    raw = [f"{c}_te" for c in cats] + nums
    x = materialize(enc.transform(x).select(*keep, "split", *[F.col(c).cast("double").alias(c) for c in raw]))
    scaler = PopulationScaler(raw).fit(x.where(F.col("split") == "train"))
    feats = [f"{c}_z" for c in raw]
    z = scaler.transform(x).select("split", *keep, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in feats])
    return z.where(F.col("split") == "train").drop("split"), z.where(F.col("split") == "test").drop("split"), feats


@register("l4_linear_learners")
def l4_linear_learners(spark, sf_dir):
    """L4: least squares, ridge (α = 10) and lasso with α cross-validated over six values and
    five folds, from one moment pass over the target-encoded, standardised matrix."""
    tr, te, feats = linear_matrix(spark, sf_dir)
    folds = LN.moments(tr.withColumn("fold", hash_fold(["row_idx"], 5)), feats, Y, "fold")
    total, test = sum(folds.values()), LN.moments(te, feats, Y)[0]
    alpha, _, lasso = LN.lasso_cv(folds, (0.01, 0.1, 1.0, 10.0, 100.0, 1000.0))
    fits = [("Linear", 0.0, LN.ridge(total, 0.0)), ("Ridge", 10.0, LN.ridge(total, 10.0)), ("Lasso", alpha, lasso)]
    mae = LN.absolute_errors(te, feats, Y, [w for _, _, w in fits])
    rows = [(n, a, len(feats), int((abs(w[1:]) > 0).sum()), LN.r2_on(total, w), LN.r2_on(test, w), m) for (n, a, w), m in zip(fits, mae)]
    return spark.createDataFrame(rows, "model string, alpha double, features int, nonzero int, train_r2 double, test_r2 double, test_mae double")


@register("l7_lasso_path")
def l7_lasso_path(spark, sf_dir):
    """Ridge and lasso over 50 log-spaced alphas, 10^-2 to 10^5: non-zero coefficients and
    train and test R² and MAE per alpha, from two moment passes and two error passes."""
    import numpy as np
    tr, te, feats = linear_matrix(spark, sf_dir, row_idx=False)
    m_tr, m_te = LN.moments(tr, feats, Y)[0], LN.moments(te, feats, Y)[0]
    alphas = [float(a) for a in np.logspace(-2, 5, 50)]
    fits = [(kind, a, w) for kind in ("ridge", "lasso") for a, w in zip(alphas, LN.path(m_tr, alphas, kind))]
    coefs = [w for _, _, w in fits]
    errors = zip(LN.absolute_errors(tr, feats, Y, coefs), LN.absolute_errors(te, feats, Y, coefs))
    rows = [(kind, a, int((abs(w[1:]) > 0).sum()), LN.r2_on(m_tr, w), LN.r2_on(m_te, w), *e) for (kind, a, w), e in zip(fits, errors)]
    return spark.createDataFrame(rows, "kind string, alpha double, nonzero int, train_r2 double, test_r2 double, train_mae double, test_mae double")


@register("l8_random_search")
def l8_random_search(spark, sf_dir):
    """30 seeded maps of boosted trees over the reference's space (100 to 500 trees, depth 3
    to 9, step, row and column share, leaf weight), scored by three walk-forward folds of the
    training rows; the best map is fitted on them all and scored once on the test split."""
    return MD.random_search(*_train_test(spark, sf_dir, *_MODEL_ROWS))


@register("l8_patience_search")
def l8_patience_search(spark, sf_dir):
    """40 seeded maps of symmetric trees over the reference's seven parameters, up to 2,000
    rounds, stopped by a patience of 100 on the last fifth of the training rows."""
    return MD.patience_search(*_train_test(spark, sf_dir, *_MODEL_ROWS))


ATTRIBUTED_ROUNDS = 200


@register("l14_tree_attribution")
def l14_tree_attribution(spark, sf_dir):
    """Mean absolute Shapley value per feature of the boosted model over the whole test
    split, and the greatest difference between a prediction and its parts' sum."""
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS)
    p = {**MD.preset("CatBoost")[1], "rounds": ATTRIBUTED_ROUNDS, "patience": None}      # a fixed number: patience keeps hardly a tree where there is little to learn
    m = MD.fit_boosted(tr, {"model": p}, keep=["row_idx"])["model"]
    parts = materialize(m.attributions(te, ["row_idx"]))
    plain = m.transform(te).select("row_idx", F.col("prediction").alias("plain"))
    gap = parts.join(plain, "row_idx").agg(F.max(F.abs(F.col("prediction") - F.col("plain"))).alias("max_gap"), F.max("expected").alias("expected")).first()   # one row
    names = F.array(*[F.lit(f) for f in m.feature_names])
    long = parts.select(F.explode(F.arrays_zip(names.alias("feature"), F.col("phi").alias("value"))).alias("_z")).select("_z.feature", "_z.value")
    return long.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs_value"), F.count(F.lit(1)).alias("n")) \
        .withColumns({c: F.lit(gap[c]).cast("double") for c in ("max_gap", "expected")})


@register("l14_linear_attribution")
def l14_linear_attribution(spark, sf_dir):
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS)
    m = MD.fit_model(tr, "Ridge", MD.preset("Ridge")[1])
    return MD.linear_attribution(m, te).orderBy(F.desc("mean_abs_attr")).limit(20)


@register("l16_isolation_forest")
def l16_isolation_forest(spark, sf_dir):
    s = split_flights(spark, sf_dir, *_MODEL_ROWS)
    fe = engineer_features(s, keep=[Y, "row_idx"])
    out = isolation_forest(fe, [Y])
    return out.groupBy("is_outlier").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("anomaly_score")).alias("mean_score"))


@register("l15_batch_scoring")
def l15_batch_scoring(spark, sf_dir):
    """Requests, some with a wrong field, checked against all eight option lists; the
    valid ones are scored."""
    from faresight.plans.q_eval import requests
    from faresight.streaming.scoring import score
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS)
    m = MD.fit_model(tr, "DecisionTree", MD.preset("DecisionTree")[1], keep=["row_idx"])
    out = score(m, requests(te), keep=["row_idx"], domains={c: tr for c in FLIGHT_ROLES.cat})
    return out.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("predicted_fare"), 2).alias("mean_fare"))


@register("l17_save_load_roundtrip")
def l17_save_load_roundtrip(spark, sf_dir):
    """Save a fitted model under the session's checkpoint folder, load it
    back and score: the two predictions must agree row by row."""
    import uuid
    from faresight.session import ensure_checkpoint_dir
    tr, te = _train_test(spark, sf_dir, *_MODEL_ROWS)
    m = MD.fit_model(tr, "DecisionTree", MD.preset("DecisionTree")[1], keep=["row_idx"])
    path = f"{ensure_checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    m.save(path)
    m2 = type(m).load(spark, path)
    a = m.transform(te).select("row_idx", F.col("prediction").alias("a"))
    b = m2.transform(te).select("row_idx", F.col("prediction").alias("b"))
    j = a.join(b, "row_idx")
    return j.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff"))


# V14 / V15 ---------------------------------------------------------------------------------------
def _oof_group_means(spark, sf_dir, k=5):
    """Out-of-fold predictions of three group-mean base models on train (T5 folds)."""
    from faresight.plans.q_eval import MODEL_KEYS
    keys = {c for ks in MODEL_KEYS.values() for c in ks}
    tr, _ = _train_test(spark, sf_dir, "row_idx", Y, *keys)
    out = materialize(tr.withColumn("fold", hash_fold(["row_idx"], k, portable=True))
                      .select("row_idx", "fold", Y, *keys))
    for name, keys in MODEL_KEYS.items():
        out = out_of_fold_group_mean(out, keys, Y, "fold", name)
    return materialize(out.select("row_idx", "fold", Y, *MODEL_KEYS)), list(MODEL_KEYS)


@register("v14_ridge_stacking")
def v14_ridge_stacking(spark, sf_dir):
    oof, preds = _oof_group_means(spark, sf_dir)
    alpha, w, b = MD.ridge_stack_weights(oof, Y, preds)
    return spark.createDataFrame([(alpha, b, *w)], "alpha double, intercept double, " +
                                 ", ".join(f"w_{p} double" for p in preds))


@register("v15_nonnegative_blend")
def v15_nonnegative_blend(spark, sf_dir):
    oof, preds = _oof_group_means(spark, sf_dir)
    w = MD.nonnegative_blend_weights(oof, Y, preds)
    return spark.createDataFrame([tuple(w)], ", ".join(f"w_{p} double" for p in preds))


# M8 / M9 / M10 -----------------------------------------------------------------------------------
def _runs(spark, sf_dir):
    from faresight.plans.q_eval import _MODELS, predictions_frame
    c = EV.comparison_table(predictions_frame(spark, sf_dir), Y, list(_MODELS), median=None)
    champ = EV.select_champion(c, "r2").select("model").first()[0]
    return TR.runs_from_metrics(c, "group-mean-baselines", champion=champ, tags={"stage": "evaluation"})


@register("m8_run_log", with_flights("""
SELECT 'group-mean-baselines' AS experiment, model, model = (SELECT model FROM cmp ORDER BY r2 IS NULL, r2 DESC, model LIMIT 1) AS champion,
  ['R2', 'MAE', 'RMSE', 'MAPE'] AS metric_names, r2 FROM cmp""", *CMP_CTES))
def m8_run_log(spark, sf_dir):
    r = _runs(spark, sf_dir)
    return r.select("experiment", "model", "champion", F.map_keys("metrics").alias("metric_names"),
                    rnd(F.col("metrics")["R2"]).alias("r2"))


@register("m9_best_run", with_flights("SELECT model, mae FROM cmp ORDER BY mae, model LIMIT 1", *CMP_CTES))
def m9_best_run(spark, sf_dir):
    return TR.best_run(_runs(spark, sf_dir), "MAE", ascending=True).select("model", rnd(F.col("metrics")["MAE"], 4)
                                                                            .alias("mae"))


@register("m10_registry_resolution", with_flights("""
SELECT 'fare-model' AS name, 2 AS version, 'alias' AS source
UNION ALL SELECT 'fare-model', CAST(count(*) AS INTEGER), 'latest' FROM cmp""", *CMP_CTES))
def m10_registry_resolution(spark, sf_dir):
    """Versions written per model of the comparison (numeric order), one alias."""
    runs = _runs(spark, sf_dir).select("run_id", "model")
    versions = runs.select(F.lit("fare-model").alias("name"),
                           F.row_number().over(Window.orderBy("model")).alias("version"), "run_id", F.current_timestamp().cast("timestamp").alias("ts"))
    aliases = versions.where(F.col("version") == 2).select("name", F.lit("production").alias("alias"), "version", "ts")
    return TR.resolve_version(versions, aliases, "fare-model").unionByName(
        TR.resolve_version(versions, None, "fare-model"))


@register("l14_permutation_importance")
def l14_permutation_importance(spark, sf_dir):
    """L14 for trees: MAE increase on the test split when each raw column that the
    preprocessing reads is permuted (exact, distributed permutation)."""
    tr, te = _train_test(spark, sf_dir, *FLIGHT_COLUMNS, "row_idx")
    m = MD.fit_model(tr, "DecisionTree", MD.preset("DecisionTree")[1])
    cols = [*FLIGHT_ROLES.cat, *FLIGHT_ROLES.num, FLIGHT_ROLES.date]
    return MD.permutation_importance(m, te.drop("split", "row_idx"), cols)


@register("l6_knn_regression")
def l6_knn_regression(spark, sf_dir):
    """K-NN regression on target-encoded, standardised features (every
    categorical → smoothed train mean, then population z-scores fitted on
    train), k ∈ {5, 10, 20, 50}, inverse-distance weights, exact search over
    the whole training split; metrics per k on the temporal test split."""
    from faresight.operators.knn import knn_predict
    m_tr, m_te, feats = linear_matrix(spark, sf_dir)
    ks = (5, 10, 20, 50)
    preds = knn_predict(m_tr, m_te.drop(Y), feats, Y, "row_idx", "row_idx", ks, "distance")
    scored = m_te.select("row_idx", Y).join(preds, "row_idx")
    long = scored.select(Y, F.explode(F.array(*[F.struct(F.lit(k).alias("n_neighbors"), F.col(f"pred_k{k}").alias("prediction"))
                                                 for k in ks])).alias("_p")).select(Y, "_p.n_neighbors", "_p.prediction")
    return _metrics(long, keys=["n_neighbors"])
