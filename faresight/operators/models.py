"""Model training, scoring and comparison.

Features: the preprocessor (E1 + frequency maps) → alphabetical ordinal codes for categoricals
(tree learners) or one-hot vectors (linear learners, MLlib). Trees, boosting and forests are the
histogram learners of ``boosting`` and ``forest``, configured from the reference's settings; the
default ``reference`` preset keeps its sizes (500 trees, 2,000 boosting rounds), ``quick`` shrinks
them for trials and is used only where it is named.
"""

from __future__ import annotations

import json
import os
import random
import time
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from faresight.operators import boosting as B
from faresight.operators.encode import FrequencyEncoderModel, OrdinalEncoder, OrdinalEncoderModel, one_hot_stages
from faresight.operators.evaluate import regression_metrics
from faresight.operators.forest import Forest, fit_forest
from faresight.operators.preprocess import FarePreprocessor, FarePreprocessorModel
from faresight.operators.profile import scalars
from faresight.operators.split import hash_fold, walk_forward_blocks
from faresight.operators.trees import TreeParams
from faresight.roles import FLIGHT_ROLES, Roles
from faresight.session import drop_table, materialize

# The reference's learner settings (patience of the first two from its comparison of boosted learners).
REFERENCE_CONFIGS = {
    "RandomForest": ("forest", {"trees": 500, "depth": 20, "min_split": 5, "min_child": 2, "node_columns": "sqrt",
                                "bootstrap": True, "l2": 0.0, "seed": 42}),
    "XGBoost": ("boosting", {"rounds": 2000, "rate": 0.02, "depth": 8, "rows": 0.8, "columns": 0.8, "l1": 0.1, "l2": 1.0,
                             "patience": 50, "seed": 42}),
    "LightGBM": ("boosting", {"rounds": 2000, "rate": 0.02, "depth": 8, "leaves": 63, "rows": 0.8, "columns": 0.8, "l1": 0.1, "l2": 1.0,
                              "min_child": 20, "patience": 50, "seed": 42}),
    "CatBoost": ("boosting", {"rounds": 2000, "rate": 0.02, "depth": 8, "symmetric": True, "l2": 3.0, "patience": 100, "seed": 42}),
    "DecisionTree": ("tree", {"rounds": 1, "rate": 1.0, "depth": 12, "min_child": 10, "l2": 0.0, "seed": 42}),
    "Linear": ("linear", {"regParam": 0.0, "solver": "auto"}),
    "Ridge": ("linear", {"alpha": 10.0, "elasticNetParam": 0.0, "solver": "auto"}),
    "Lasso": ("linear", {"alpha": 1.0, "elasticNetParam": 1.0}),
}
QUICK = {"trees": 20, "rounds": 20, "depth": 6, "rate": 0.1}


def preset(name: str, which: str = "reference") -> tuple[str, dict]:
    family, params = REFERENCE_CONFIGS[name]
    params = dict(params)
    if which == "quick":
        for k, v in QUICK.items():
            if k in params and (family == "boosting" or k not in ("rounds", "rate")):
                params[k] = v
    return family, params


def tree_params(params: dict, features: int) -> TreeParams:
    p = {k: v for k, v in params.items() if k != "trees"}
    if p.get("node_columns") == "sqrt":
        p["node_columns"] = max(1, int(features ** 0.5))
    return TreeParams(**p)


def make_regressor(name: str, params: dict, label: str, features: str = "features", n_rows: int | None = None,
                   label_std: float | None = None, weight_col: str | None = None):
    """MLlib estimator of a linear learner."""
    p = dict(params)
    common = {"labelCol": label, "featuresCol": features, "predictionCol": "prediction"}
    if weight_col:
        common["weightCol"] = weight_col
    alpha = p.pop("alpha", None)
    if alpha is not None:
        if p.get("elasticNetParam", 0.0) == 0.0:
            # sklearn Ridge(alpha) on standardised features = MLlib regParam α·std_pop(y)/n
            p["regParam"] = alpha * (label_std or 1.0) / max(n_rows or 1, 1)
        else:
            p["regParam"] = alpha
    return LinearRegression(**common, **p)


def _save_json(spark: SparkSession, value, path: str) -> None:
    spark.createDataFrame([(json.dumps(value),)], "meta string").write.mode("overwrite").json(path)


def _load_json(spark: SparkSession, path: str):
    return json.loads(spark.read.json(path).first()["meta"])


def _save_preparation(spark: SparkSession, prep, encoder, cats, nums, encoding: str, path: str) -> None:
    prep.freq_model.save(os.path.join(path, "freq"))
    if encoder is not None:
        encoder.save(os.path.join(path, "ordinal"))
    _save_json(spark, {"cat": cats, "num": nums, "encoding": encoding, "keep": prep.keep, "order": prep.feature_order}, os.path.join(path, "meta"))


def _load_preparation(spark: SparkSession, path: str, roles: Roles):
    meta = _load_json(spark, os.path.join(path, "meta"))
    freq = FrequencyEncoderModel.load(spark, os.path.join(path, "freq"))
    num_prep = [c for c in meta["order"] if c not in meta["cat"]] + [f"{c}_freq" for c in freq.inputCols]
    prep = FarePreprocessorModel(roles, meta["keep"], meta["cat"], num_prep, meta["order"], freq)
    enc = OrdinalEncoderModel.load(spark, os.path.join(path, "ordinal")) if meta["encoding"] == "ordinal" else None
    return prep, enc, meta


class TreeModel:
    """Preprocessor, category codes and a histogram learner (boosted trees or a forest).
    ``transform`` returns the preprocessor's kept columns that the rows have, and the prediction."""

    def __init__(self, prep, encoder, core, cats, nums):
        self.prep, self.encoder, self.core, self.cat_cols, self.num_cols = prep, encoder, core, list(cats), list(nums)

    @property
    def feature_names(self) -> list[str]:
        return self.core.features

    def encoded(self, raw: DataFrame) -> DataFrame:
        return self.encoder.transform(self.prep.transform(raw))

    def transform(self, raw: DataFrame) -> DataFrame:
        return self.core.transform(self.encoded(raw), [c for c in self.prep.keep if c in raw.columns])

    def attributions(self, raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """See ``BoostedTrees.attributions``."""
        return self.core.attributions(self.encoded(raw), keep)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.core.save(spark, os.path.join(path, "learner"))
        _save_preparation(spark, self.prep, self.encoder, self.cat_cols, self.num_cols, "ordinal", path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, roles: Roles = FLIGHT_ROLES) -> "TreeModel":
        prep, enc, meta = _load_preparation(spark, path, roles)
        kind = Forest if Forest.is_saved(spark, os.path.join(path, "learner")) else B.BoostedTrees
        return cls(prep, enc, kind.load(spark, os.path.join(path, "learner")), meta["cat"], meta["num"])


class FareModel:
    """Preprocessor + category encoder + MLlib pipeline (assembler + linear learner)."""

    def __init__(self, prep, encoder, pipeline: PipelineModel, cat_cols, num_cols, encoding: str):
        self.prep, self.encoder, self.pipeline = prep, encoder, pipeline
        self.cat_cols, self.num_cols, self.encoding = list(cat_cols), list(num_cols), encoding

    def transform(self, raw: DataFrame) -> DataFrame:
        x = self.prep.transform(raw)
        if self.encoder is not None:
            x = self.encoder.transform(x)
        return self.pipeline.transform(x)

    @property
    def learner(self):
        return self.pipeline.stages[-1]

    def save(self, path: str) -> None:
        """The MLlib part with its own writer, the encoders as tables."""
        self.pipeline.write().overwrite().save(os.path.join(path, "pipeline"))
        _save_preparation(SparkSession.getActiveSession(), self.prep, self.encoder, self.cat_cols, self.num_cols, self.encoding, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, roles: Roles = FLIGHT_ROLES) -> "FareModel":
        prep, enc, meta = _load_preparation(spark, path, roles)
        return cls(prep, enc, PipelineModel.load(os.path.join(path, "pipeline")), meta["cat"], meta["num"], meta["encoding"])


class Prepared:
    """Fitted preprocessing (E6) and category encoding, shared by every learner trained on the
    same rows; with ``feat`` (linear learners) also the vector assembly."""

    def __init__(self, prep, enc, feat: PipelineModel | None, cats, nums, encoding, target):
        self.prep, self.enc, self.feat = prep, enc, feat
        self.cats, self.nums, self.encoding, self.target = cats, nums, encoding, target

    @property
    def features(self) -> list[str]:
        return [f"{c}_code" for c in self.cats] + self.nums

    def matrix(self, raw: DataFrame) -> DataFrame:
        return self.encoded(self.prep.transform(raw))

    def encoded(self, x: DataFrame) -> DataFrame:
        """The matrix of preprocessed rows."""
        if self.enc is not None:
            x = self.enc.transform(x)
        return self.feat.transform(x) if self.feat is not None else x

    def model(self, learner_model) -> FareModel:
        return FareModel(self.prep, self.enc, PipelineModel(stages=[*self.feat.stages, learner_model]),
                         self.cats, self.nums, self.encoding)

    def trees(self, core) -> TreeModel:
        return TreeModel(self.prep, self.enc, core, self.cats, self.nums)


def prepare(train: DataFrame, roles: Roles = FLIGHT_ROLES, keep: Sequence[str] = (), encoding: str = "ordinal",
            target: str | None = None, weight_col: str | None = None) -> Prepared:
    target = target or roles.target
    keep = list(dict.fromkeys([*keep, target, roles.target] + ([weight_col] if weight_col else [])))
    prep = FarePreprocessor(roles, keep=keep).fit(train)
    x = prep.transform(train)
    cats = prep.cat_feature_names
    nums = [c for c in prep.num_feature_names if c not in keep]
    if encoding == "ordinal":
        return Prepared(prep, OrdinalEncoder(cats).fit(x), None, cats, nums, encoding, target)
    x = materialize(x)        # read by the indexer and by every pass of a learner
    asm = VectorAssembler(inputCols=[f"oh_{c}_vec" for c in cats] + nums, outputCol="features", handleInvalid="keep")
    feat = Pipeline(stages=[*one_hot_stages(cats), asm]).fit(x)
    prepared = Prepared(prep, None, feat, cats, nums, encoding, target)
    prepared.rows = x
    return prepared


def fit_linear(prepared: Prepared, x: DataFrame, name: str, params: dict, weight_col: str | None = None) -> FareModel:
    """Fit one linear learner on an already assembled matrix."""
    stats = scalars(x.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(prepared.target).alias("s")))
    reg = make_regressor(name, params, prepared.target, n_rows=stats["n"], label_std=stats["s"], weight_col=weight_col)
    return prepared.model(reg.fit(x))


def fit_model(train: DataFrame, name: str, params: dict, roles: Roles = FLIGHT_ROLES, keep: Sequence[str] = (),
              weight_col: str | None = None, valid: DataFrame | None = None, target: str | None = None) -> FareModel | TreeModel:
    """Fit preprocessing and one learner on ``train`` (raw rows); boosting watches ``valid``."""
    family = REFERENCE_CONFIGS.get(name, ("linear", {}))[0]
    pr = prepare(train, roles, keep, "onehot" if family == "linear" else "ordinal", target, weight_col)
    if family == "linear":
        m = fit_linear(pr, pr.encoded(pr.rows), name, params, weight_col)
        drop_table(pr.rows)
        return m
    x = pr.matrix(train)
    p = tree_params(params, len(pr.features))
    table = x = materialize(x.select(*pr.features, pr.target, *([weight_col] if weight_col else [])).withColumn("_part", F.lit(0)))
    if family == "forest":
        forest = fit_forest(x, pr.features, pr.target, p, params["trees"], weight=weight_col)
        drop_table(table)
        return pr.trees(forest)
    if valid is not None:
        x = x.unionByName(pr.matrix(valid).select(*pr.features, pr.target, *([weight_col] if weight_col else [])).withColumn("_part", F.lit(1)))
    fit = B.Fit(name, p, (0,), (1,) if valid is not None else ())
    core = B.boost(x, pr.features, pr.target, [fit], weight_col, "_part")[0]
    drop_table(table)
    return pr.trees(core)


def importances(model: FareModel | TreeModel, x_ref: DataFrame | None = None) -> list[tuple[str, float]]:
    """Feature importance, sorted — shares of gain for trees, or |coef| × std of
    the feature for linear models (standardised coefficients)."""
    if isinstance(model, TreeModel):
        return model.core.importances()
    names = _vector_names(model)
    vals = np.abs(model.learner.coefficients.toArray())
    if x_ref is not None:
        vals = vals * _vector_std(model, x_ref)
    pairs = sorted(zip(names, [float(v) for v in vals]), key=lambda t: -t[1])
    return pairs


def _vector_names(model: FareModel) -> list[str]:
    names = []
    if model.encoding == "onehot":
        for st in model.pipeline.stages:
            if st.__class__.__name__ == "StringIndexerModel":
                for col, labels in zip(st.getInputCols() if st.isSet("inputCols") else [st.getInputCol()],
                                       [st.labels] if not st.isSet("inputCols") else st.labelsArray):
                    names += [f"{col}={v}" for v in labels]
    return names + model.num_cols


def _vector_std(model: FareModel, x_ref: DataFrame) -> np.ndarray:
    from pyspark.ml.stat import Summarizer
    scored = model.transform(x_ref)
    row = scored.select(Summarizer.variance(F.col("features")).alias("v")).first()
    return np.sqrt(row["v"].toArray())


def linear_attribution(model: FareModel, raw: DataFrame) -> DataFrame:
    """L14 (re-aimed exact attribution for linear models): mean |coef·(x − x̄)|
    per feature, from one mean pass and one aggregate pass over the vectors. Only the entries
    that are not zero become rows; the zeros of a slot all add |coef·x̄|."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer
    vectors = materialize(model.transform(raw).select("features"))
    coef = model.learner.coefficients.toArray().tolist()
    stats = vectors.select(Summarizer.metrics("mean", "count").summary(F.col("features")).alias("s")).select("s.mean", "s.count").first()
    mean, n = stats["mean"].toArray().tolist(), stats["count"]
    slots = vectors.sparkSession.createDataFrame(
        [(i, f, c, m) for i, (f, c, m) in enumerate(zip(_vector_names(model), coef, mean))], "slot int, feature string, coef double, mean double")
    entries = F.filter(F.transform(vector_to_array("features"), lambda x, i: F.struct(i.alias("slot"), x.alias("x"))), lambda e: e["x"] != 0)
    present = vectors.select(F.explode(entries).alias("e")).select("e.slot", "e.x").join(F.broadcast(slots), "slot") \
        .groupBy("slot").agg(F.sum(F.abs(F.col("coef") * (F.col("x") - F.col("mean")))).alias("s"), F.count(F.lit(1)).alias("k"))    # one row per slot
    total = F.coalesce("s", F.lit(0.0)) + (F.lit(n) - F.coalesce("k", F.lit(0))) * F.abs(F.col("coef") * F.col("mean"))
    return slots.join(present, "slot", "left").select("feature", (total / F.lit(n)).alias("mean_abs_attr"))


def fit_boosted(train: DataFrame, variants: dict[str, dict], roles: Roles = FLIGHT_ROLES, keep: Sequence[str] = (), weight_col: str | None = None,
                prepared: Prepared | None = None, held_out: int = 10) -> dict[str, TreeModel]:
    """Boosted learners by name, grown in the same rounds over one binned table. One with
    patience learns from all but one in ``held_out`` training rows (by their hash) and stops on
    those; one without learns from all."""
    pr = prepared or prepare(train, roles, keep, "ordinal", weight_col=weight_col)
    cols = [*pr.features, pr.target]
    x = pr.matrix(train).select(*cols, *([weight_col] if weight_col else []))
    x = materialize(x.withColumn("_part", (hash_fold(cols, held_out) == 0).cast("int")))
    fits = []
    for name, settings in variants.items():
        p = tree_params(settings, len(pr.features))
        fits.append(B.Fit(name, p, (0,) if p.patience else (0, 1), (1,) if p.patience else ()))
    cores = B.boost(x, pr.features, pr.target, fits, weight_col, "_part")
    drop_table(x)
    return {f.name: pr.trees(core) for f, core in zip(fits, cores)}


def train_all(train: DataFrame, valid: DataFrame, names: Sequence[str] = tuple(REFERENCE_CONFIGS),
              which: str = "reference", roles: Roles = FLIGHT_ROLES, keep: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """Fit every configuration, skip failures, time each fit and evaluate on ``valid``.

    The features are built once per encoding. Boosted learners and the single tree grow in the
    same rounds over one binned table (``seconds`` of each: until it was done, from their common
    start); a learner with patience stops on a tenth of the training rows, never on ``valid``.
    Returns the comparison table and the fitted models by name."""
    spark = train.sparkSession
    rows, models, took, errors = [], {}, {}, {}
    families = {n: preset(n, which) for n in names}
    trees = [n for n in names if families[n][0] != "linear"]
    together = [n for n in trees if families[n][0] != "forest"]
    if trees:
        pr = prepare(train, roles, keep, "ordinal")

        def boosted(chosen):
            for n, m in fit_boosted(train, {n: families[n][1] for n in chosen}, roles, keep, prepared=pr).items():
                models[n], took[n] = m, m.core.fitted.seconds
        try:
            if together:
                boosted(together)
        except Exception:                # find out which learner fails
            for n in together:
                try:
                    boosted([n])
                except Exception as e:
                    errors[n] = str(e)
    linear = None
    for name in names:
        family, params_of = families[name]
        t0 = time.time()
        try:                             # a failing learner is reported, not fatal
            if name in errors:
                raise RuntimeError(errors[name])
            if family == "forest":
                x = materialize(pr.matrix(train).select(*pr.features, pr.target))
                models[name] = pr.trees(fit_forest(x, pr.features, pr.target, tree_params(params_of, len(pr.features)), params_of["trees"]))
            elif family == "linear":
                if linear is None:
                    linear = prepare(train, roles, keep, "onehot")
                    linear_x = linear.matrix(train).persist()
                models[name] = fit_linear(linear, linear_x, name, params_of)
            secs = took.get(name, time.time() - t0)
            met = regression_metrics(models[name].transform(valid), roles.target, "prediction").first().asDict()
            rows.append((name, family, met["r2"], met["mae"], met["rmse"], met["mape"], met["medae"],
                         json.dumps({k: str(v) for k, v in params_of.items()}), secs, None, importances(models[name], valid)))
        except Exception as e:
            models.pop(name, None)
            rows.append((name, family, None, None, None, None, None, None, time.time() - t0, str(e), []))
    if linear is not None:
        linear_x.unpersist()
    schema = ("model string, family string, r2 double, mae double, rmse double, mape double, medae double, "
              "params string, seconds double, error string, importances array<struct<feature:string,importance:double>>")
    return spark.createDataFrame(rows, schema), models


# The reference's two search spaces. A pair (low, high) of floats is a uniform
# draw, of integers a draw without ``high``; a list is a choice.
BOOSTING_SPACE = {"rounds": (100, 500), "depth": (3, 10), "rate": (0.01, 0.21), "rows": (0.6, 1.0), "columns": (0.5, 1.0), "min_child": (1, 10)}
SYMMETRIC_SPACE = {"depth": [6, 7, 8, 9, 10], "rate": [0.01, 0.015, 0.02, 0.03, 0.05], "l2": [1, 3, 5, 7, 10], "noise": [0.5, 1, 2, 4],
                   "temperature": [0, 0.5, 1, 2], "borders": [128, 254], "min_child": [1, 5, 10, 20]}


def draw(space: dict, trials: int, seed: int = 42) -> list[dict]:
    """Seeded parameter maps of a search space."""
    rng = random.Random(seed)

    def one(v):
        if isinstance(v, list):
            return rng.choice(v)
        return rng.uniform(*v) if isinstance(v[0], float) else rng.randrange(*v)
    return [{k: one(v) for k, v in space.items()} for _ in range(trials)]


_SEARCH = "trial int, params string, cv_r2 double, cv_std double, rounds int, best boolean, test_r2 double, test_mae double"


def _best_on_test(pr: Prepared, rows: list, core, roles: Roles, test: DataFrame, best: list) -> DataFrame:
    m = regression_metrics(pr.trees(core).transform(test), roles.target, "prediction", median=None).first()
    best[5:] = [True, m["r2"], m["mae"]]
    return test.sparkSession.createDataFrame([tuple(r) for r in rows], _SEARCH)


def random_search(train: DataFrame, test: DataFrame, trials: int = 30, folds: int = 3, space: dict | None = None, seed: int = 42,
                  idx_col: str = "row_idx", roles: Roles = FLIGHT_ROLES, together: int = 30) -> DataFrame:
    """``trials`` seeded parameter maps of boosted trees, each scored by walk-forward folds
    over the time-ordered training rows (position ``idx_col``); the test rows are used once, by
    the best map, fitted on all training rows. The fits of ``together`` maps share their rounds.
    Returns trial, params, mean and deviation of the folds' R², rounds, best, test_r2 and
    test_mae (best trial only)."""
    maps = draw(space or BOOSTING_SPACE, trials, seed)
    blocks = walk_forward_blocks(train, train.count(), folds, idx_col)
    pr = prepare(blocks.where(F.col("block") < 0).drop("block"), roles, keep=[idx_col])
    x = materialize(pr.matrix(blocks.drop("block")).select(*pr.features, pr.target, idx_col).join(blocks.select(idx_col, (F.col("block") + 1).alias("_part")), idx_col))
    binning = B.fit_binning(x.where("_part = 0"), pr.features)
    table = B.row_blocks(x, binning, pr.target, part="_part")
    moments = {r["_part"]: r["v"] for r in x.groupBy("_part").agg(F.var_pop(pr.target).alias("v")).collect()}      # one row per fold
    rows = []
    for lo in range(0, trials, together):
        part = maps[lo:lo + together]
        fits = [B.Fit(f"{lo + t}", TreeParams(seed=seed, **p), tuple(range(k + 1)), (k + 1,)) for t, p in enumerate(part) for k in range(folds)]
        done = B.fit_all(table, binning.sizes, fits)
        for t, p in enumerate(part):
            # the loss of all rounds, not of the best one: the fold is for comparing maps
            r2 = [1.0 - done[t * folds + k].losses[-1] / moments[k + 1] for k in range(folds)]
            rows.append([lo + t, json.dumps(p), float(np.mean(r2)), float(np.std(r2)), p["rounds"], False, None, None])
    best = max(rows, key=lambda r: (r[2], -r[0]))
    core = B.boost(x, pr.features, pr.target, [B.Fit("best", TreeParams(seed=seed, **maps[best[0]]), tuple(range(folds + 1)))], part="_part")[0]
    return _best_on_test(pr, rows, core, roles, test, best)


def patience_search(train: DataFrame, test: DataFrame, trials: int = 40, space: dict | None = None, rounds: int = 2000, patience: int = 100,
                    final_rounds: int = 3000, seed: int = 42, idx_col: str = "row_idx", roles: Roles = FLIGHT_ROLES, together: int = 40) -> DataFrame:
    """L8, second search: ``trials`` maps of symmetric trees, each fitted on the first 80 % of
    the time-ordered training rows and stopped on the last 20 %, whose R² ranks the maps; the
    best map is fitted on all training rows with the number of rounds that it had, scaled up by
    a quarter like its rows, and scored once on the test rows."""
    maps = draw(space or SYMMETRIC_SPACE, trials, seed)
    n = train.count()
    tagged = train.withColumn("_part", (F.col(idx_col) >= int(n * 0.8)).cast("int"))
    pr = prepare(tagged.where("_part = 0").drop("_part"), roles, keep=[idx_col])
    x = materialize(pr.matrix(train).select(*pr.features, pr.target, idx_col).join(tagged.select(idx_col, "_part"), idx_col))
    variance = x.where("_part = 1").agg(F.var_pop(pr.target)).first()[0]
    rows = []
    for borders in sorted({p["borders"] for p in maps}):
        binning = B.fit_binning(x.where("_part = 0"), pr.features, min(borders, B.MAX_EDGES))
        table = B.row_blocks(x, binning, pr.target, part="_part")
        chosen = [t for t, p in enumerate(maps) if p["borders"] == borders]
        for lo in range(0, len(chosen), together):
            part = chosen[lo:lo + together]
            fits = [B.Fit(str(t), TreeParams(rounds=rounds, symmetric=True, patience=patience, seed=seed, **{k: v for k, v in maps[t].items() if k != "borders"}), (0,), (1,)) for t in part]
            for t, d in zip(part, B.fit_all(table, binning.sizes, fits)):
                rows.append([t, json.dumps(maps[t]), 1.0 - min(d.losses) / variance, 0.0, d.rounds, False, None, None])
    rows.sort()
    best = max(rows, key=lambda r: (r[2], -r[0]))
    p = maps[best[0]]
    fit = B.Fit("best", TreeParams(rounds=max(1, min(final_rounds, best[4] * 5 // 4)), symmetric=True, seed=seed, **{k: v for k, v in p.items() if k != "borders"}), (0, 1))
    core = B.boost(x, pr.features, pr.target, [fit], part="_part", max_edges=min(p["borders"], B.MAX_EDGES))[0]
    return _best_on_test(pr, rows, core, roles, test, best)


def per_stratum_models(train: DataFrame, test: DataFrame, stratum: str, params: TreeParams, log_strata: Sequence[str] = (),
                       roles: Roles = FLIGHT_ROLES, valid_share: int = 0) -> DataFrame:
    """L9 (+E11): one model per value of ``stratum``, any number of them, in one grouped fit:
    every row belongs to the fit of its stratum alone. Strata in ``log_strata`` learn log1p of
    the target. ``valid_share``: one in so many training rows is kept for stopping by patience.
    Returns stratum, target and prediction of the test rows whose stratum was trained on.

    The driver holds the models (strata × rounds × leaves); rows without stratum are left out."""
    spark = train.sparkSession
    y = roles.target
    log = F.col(stratum).isin(list(log_strata)) if log_strata else F.lit(False)
    pr = prepare(train, roles, keep=() if stratum in roles.cat else (stratum,))
    names = [r[0] for r in train.where(F.col(stratum).isNotNull()).select(stratum).distinct().orderBy(stratum).collect()]     # one row per model
    codes = spark.createDataFrame([(n, i) for i, n in enumerate(names)], f"_stratum {train.schema[stratum].dataType.simpleString()}, _code int")
    held = (hash_fold([*pr.features, y], valid_share) == 0).cast("int") if valid_share else F.lit(0)

    def rows(df, part):
        x = pr.matrix(df).join(F.broadcast(codes), F.col(stratum) == F.col("_stratum"))      # one row per model
        return x.withColumn("_learn", F.when(log, F.log1p(y)).otherwise(F.col(y))).withColumn("_part", part)
    x = materialize(rows(train, F.col("_code") * 2 + held).select(*pr.features, "_learn", "_part"))
    fits = [B.Fit(str(n), params, (2 * i,), (2 * i + 1,) if valid_share else ()) for i, n in enumerate(names)]
    models = B.boost(x, pr.features, "_learn", fits, part="_part", disjoint=True)
    scored = B.transform_by(models, rows(test, F.col("_code")), "_part", [stratum, y])
    return scored.select(F.col(stratum).alias("stratum"), y, F.when(log, F.expm1("prediction")).otherwise(F.col("prediction")).alias("prediction"))


def two_stage_predictions(train: DataFrame, test: DataFrame, stage: str, params: dict, folds: int = 5, idx_col: str = "row_idx",
                          roles: Roles = FLIGHT_ROLES) -> DataFrame:
    """Predict a column that is not known in time, then use the prediction as a feature.

    The first stage is fitted on all training rows and once without each fold, all in the same
    rounds; the second stage in four variants, together again: with the actual column, with its
    in-sample prediction, with its out-of-fold prediction, without. At test time there is only
    the prediction. One in ten rows of what a fit learns from is kept to stop it by patience.
    Returns ``idx_col``, target and one prediction column per variant for the test rows."""
    y = roles.target
    pr = prepare(train, roles, keep=[idx_col, stage])
    p = tree_params(params, len(pr.features))
    part = (F.col("_fold") * 2 + (hash_fold([idx_col], 10, seed=7) == 0).cast("int")).alias("_part")
    x = pr.matrix(train).select(*pr.features, y, stage, idx_col).withColumn("_fold", hash_fold([idx_col], folds))
    x = materialize(x.select("*", part))
    fits = [B.Fit("all", p, tuple(2 * k for k in range(folds)), tuple(2 * k + 1 for k in range(folds)))]
    fits += [B.Fit(str(k), p, tuple(2 * j for j in range(folds) if j != k), tuple(2 * j + 1 for j in range(folds) if j != k)) for k in range(folds)]
    whole, *without = B.boost(x, pr.features, stage, fits, part="_part")
    keep = [*pr.features, y, idx_col]
    known = whole.transform(x, [*keep, "_fold", "_part", stage], "predicted")
    oof = B.transform_by(without, x, "_fold", [idx_col], "out_of_fold")
    second = materialize(known.join(oof, idx_col).select(*keep, F.col(stage).alias("actual"), "predicted", "out_of_fold", (F.col("_part") % 2).alias("_part")))
    variants = ("actual", "predicted", "out_of_fold", "none")
    n = len(pr.features)
    fits = [B.Fit(v, p, (0,), (1,), tuple(range(n)) + ((n + i,) if v != "none" else ())) for i, v in enumerate(variants)]
    models = B.boost(second, [*pr.features, *variants[:3]], y, fits, part="_part")
    out = whole.transform(pr.matrix(test), keep, "actual").withColumn("predicted", F.col("actual")).withColumn("out_of_fold", F.col("actual"))
    inputs = [*pr.features, *variants[:3]]
    kept = [idx_col, y]
    for v, m in zip(variants, models):
        out = m.transform(out, [*dict.fromkeys([*inputs, *kept])], f"by_{v}")
        kept.append(f"by_{v}")
    return out.select(*kept)


def nonnegative_blend_weights(df: DataFrame, y: str, preds: Sequence[str]) -> list[float]:
    """Least-squares weights ≥ 0 from the k×k Gram matrix (one aggregate;
    the k×k solve runs on the driver, k = number of models)."""
    k = len(preds)
    aggs = [F.sum(F.col(a) * F.col(b)).alias(f"g{i}_{j}") for i, a in enumerate(preds) for j, b in enumerate(preds)]
    aggs += [F.sum(F.col(a) * F.col(y)).alias(f"b{i}") for i, a in enumerate(preds)]
    row = scalars(df.agg(*aggs))
    G = np.array([[row[f"g{i}_{j}"] for j in range(k)] for i in range(k)])
    b = np.array([row[f"b{i}"] for i in range(k)])
    return _nnls(G, b).tolist()


def _nnls(G: np.ndarray, b: np.ndarray, iters: int = 5000) -> np.ndarray:
    """Projected coordinate descent for min ½wᵀGw − bᵀw, w ≥ 0 (k tiny)."""
    w = np.zeros(len(b))
    for _ in range(iters):
        prev = w.copy()
        for i in range(len(b)):
            if G[i, i] > 0:
                w[i] = max(0.0, w[i] + (b[i] - G[i] @ w) / G[i, i])
        if np.max(np.abs(w - prev)) < 1e-12:
            break
    return w


def ridge_stack_weights(df: DataFrame, y: str, preds: Sequence[str], alphas=(0.1, 1.0, 10.0, 100.0, 1000.0),
                        fold_col: str = "fold") -> tuple[float, list[float], float]:
    """Ridge stacker over out-of-fold base predictions; alpha chosen by
    fold-wise validation from per-fold Gram matrices (k×k each)."""
    k = len(preds)
    cols = [F.lit(1.0).alias("_one")] + [F.col(p) for p in preds]
    names = ["_one", *preds]
    aggs = [F.sum(F.col(a) * F.col(b)).alias(f"g{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names)]
    aggs += [F.sum(F.col(a) * F.col(y)).alias(f"b{i}") for i, a in enumerate(names)]
    aggs += [F.sum(F.col(y) * F.col(y)).alias("yy")]
    per_fold = df.select(fold_col, y, *cols).groupBy(fold_col).agg(*aggs).collect()  # one row per fold
    n = k + 1

    def mats(rows):
        G = sum(np.array([[r[f"g{i}_{j}"] for j in range(n)] for i in range(n)]) for r in rows)
        b = sum(np.array([r[f"b{i}"] for i in range(n)]) for r in rows)
        return G, b, sum(r["yy"] for r in rows)

    def solve(G, b, a):
        reg = a * np.eye(n)
        reg[0, 0] = 0.0  # intercept not penalised
        return np.linalg.solve(G + reg, b)
    best = None
    for a in alphas:
        sse = 0.0
        for fr in per_fold:
            G, b, _ = mats([r for r in per_fold if r[fold_col] != fr[fold_col]])
            w = solve(G, b, a)
            Gv, bv, yy = mats([fr])
            sse += float(yy - 2 * w @ bv + w @ Gv @ w)
        if best is None or sse < best[0]:
            best = (sse, a)
    G, b, _ = mats(per_fold)
    w = solve(G, b, best[1])
    return float(best[1]), w[1:].tolist(), float(w[0])


def permutation_importance(model: FareModel, raw: DataFrame, cols: Sequence[str], target: str | None = None,
                           seed: int = 42) -> DataFrame:
    """L14 for any model: increase of test MAE when one raw column is
    randomly permuted across rows. The permutation is exact and
    distributed: recipients are indexed in their own order, donors in a
    seeded hash order (both by the distributed row index), and values move
    by an equi-join on the position."""
    from faresight.operators.prefix import row_index_and_count, with_row_index
    roles = model.prep.roles
    target = target or roles.target
    cols = list(cols)
    used = {*roles.cat, *roles.num, roles.date, roles.target, target, *cols, *model.prep.keep}
    base, _ = row_index_and_count(raw, [F.xxhash64(*[F.col(c) for c in raw.columns]), *[F.col(c) for c in raw.columns]],
                                  "_pos", keep=[c for c in raw.columns if c in used])

    def mae(df):
        scored = materialize(model.transform(df).select(target, "prediction"))      # the join's files go before the next one
        out = regression_metrics(scored, target, "prediction", median=None).first()["mae"]
        drop_table(scored)
        return out
    ref = mae(base.drop("_pos"))
    rows = []
    for i, c in enumerate(cols):
        donors = with_row_index(base.select("_pos", F.col(c).alias("_donor")),
                                [F.xxhash64(F.lit(seed + i), F.col("_pos")), F.col("_pos")], "_dpos")
        shuffled = (base.join(donors.select(F.col("_dpos").alias("_pos"), "_donor"), "_pos")
                    .withColumn(c, F.col("_donor")).drop("_donor", "_pos"))
        rows.append((c, float(mae(shuffled) - ref), float(ref)))
        drop_table(donors)
    spark = raw.sparkSession
    return spark.createDataFrame(rows, "feature string, mae_increase double, base_mae double")
