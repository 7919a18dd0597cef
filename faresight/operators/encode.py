"""Encoders fitted on training data only.

Each is a ``pyspark.ml`` Estimator whose ``fit`` aggregates the training
frame into a small state table (value → statistic), checkpointed, and whose
Model applies it by an equi-join. The join broadcasts the state only when
its bytes, measured at fit time, fit a bound together with the other states
of the transformation; otherwise it is a shuffle join. Nothing is collected to the driver except per-column
scalars (means, deviations) whose number is the number of columns.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from faresight.functions.scalar import as_category, expm1, log1p
from faresight.operators.prefix import with_row_index
from faresight.operators.profile import relative_frequency, scalars, unpivot
from faresight.operators.split import hash_fold, row_hash
from faresight.session import materialize

# The states that one transformation broadcasts have at most this many bytes together.
STATE_BROADCAST_BYTES = 128 << 20
BUCKET_ROWS = 1 << 14     # rows of a bucket of the ordered statistics


def _sizes(state: DataFrame) -> dict[str, int]:
    """Bytes of each column's state: its text and 32 a row. One row per encoded column."""
    n = F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + 32)
    return {r["column"]: r["n"] for r in state.groupBy("column").agg(n.alias("n")).collect()}


def _lookup(state: DataFrame, col: str, value_cols: dict[str, str], small: bool) -> DataFrame:
    lk = state.where(F.col("column") == col).select(F.col("value").alias("_v"),
                                                      *[F.col(s).alias(o) for s, o in value_cols.items()])
    return F.broadcast(lk) if small else lk


def _apply(df: DataFrame, state: DataFrame, sizes: dict, cols: Sequence[str], value_cols_fn, fill_fn) -> DataFrame:
    out, small, left = df, set(), STATE_BROADCAST_BYTES
    for c in sorted(cols, key=lambda c: sizes.get(c, 0)):       # the smallest first, while they fit together
        left -= sizes.get(c, 0)
        if left >= 0:
            small.add(c)
    for c in cols:
        vc = value_cols_fn(c)
        lk = _lookup(state, c, vc, c in small)
        out = out.join(lk, out[c].cast("string").eqNullSafe(lk["_v"]), "left").drop("_v")
        out = out.withColumns({o: fill_fn(c, o) for o in vc.values()})
    return out


class _Persist:
    """Save/load of a state table plus JSON attributes."""

    _attrs: tuple[str, ...] = ()

    def save(self, path: str) -> None:
        self.state.write.mode("overwrite").parquet(os.path.join(path, "state"))
        spark = self.state.sparkSession
        meta = json.dumps({a: getattr(self, a) for a in self._attrs})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(os.path.join(path, "meta"))

    @classmethod
    def load(cls, spark: SparkSession, path: str):
        state = spark.read.parquet(os.path.join(path, "state"))
        meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
        return cls(state=state, **meta)


# E5 -----------------------------------------------------------------------------------
class FrequencyEncoder(Estimator):
    """Relative frequency of each value on train (nulls excluded); unseen → 0."""

    def __init__(self, inputCols: Sequence[str], suffix: str = "_freq"):
        super().__init__()
        self.inputCols, self.suffix = list(inputCols), suffix

    def _fit(self, df: DataFrame) -> "FrequencyEncoderModel":
        state = materialize(relative_frequency(df, self.inputCols))
        return FrequencyEncoderModel(state=state, inputCols=self.inputCols, suffix=self.suffix, sizes=_sizes(state))


class FrequencyEncoderModel(Model, _Persist):
    _attrs = ("inputCols", "suffix", "sizes")

    def __init__(self, state: DataFrame, inputCols, suffix="_freq", sizes=None):
        super().__init__()
        self.state, self.inputCols, self.suffix = state, list(inputCols), suffix
        self.sizes = sizes if sizes is not None else _sizes(state)

    @property
    def freq_maps(self) -> DataFrame:
        """Public view of the fitted maps: (column, value, count, freq)."""
        return self.state

    def _transform(self, df: DataFrame) -> DataFrame:
        return _apply(df, self.state, self.sizes, self.inputCols, lambda c: {"freq": f"{c}{self.suffix}"},
                      lambda c, o: F.coalesce(F.col(o), F.lit(0.0)))


# E9 / F20 ------------------------------------------------------------------------------
class OrdinalEncoder(Estimator):
    """Alphabetical codes of the training categories; unseen/null → −1.

    Codes come from a distributed global index over the sorted distinct
    (column, value) pairs minus each column's first index.
    """

    def __init__(self, inputCols: Sequence[str], suffix: str = "_code", unknown: int = -1):
        super().__init__()
        self.inputCols, self.suffix, self.unknown = list(inputCols), suffix, unknown

    def _fit(self, df: DataFrame) -> "OrdinalEncoderModel":
        pairs = (unpivot(df, [], self.inputCols, "column", "value", cast="string")
                 .where(F.col("value").isNotNull()).distinct())
        idx = with_row_index(pairs, [F.col("column"), F.col("value")], "_g")
        first = idx.groupBy("column").agg(F.min("_g").alias("_g0"))
        state = materialize(idx.join(F.broadcast(first), "column")  # one row per column
                            .select("column", "value", (F.col("_g") - F.col("_g0")).cast("int").alias("code")))
        return OrdinalEncoderModel(state=state, inputCols=self.inputCols, suffix=self.suffix, unknown=self.unknown,
                                   sizes=_sizes(state))


class OrdinalEncoderModel(Model, _Persist):
    _attrs = ("inputCols", "suffix", "unknown", "sizes")

    def __init__(self, state, inputCols, suffix="_code", unknown=-1, sizes=None):
        super().__init__()
        self.state, self.inputCols, self.suffix, self.unknown = state, list(inputCols), suffix, unknown
        self.sizes = sizes if sizes is not None else _sizes(state)

    def _transform(self, df: DataFrame) -> DataFrame:
        return _apply(df, self.state, self.sizes, self.inputCols, lambda c: {"code": f"{c}{self.suffix}"},
                      lambda c, o: F.coalesce(F.col(o), F.lit(self.unknown)))


# E10 ------------------------------------------------------------------------------------
def _shrunk(n, mean, var, gmean, gvar):
    """Empirical-Bayes shrinkage: λ = n·var_y / (n·var_y + var_c); λ undefined → global mean."""
    den = n * gvar + var
    lam = F.when(den == 0, F.lit(None)).otherwise(n * gvar / den)
    return F.coalesce(lam * mean + (F.lit(1.0) - lam) * gmean, gmean)


def _moments(y) -> list:
    """(n, mean, M2) of a column; Spark's variance merges them without cancellation."""
    return [F.count(y).alias("n"), F.avg(y).alias("m"), (F.var_pop(y) * F.count(y)).alias("m2")]


def _merged(parts: str, without) -> Column:
    """(n, m, m2) of the entries of ``parts`` whose fold is not ``without``."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("m2"))

    def add(a, b):
        n = a["n"] + b["n"]
        d = b["m"] - a["m"]
        return F.struct(n.alias("n"), F.when(a["n"] == 0, b["m"]).otherwise(a["m"] + d * b["n"] / n).alias("m"),
                        (a["m2"] + b["m2"] + F.when(a["n"] == 0, 0.0).otherwise(d * d * a["n"] * b["n"] / n)).alias("m2"))
    return F.aggregate(F.array_sort(F.filter(parts, lambda p: p["_fold"] != without)), zero, add)


class TargetEncoder(Estimator):
    """Smoothed category mean of the target with "auto" shrinkage; unseen →
    global mean. ``fit_transform_oof`` gives out-of-fold encodings for the
    training rows (each row encoded from the other folds)."""

    def __init__(self, inputCols: Sequence[str], target: str, suffix: str = "_te", folds: int = 5, seed: int = 42,
                 fold_cols: Sequence[str] | None = None):
        """``fold_cols``: key columns that decide a row's fold by the portable hash; without
        them the whole row does."""
        super().__init__()
        self.fold_cols = list(fold_cols) if fold_cols else None
        self.inputCols, self.target, self.suffix, self.folds, self.seed = list(inputCols), target, suffix, folds, seed

    def _stats(self, df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        y = F.col(self.target).cast("double")
        long = unpivot(df.select(*self.inputCols, *extra, y.alias("_y")), ["_y", *extra], self.inputCols,
                       "column", "value", cast="string")
        return long.groupBy("column", "value", *extra).agg(*_moments("_y"))

    def _fit(self, df: DataFrame) -> "TargetEncoderModel":
        g = scalars(df.agg(F.avg(self.target).alias("m"), F.var_pop(self.target).alias("v")))
        st = self._stats(df.where(F.col(self.target).isNotNull()))
        state = materialize(st.where(F.col("value").isNotNull()).select(
            "column", "value", _shrunk(F.col("n"), F.col("m"), F.col("m2") / F.col("n"), F.lit(g["m"]), F.lit(g["v"])).alias("enc")))
        return TargetEncoderModel(state=state, inputCols=self.inputCols, suffix=self.suffix, global_mean=g["m"],
                                  sizes=_sizes(state))

    def fit_transform_oof(self, df: DataFrame) -> tuple["TargetEncoderModel", DataFrame]:
        model = self.fit(df)
        fold = hash_fold(self.fold_cols or df.columns, self.folds, self.seed, portable=bool(self.fold_cols))
        tagged = df.withColumn("_fold", fold)
        y = F.col(self.target)
        present = tagged.where(y.isNotNull())
        fold_ids = F.explode(F.array(*[F.lit(i) for i in range(self.folds)]))
        # statistics of all folds but one, merged from the per-fold (n, mean, M2): at most one entry per fold
        parts = present.groupBy("_fold").agg(*_moments(y.cast("double"))).agg(F.collect_list(F.struct("_fold", "n", "m", "m2")).alias("parts"))
        gcomp = parts.select(fold_ids.alias("_fold"), "parts").select("_fold", _merged("parts", F.col("_fold")).alias("g")).select(
            "_fold", F.col("g.m").alias("gm"), F.when(F.col("g.n") > 0, F.col("g.m2") / F.col("g.n")).alias("gv"))
        st = self._stats(present, ["_fold"]).groupBy("column", "value").agg(F.collect_list(F.struct("_fold", "n", "m", "m2")).alias("parts"))
        comp = st.select("column", "value", "parts", fold_ids.alias("_fold")).select(
            "column", "value", "_fold", _merged("parts", F.col("_fold")).alias("c")).join(F.broadcast(gcomp), "_fold")  # one row per fold
        enc = F.when(F.col("c.n") > 0, _shrunk(F.col("c.n"), F.col("c.m"), F.col("c.m2") / F.col("c.n"), F.col("gm"), F.col("gv"))) \
            .otherwise(F.col("gm"))
        state = materialize(comp.select("column", "value", "_fold", enc.alias("enc")))
        out = tagged
        for c in self.inputCols:
            lk = state.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("_fold").alias("_f"),
                                                          F.col("enc").alias(f"{c}{self.suffix}"))
            out = out.join(lk, (out[c].cast("string") == lk["_v"]) & (out["_fold"] == lk["_f"]), "left").drop("_v", "_f")
        gfill = gcomp.select("_fold", F.col("gm").alias("_gm"))
        out = out.join(F.broadcast(gfill), "_fold", "left")
        out = out.withColumns({f"{c}{self.suffix}": F.coalesce(F.col(f"{c}{self.suffix}"), F.col("_gm"))
                               for c in self.inputCols}).drop("_gm", "_fold")
        return model, out


class TargetEncoderModel(Model, _Persist):
    _attrs = ("inputCols", "suffix", "global_mean", "sizes")

    def __init__(self, state, inputCols, suffix="_te", global_mean=0.0, sizes=None):
        super().__init__()
        self.state, self.inputCols, self.suffix, self.global_mean = state, list(inputCols), suffix, global_mean
        self.sizes = sizes if sizes is not None else _sizes(state)

    def _transform(self, df: DataFrame) -> DataFrame:
        return _apply(df, self.state, self.sizes, self.inputCols, lambda c: {"enc": f"{c}{self.suffix}"},
                      lambda c, o: F.coalesce(F.col(o), F.lit(self.global_mean)))


class OrderedTargetEncoder(Estimator):
    """Ordered target statistics: a training row's value is the smoothed target mean of the
    rows of its category that come before it in a seeded permutation, so no row sees its own
    target; other rows get the statistics of all training rows.

    ``keys``: columns that tell the rows apart; they seed the permutation (portable hash, ties by
    the keys). ``strength``: weight of the prior, the mean target. A null category is the category
    "nan"; rows without a target add nothing. The running sums are distributed prefix sums, so
    a category with a third of all rows is spread over many tasks."""

    def __init__(self, inputCols: Sequence[str], target: str, keys: Sequence[str], strength: float = 1.0, suffix: str = "_ots", seed: int = 42):
        super().__init__()
        self.inputCols, self.target, self.keys = list(inputCols), target, list(keys)
        self.strength, self.suffix, self.seed = strength, suffix, seed

    def _long(self, df: DataFrame) -> DataFrame:
        y = F.col(self.target).cast("decimal(38,6)")       # sums that no order of addition changes
        x = df.select(*self.keys, *self.inputCols, F.coalesce(y, F.lit(0).cast("decimal(38,6)")).alias("_y"), y.isNotNull().cast("long").alias("_n"))
        return unpivot(x, [*self.keys, "_y", "_n"], self.inputCols, "column", "value", cast="string") \
            .withColumn("value", F.coalesce("value", F.lit("nan")))

    def _prior(self, df: DataFrame) -> float:
        y = F.col(self.target).cast("decimal(38,6)")
        return scalars(df.agg(F.try_divide(F.sum(y).cast("double"), F.count(y)).alias("m")))["m"] or 0.0

    def _fit(self, df: DataFrame) -> "OrderedTargetModel":
        prior, a = self._prior(df), self.strength
        state = materialize(self._long(df).groupBy("column", "value").agg(((F.sum("_y").cast("double") + a * prior) / (F.sum("_n") + a)).alias("enc")))
        return OrderedTargetModel(state, self.inputCols, self.suffix, prior)

    def fit_transform_ordered(self, df: DataFrame) -> tuple["OrderedTargetModel", DataFrame]:
        """The model for other rows, and the training rows with their ordered statistics.

        The permutation is cut into buckets by ranges of its hash, about ``BUCKET_ROWS`` rows
        each whatever the categories. Sums by (column, category, bucket) give each bucket a row
        with what lies before it, which enters the running sums as its first one. So rows are
        moved once, as they are, and every column's sums run in place."""
        prior, a = self._prior(df), self.strength
        buckets = min(1 << 20, max(1, -(-df.count() // BUCKET_ROWS)))
        y = F.col(self.target).cast("decimal(38,6)")
        x = df.withColumns({"_h": row_hash(self.keys, self.seed, portable=True), "_y": F.coalesce(y, F.lit(0).cast("decimal(38,6)")), "_n": y.isNotNull().cast("long"),
                            **{f"_v{i}": F.coalesce(F.col(c).cast("string"), F.lit("nan")) for i, c in enumerate(self.inputCols)}})
        x = x.withColumn("_b", F.shiftright(F.shiftright("_h", 40) * F.lit(buckets), 20))       # the hash has 60 bits
        values = [f"_v{i}" for i in range(len(self.inputCols))]
        totals = materialize(unpivot(x.select("_b", "_y", "_n", *values), ["_b", "_y", "_n"], values, "column", "value", cast="string")
                             .groupBy("column", "value", "_b").agg(F.sum("_y").alias("_y"), F.sum("_n").alias("_n")))
        names = F.create_map(*[F.lit(z) for i, c in enumerate(self.inputCols) for z in (f"_v{i}", c)])
        state = materialize(totals.groupBy(names[F.col("column")].alias("column"), "value").agg(((F.sum("_y").cast("double") + a * prior) / (F.sum("_n") + a)).alias("enc")))
        before = Window.partitionBy("column", "value").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)      # at most a row per bucket
        first = totals.select("_b", "column", "value", F.sum("_y").over(before).alias("_y"), F.sum("_n").over(before).alias("_n")).where(F.col("_n").isNotNull())
        first = first.select("_b", "_y", "_n", F.lit(-1).cast("long").alias("_h"), *[F.when(F.col("column") == v, F.col("value")).alias(v) for v in values])
        both = x.withColumn("_row", F.lit(True)).unionByName(first, allowMissingColumns=True)
        shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = both.repartitionByRange(max(shuffled, buckets // 8), "_b")        # even, and a fixed number: a row is wider in its sorts than in a shuffle that could be coalesced
        encoded = [f"{c}{self.suffix}" for c in self.inputCols]
        for v, e in zip(values, encoded):       # the partitions by bucket hold every window whole
            w = Window.partitionBy("_b", v).orderBy("_h", *self.keys).rowsBetween(Window.unboundedPreceding, -1)
            out = out.withColumn(e, (F.coalesce(F.sum("_y").over(w), F.lit(0)).cast("double") + a * prior) / (F.coalesce(F.sum("_n").over(w), F.lit(0)) + a)).drop(v)
        same = Window.partitionBy("_b", *self.keys)        # rows with equal keys share the greatest value
        kept = F.col("_row").isNotNull()
        for k in self.keys:
            kept = kept & F.col(k).isNotNull()
        out = out.where(kept).withColumns({e: F.max(e).over(same) for e in encoded})
        model = OrderedTargetModel(state, self.inputCols, self.suffix, prior)
        return model, out.select(*df.columns, *encoded)


class OrderedTargetModel(TargetEncoderModel):
    def __init__(self, state, inputCols, suffix="_ots", global_mean=0.0, sizes=None):
        super().__init__(state, inputCols, suffix, global_mean, sizes)

    def _transform(self, df: DataFrame) -> DataFrame:
        plain = {c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in self.inputCols}
        named = df.withColumns({f"_plain_{c}": v for c, v in plain.items()})
        state = self.state.withColumn("column", F.concat(F.lit("_plain_"), F.col("column")))
        out = _apply(named, state, {f"_plain_{c}": n for c, n in self.sizes.items()}, [f"_plain_{c}" for c in self.inputCols],
                     lambda c: {"enc": f"{c[7:]}{self.suffix}"}, lambda c, o: F.coalesce(F.col(o), F.lit(self.global_mean)))
        return out.drop(*[f"_plain_{c}" for c in self.inputCols])


# E8 -------------------------------------------------------------------------------------
class PopulationScaler(Estimator):
    """(x − mean) / population std per column; a constant column is only centred."""

    def __init__(self, inputCols: Sequence[str], suffix: str = "_z"):
        super().__init__()
        self.inputCols, self.suffix = list(inputCols), suffix

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        # one group per column: an aggregate with two moments of every column side by side is too wide to compile well
        rows = unpivot(df.select(*self.inputCols), [], self.inputCols, cast="double").groupBy("column").agg(
            F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).collect()
        got = {r["column"]: (r["m"], r["s"]) for r in rows}
        stats = {c: got.get(c, (None, None)) for c in self.inputCols}
        return PopulationScalerModel(stats, self.suffix)


class PopulationScalerModel(Model):
    def __init__(self, stats: dict, suffix: str = "_z"):
        super().__init__()
        self.stats, self.suffix = stats, suffix

    def _transform(self, df: DataFrame) -> DataFrame:
        def z(c, m, s):
            scale = s if s else 1.0
            return (F.col(c) - F.lit(m)) / F.lit(scale)
        return df.withColumns({f"{c}{self.suffix}": z(c, m, s) for c, (m, s) in self.stats.items()})


# E7 / E12 -------------------------------------------------------------------------------
def one_hot_stages(cat_cols: Sequence[str], prefix: str = "oh_") -> list:
    """One-hot with unknown → all zeros: the indexer keeps unseen values in an
    extra last slot, which ``dropLast`` removes."""
    idx = StringIndexer(inputCols=list(cat_cols), outputCols=[f"{prefix}{c}_idx" for c in cat_cols], handleInvalid="keep",
                        stringOrderType="alphabetAsc")        # all columns in one pass
    ohe = OneHotEncoder(inputCols=[f"{prefix}{c}_idx" for c in cat_cols],
                        outputCols=[f"{prefix}{c}_vec" for c in cat_cols], dropLast=True)
    return [idx, ohe]


def index_stages(cat_cols: Sequence[str], prefix: str = "ix_") -> list:
    """Category codes fitted on train (alphabetical), unseen → an extra code."""
    return [StringIndexer(inputCols=list(cat_cols), outputCols=[f"{prefix}{c}" for c in cat_cols], handleInvalid="keep",
                          stringOrderType="alphabetAsc")]


def feature_pipeline(cat_cols: Sequence[str], num_cols: Sequence[str], encoding: str = "index",
                     features_col: str = "features") -> Pipeline:
    """The type-split column pipeline ending in one feature vector."""
    if encoding == "onehot":
        stages = one_hot_stages(cat_cols)
        enc_cols = [f"oh_{c}_vec" for c in cat_cols]
    else:
        stages = index_stages(cat_cols)
        enc_cols = [f"ix_{c}" for c in cat_cols]
    asm = VectorAssembler(inputCols=[*enc_cols, *num_cols], outputCol=features_col, handleInvalid="keep")
    return Pipeline(stages=[*stages, asm])


# E11 ------------------------------------------------------------------------------------
class LogTargetRegressor(Estimator):
    """Fit the wrapped regressor on log1p(label); predict expm1(prediction)."""

    def __init__(self, regressor, labelCol: str, predictionCol: str = "prediction"):
        super().__init__()
        self.regressor, self.labelCol, self.predictionCol = regressor, labelCol, predictionCol

    def _fit(self, df: DataFrame) -> "LogTargetModel":
        reg = self.regressor.copy().setLabelCol("_log_label").setPredictionCol("_log_pred")
        m = reg.fit(df.withColumn("_log_label", log1p(self.labelCol)))
        return LogTargetModel(m, self.predictionCol)


class LogTargetModel(Model):
    def __init__(self, inner, predictionCol: str):
        super().__init__()
        self.inner, self.predictionCol = inner, predictionCol

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.inner.transform(df).withColumn(self.predictionCol, expm1("_log_pred")).drop("_log_pred")


# F21 ------------------------------------------------------------------------------------
def inverse_sqrt_weight(df: DataFrame, y: str, out: str = "weight") -> DataFrame:
    """1/√max(y,1), normalised to mean 1 (the mean is one scalar)."""
    w = F.lit(1.0) / F.sqrt(F.greatest(F.col(y), F.lit(1.0)))
    mean = scalars(df.agg(F.avg(w).alias("m")))["m"]
    return df.withColumn(out, w / F.lit(mean))


def categorical_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Categoricals as strings with 'nan' for missing values."""
    return df.withColumns({c: as_category(c) for c in cols})
