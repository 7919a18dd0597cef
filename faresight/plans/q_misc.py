"""Registered schema, encoding-width, monitor-frame, feature-profile and
report round-trip analyses (A11, E7, E12, E13, J5, M11, S4–S10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faresight.operators import drift as DR
from faresight.operators import tracking as TR
from faresight.operators.encode import feature_pipeline
from faresight.operators.features import feature_schema
from faresight.operators.preprocess import FarePreprocessor
from faresight.plans.common import FEATURE_CAT, FEATURE_RAW, SPLIT_CTES, split_flights, sql_features
from faresight.plans.q_drift import FE_CTES, _M2_CTE, DRIFT_TRIGGER_SQL
from faresight.plans.registry import register, rnd
from faresight.session import materialize
from faresight.sources.flights import with_flights

Y = "total_fare"


def _prepared(spark, sf_dir):
    s = split_flights(spark, sf_dir, *FEATURE_RAW)
    tr, te = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    model = FarePreprocessor(keep=[Y]).fit(tr)
    return model, model.transform(tr), model.transform(te)


@register("a11_feature_counts", with_flights("""
SELECT 31 AS num_features_total, 12 AS num_categorical, 19 AS num_numeric,
  (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows""", *SPLIT_CTES))
def a11_feature_counts(spark, sf_dir):
    """Feature counts of the preprocessed matrix (12 categorical + 19
    numeric, as in the reference) and the split sizes."""
    model, xtr, xte = _prepared(spark, sf_dir)
    return xtr.agg(F.count(F.lit(1)).alias("train_rows")).select(
        F.lit(len(model.columns)).alias("num_features_total"), F.lit(len(model.cat_feature_names)).alias("num_categorical"),
        F.lit(len(model.num_feature_names)).alias("num_numeric"), "train_rows",
        F.lit(xte.count()).alias("test_rows"))


@register("e13_feature_schema")
def e13_feature_schema(spark, sf_dir):
    model, xtr, _ = _prepared(spark, sf_dir)
    feats = xtr.select(*model.columns)
    return feature_schema(feats, model.cat_feature_names, [c for c in model.columns
                                                          if c not in model.cat_feature_names])


@register("e7_one_hot_width", with_flights("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS width FROM e" for c in FEATURE_CAT), *SPLIT_CTES, f"e AS ({sql_features('train')})"))
def e7_one_hot_width(spark, sf_dir):
    """One-hot vectors of all categorical features fitted on train; an unseen test
    category is all zeros, so each vector's width equals the train cardinality."""
    from pyspark.ml.functions import vector_to_array
    model, xtr, xte = _prepared(spark, sf_dir)
    cols = list(FEATURE_CAT)
    pm = feature_pipeline(cols, [], encoding="onehot").fit(xtr)
    out = pm.transform(xte)
    return out.agg(*[F.max(F.size(vector_to_array(f"oh_{c}_vec"))).cast("bigint").alias(c) for c in cols]).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("width")) for c in cols])).alias("r")
    ).select("r.*")


@register("j5_monitor_frame", with_flights("""
SELECT travel_class, count(*) AS n, round(avg(total_fare), 4) AS target, round(avg(prediction), 4) AS prediction
FROM (SELECT t.travel_class, t.total_fare, coalesce(l._pred, (SELECT avg(total_fare) FROM train)) AS prediction
      FROM test t LEFT JOIN (SELECT travel_class, destination, avg(total_fare) AS _pred FROM train
                             GROUP BY ALL) l USING (travel_class, destination)) GROUP BY travel_class""", *SPLIT_CTES))
def j5_monitor_frame(spark, sf_dir):
    """Features, target and prediction carried as columns of one frame
    (never zipped by position), here summarised per class."""
    from faresight.plans.common import scored_test
    m = scored_test(spark, sf_dir).select("travel_class", F.col(Y).alias("target"), "prediction")
    return m.groupBy("travel_class").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("target"), 4).alias("target"),
                                         rnd(F.avg("prediction"), 4).alias("prediction"))


@register("m11_feature_profile")
def m11_feature_profile(spark, sf_dir):
    model, xtr, xte = _prepared(spark, sf_dir)
    feats_tr, feats_te = xtr.select(*model.columns), xte.select(*model.columns)
    nums = [c for c in model.columns if c not in model.cat_feature_names]
    prof = TR.feature_profile(materialize(feats_tr), materialize(feats_te), model.cat_feature_names, nums)
    def section(name, df, key, label, value):
        return df.select(F.lit(name).alias("section"), key.alias("name"), label.cast("string").alias("label"), rnd(value, 4).alias("value"))
    none = F.lit(None)
    wide = lambda df: df.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in df.columns]),
                                                            F.array(*[F.col(c).cast("double") for c in df.columns]))).alias("k", "v"))
    schema = prof["schema"].select(F.posexplode("columns_ordered").alias("position", "column"), "dtypes")
    parts = [section("schema", schema, F.col("column"), F.col("dtypes")[F.col("column")], F.col("position")),
             section("params", wide(prof["params"]), F.col("k"), none, F.col("v")),
             section("stats", prof["stats"], F.col("metric_name"), none, F.col("value")),
             section("nulls", wide(prof["nulls"]), F.col("k"), none, F.col("v")),
             section("categories", prof["categories"], F.col("column"), F.col("value"), F.col("count"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_S9_ROW = f"""SELECT coalesce(nd / n >= 0.3, false) AS needs_retraining, coalesce(nd / n >= 0.3, false) AS drift_detected,
  round(nd / n, 6) AS drift_share, nd AS n_drifted_features, coalesce({DRIFT_TRIGGER_SQL}, '') AS triggers
  FROM (SELECT CAST(sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) AS BIGINT) AS nd, count(*) AS n FROM report)"""


@register("s9_drift_report_roundtrip", with_flights(f"""
SELECT layout, d.* FROM (SELECT unnest(['metric_results', 'metrics']) AS layout), ({_S9_ROW}) d
UNION ALL SELECT 'missing', true, false, 0.0, 0, 'No drift report found — retraining as safety measure'""", *SPLIT_CTES[:2], *FE_CTES, _M2_CTE))
def s9_drift_report_roundtrip(spark, sf_dir):
    """Write the drift report in both JSON layouts under the
    session's checkpoint folder, read each back and take the decision."""
    import json
    import uuid
    from faresight.plans.q_drift import CAT, NUM, _sides
    from faresight.session import ensure_checkpoint_dir
    from faresight.sources.io import decision_from_report
    ref, cur = _sides(spark, sf_dir)
    rep = DR.drift_report(ref, cur, list(NUM), list(CAT), with_p_values=False)
    summ = DR.dataset_drift(rep).first()
    feats = rep.select("feature", "drift_detected").collect()  # one row per feature
    base = f"{ensure_checkpoint_dir(spark)}/reports/{uuid.uuid4().hex}"
    layouts = {
        "metric_results": {"metric_results": [{"type": "DriftedColumnsCount", "value": {
            "count": summ["n_drifted"], "share": summ["drift_share"]}}] + [
            {"type": "ValueDrift", "column": r["feature"], "value": {"drift_detected": r["drift_detected"]}}
            for r in feats]},
        "metrics": {"metrics": [{"metric": "DriftedColumnsCount", "result": {
            "number_of_drifted_columns": summ["n_drifted"]}}] + [
            {"metric": "ValueDrift", "column_name": r["feature"], "result": {"drift_detected": r["drift_detected"]}}
            for r in feats]},
    }
    outs = []
    for name, doc in layouts.items():
        path = f"{base}/{name}.json"
        spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        outs.append(decision_from_report(spark, path).withColumn("layout", F.lit(name)))
    outs.append(decision_from_report(spark, f"{base}/missing.json").withColumn("layout", F.lit("missing")))
    u = outs[0]
    for o in outs[1:]:
        u = u.unionByName(o)
    return u.select("layout", "needs_retraining", "drift_detected", rnd("drift_share").alias("drift_share"),
                    "n_drifted_features", F.array_join("triggers", " | ").alias("triggers"))
