"""Registered drift and monitoring analyses (M1–M7): reference = the
temporal train split, current = the test split of the flight view."""

from __future__ import annotations

from pyspark.sql import functions as F

from faresight.operators import drift as DR
from faresight.operators import lookup as LK
from faresight.operators.encode import FrequencyEncoder
from faresight.operators.features import engineer_features
from faresight.plans.common import FEATURE_CAT, FEATURE_FREQ, FEATURE_NUM, FEATURE_RAW, SPLIT_CTES, sql_feature_ctes, sql_group_mean_scored, split_flights
from faresight.plans.registry import register, rnd
from faresight.roles import FLIGHT_ROLES
from faresight.session import materialize
from faresight.sources.flights import with_flights

NUM, CAT = FEATURE_NUM + FEATURE_FREQ, FEATURE_CAT
# The features that are no functions of others: crosses, bins, transforms, flags, cycles and
# frequencies follow from these.
DETERMINING = (*FLIGHT_ROLES.cat, *FLIGHT_ROLES.num, "month", "day_of_week", "hour")
Y = "total_fare"


def _sides(spark, sf_dir, split=None):
    s = split if split is not None else split_flights(spark, sf_dir, *FEATURE_RAW)
    s = engineer_features(s, keep=["split", Y])
    freq = FrequencyEncoder(list(FLIGHT_ROLES.freq)).fit(s.where(F.col("split") == "train"))
    s = materialize(freq.transform(s).select("split", *NUM, *CAT))
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


FE_CTES = sql_feature_ctes()


def _sql_numeric(c: str) -> str:
    lam = "(sqrt(nr * nc / (nr + nc)) * d)"
    return f"""SELECT '{c}' AS feature, CAST(nr AS BIGINT) AS n_ref, CAST(nc AS BIGINT) AS n_cur, round(d, 6) AS ks_d,
  round({DR.sql_kolmogorov_sf(lam)}, 6) AS ks_p, round(w, 6) AS wasserstein FROM (
  SELECT max(nr) AS nr, max(nc) AS nc, max(abs(fr - fc)) AS d,
    coalesce(sum(abs(fr - fc) * (nv - v)), 0.0) / (SELECT CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) > 0 THEN stddev_pop(CAST({c} AS DOUBLE)) ELSE 1.0 END FROM fe WHERE split = 'train')
      AS w
  FROM (SELECT v, sum(r) OVER (ORDER BY v) / sum(r) OVER () AS fr, sum(c) OVER (ORDER BY v) / sum(c) OVER () AS fc,
               lead(v) OVER (ORDER BY v) AS nv, sum(r) OVER () AS nr, sum(c) OVER () AS nc
        FROM (SELECT CAST({c} AS DOUBLE) AS v, sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS r,
                     sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS c
              FROM fe WHERE {c} IS NOT NULL GROUP BY 1)))"""


@register("m1_numeric_drift", with_flights("\nUNION ALL\n".join(_sql_numeric(c) for c in NUM), *SPLIT_CTES[:2], *FE_CTES))
def m1_numeric_drift(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    d = DR.numeric_drift(ref, cur, list(NUM))
    return d.select("feature", "n_ref", "n_cur", rnd("ks_d").alias("ks_d"), rnd("ks_p").alias("ks_p"),
                    rnd("wasserstein").alias("wasserstein"))


def _sql_categorical(c: str) -> str:
    return f"""SELECT '{c}' AS feature, CAST(sum(r) AS BIGINT) AS n_ref, CAST(sum(c) AS BIGINT) AS n_cur,
  round(sum((greatest(q, 0.0001) - greatest(p, 0.0001)) * ln(greatest(q, 0.0001) / greatest(p, 0.0001))), 6) AS psi,
  round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0.0 END
                        + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0.0 END) / 2, 0.0)), 6) AS jensen_shannon,
  round(sum(CASE WHEN p > 0 THEN (c - p * nc) * (c - p * nc) / (p * nc) END), 6) AS chi2,
  CAST(sum(CASE WHEN r > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_categories_ref,
  CAST(sum(CASE WHEN c > 0 AND r = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_new_categories
FROM (SELECT r, c, r / sum(r) OVER () AS p, c / sum(c) OVER () AS q, sum(c) OVER () AS nc FROM (
  SELECT CAST({c} AS VARCHAR) AS v, sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS r,
         sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS c FROM fe WHERE {c} IS NOT NULL GROUP BY 1))"""


@register("m1_categorical_drift", with_flights("\nUNION ALL\n".join(_sql_categorical(c) for c in CAT),
                                               *SPLIT_CTES[:2], *FE_CTES))
def m1_categorical_drift(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    d = DR.categorical_drift(ref, cur, list(CAT))
    return d.select("feature", "n_ref", "n_cur", rnd("psi").alias("psi"), rnd("jensen_shannon").alias("jensen_shannon"),
                    rnd("chi2").alias("chi2"), "n_categories_ref", "n_new_categories")


_REPORT_SQL = with_flights("""
SELECT feature, 'numeric' AS kind, 'wasserstein' AS method, wasserstein AS score, wasserstein >= 0.1 AS drift_detected, n_ref, n_cur
FROM (""" + "\nUNION ALL\n".join(_sql_numeric(c) for c in NUM) + """)
UNION ALL
SELECT feature, 'categorical', 'jensenshannon', jensen_shannon, jensen_shannon >= 0.1, n_ref, n_cur
FROM (""" + "\nUNION ALL\n".join(_sql_categorical(c) for c in CAT) + ")", *SPLIT_CTES[:2], *FE_CTES)


@register("m1_drift_report", _REPORT_SQL)
def m1_drift_report(spark, sf_dir):
    """Per-feature report with the default methods."""
    ref, cur = _sides(spark, sf_dir)
    r = DR.drift_report(ref, cur, list(NUM), list(CAT))
    return r.withColumn("score", rnd("score"))


@register("m1_drift_against_state", _REPORT_SQL)
def m1_drift_against_state(spark, sf_dir):
    """The same report from a stored reference state: value counts written once."""
    import uuid

    from faresight.session import ensure_checkpoint_dir, track
    ref, cur = _sides(spark, sf_dir)
    path = track(f"{ensure_checkpoint_dir(spark)}/drift-state/{uuid.uuid4().hex}")
    DR.save_reference(ref, list(NUM), list(CAT), path)
    return DR.drift_against(spark, path, cur).withColumn("score", rnd("score"))


_M2_CTE = ("""report AS (
SELECT feature, wasserstein >= 0.1 AS drift_detected FROM (""" + "\nUNION ALL\n".join(_sql_numeric(c) for c in NUM)
           + """)
UNION ALL
SELECT feature, jensen_shannon >= 0.1 FROM (""" + "\nUNION ALL\n".join(_sql_categorical(c) for c in CAT) + "))")


@register("m2_dataset_drift", with_flights("""
SELECT count(*) AS n_features, CAST(sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted,
  coalesce(string_agg(CASE WHEN drift_detected THEN feature END, ',' ORDER BY feature), '') AS drifted_features,
  round(sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) / count(*), 6) AS drift_share,
  sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) / count(*) >= 0.3 AS dataset_drift
FROM report""", *SPLIT_CTES[:2], *FE_CTES, _M2_CTE))
def m2_dataset_drift(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    r = DR.drift_report(ref, cur, list(NUM), list(CAT), with_p_values=False)
    s = DR.dataset_drift(r)
    return s.select("n_features", "n_drifted", F.array_join("drifted_features", ",").alias("drifted_features"),
                    rnd("drift_share").alias("drift_share"), "dataset_drift")


@register("m3_data_quality", with_flights("""
SELECT CAST(side AS INTEGER) AS side, count(*) AS rows,
  CAST(sum(""" + " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in (*NUM, *CAT)) + """) AS BIGINT)
    AS null_cells,
  CAST((SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM fe f2 WHERE f2.split = x.split
        GROUP BY """ + ", ".join(NUM + CAT) + """ HAVING count(*) > 1)) AS BIGINT) AS duplicate_rows
FROM (SELECT *, CASE WHEN split = 'train' THEN 0 ELSE 1 END AS side FROM fe) x GROUP BY side, split""",
    *SPLIT_CTES[:2], *FE_CTES))
def m3_data_quality(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    sides, _ = DR.data_quality(ref, cur, list(NUM + CAT), list(CAT), DETERMINING)
    return sides.select(F.col("side").cast("int").alias("side"), "rows", "null_cells",
                        F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"))


@register("m3_category_changes", with_flights("\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature,
  (SELECT count(*) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) FROM fe WHERE split = 'test' AND {c} IS NOT NULL
   EXCEPT SELECT DISTINCT CAST({c} AS VARCHAR) FROM fe WHERE split = 'train')) AS n_new,
  (SELECT count(*) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) FROM fe WHERE split = 'train' AND {c} IS NOT NULL
   EXCEPT SELECT DISTINCT CAST({c} AS VARCHAR) FROM fe WHERE split = 'test')) AS n_missing""" for c in CAT),
    *SPLIT_CTES[:2], *FE_CTES))
def m3_category_changes(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    _, cats = DR.data_quality(ref, cur, list(NUM + CAT), list(CAT))
    return cats.select("feature", F.col("n_new").cast("bigint").alias("n_new"),
                       F.col("n_missing").cast("bigint").alias("n_missing"))


# M4 / M5 / M6 ------------------------------------------------------------------------------------
def _scored_sides(spark, sf_dir, split=None):
    s = split if split is not None else split_flights(spark, sf_dir, "travel_class", "destination", Y)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    keys = ["travel_class", "destination"]
    ref = LK.group_mean_predictor(train, train, keys, Y)
    cur = LK.group_mean_predictor(train, test, keys, Y)
    return ref, cur


_M4_CTES = (*SPLIT_CTES, *sql_group_mean_scored("sref", ["travel_class", "destination"], "train", "train"),
            *sql_group_mean_scored("scur", ["travel_class", "destination"], "test", "train"),
            """m4 AS (
SELECT side, sum((total_fare - prediction) * (total_fare - prediction)) AS sse,
  var_pop(total_fare) * count(*) AS sst, avg(abs(total_fare - prediction)) AS mae,
  sqrt(avg((total_fare - prediction) * (total_fare - prediction))) AS rmse,
  avg(abs(total_fare - prediction) / greatest(total_fare, 1.0)) * 100 AS mape, avg(prediction - total_fare) AS mean_error
FROM (SELECT 0 AS side, total_fare, prediction FROM sref UNION ALL SELECT 1, total_fare, prediction FROM scur)
GROUP BY side)""", """m4l AS (
SELECT side, 'r2' AS metric, CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - sse / sst END
  AS value FROM m4
UNION ALL SELECT side, 'mae', mae FROM m4 UNION ALL SELECT side, 'rmse', rmse FROM m4
UNION ALL SELECT side, 'mape', mape FROM m4 UNION ALL SELECT side, 'mean_error', mean_error FROM m4)""")


@register("m4_concept_drift", with_flights("""
SELECT metric, round(max(CASE WHEN side = 0 THEN value END), 6) AS reference,
  round(max(CASE WHEN side = 1 THEN value END), 6) AS current FROM m4l GROUP BY metric""", *_M4_CTES))
def m4_concept_drift(spark, sf_dir):
    ref, cur = _scored_sides(spark, sf_dir)
    c = DR.concept_drift(ref, cur, Y, "prediction")
    return c.select("metric", rnd("reference").alias("reference"), rnd("current").alias("current"))


@register("m5_performance_summary", with_flights("""
SELECT round(max(CASE WHEN side = 0 THEN value END), 6) AS ref_r2, round(max(CASE WHEN side = 1 THEN value END), 6)
  AS cur_r2, coalesce(max(CASE WHEN side = 1 THEN value END) < 0.9 * max(CASE WHEN side = 0 THEN value END), false)
  AS degraded FROM m4l WHERE metric = 'r2'""", *_M4_CTES))
def m5_performance_summary(spark, sf_dir):
    ref, cur = _scored_sides(spark, sf_dir)
    p = DR.performance_summary(DR.concept_drift(ref, cur, Y, "prediction"))
    return p.select(rnd("ref_r2").alias("ref_r2"), rnd("cur_r2").alias("cur_r2"), "degraded")


@register("m6_retrain_decision", with_flights("""
SELECT (sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) / count(*) >= 0.3) AS needs_retraining,
  (sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) / count(*) >= 0.3) AS drift_detected,
  round(sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) / count(*), 6) AS drift_share,
  CAST(sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted_features
FROM report""", *SPLIT_CTES[:2], *FE_CTES, _M2_CTE))
def m6_retrain_decision(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    r = DR.drift_report(ref, cur, list(NUM), list(CAT), with_p_values=False)
    d = DR.retrain_decision(DR.dataset_drift(r))
    return d.select("needs_retraining", "drift_detected", rnd("drift_share").alias("drift_share"), "n_drifted_features")


DRIFT_TRIGGER_SQL = """CASE WHEN nd / n >= 0.3 THEN 'Data drift detected: ' || nd || '/' || n || ' features (' ||
    format('{:.1f}', 100.0 * nd / n) || '%) exceeded 30% threshold' END"""


@register("m6_retrain_decision_with_performance", with_flights(f"""
SELECT len(triggers) > 0 AS needs_retraining, nd / n >= 0.3 AS drift_detected, round(nd / n, 6) AS drift_share, nd AS n_drifted_features, triggers
FROM (SELECT nd, n, list_filter([{DRIFT_TRIGGER_SQL},
    CASE WHEN cur < 0.9 * ref THEN 'Performance degraded: R² ' || format('{{:.4f}}', cur) || ' < 0.9 × ' || format('{{:.4f}}', ref) END],
    lambda x: x IS NOT NULL) AS triggers
  FROM (SELECT CAST(sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) AS BIGINT) AS nd, count(*) AS n FROM report),
    (SELECT max(CASE WHEN side = 0 THEN value END) AS ref, max(CASE WHEN side = 1 THEN value END) AS cur FROM m4l WHERE metric = 'r2'))""",
    *_M4_CTES, *FE_CTES, _M2_CTE))
def m6_retrain_decision_with_performance(spark, sf_dir):
    """Decision with the optional R² degradation trigger and trigger texts."""
    s = split_flights(spark, sf_dir, *FEATURE_RAW)
    ref, cur = _sides(spark, sf_dir, s)
    r = DR.drift_report(ref, cur, list(NUM), list(CAT), with_p_values=False)
    sref, scur = _scored_sides(spark, sf_dir, s)
    perf = DR.performance_summary(DR.concept_drift(sref, scur, Y, "prediction"))
    d = DR.retrain_decision(DR.dataset_drift(r), performance=perf)
    return d.withColumn("drift_share", rnd("drift_share"))


# M7 (batch form; the streaming form is faresight.streaming.monitor) --------------------------------
@register("m7_windowed_mape", with_flights("""
SELECT strftime(to_timestamp(floor(epoch(departure) / 2592000) * 2592000), '%Y-%m-%d') AS window_start,
  count(*) AS n, round(avg(abs(total_fare - prediction)), 4) AS mae,
  round(avg(abs(total_fare - prediction) / greatest(total_fare, 1.0)) * 100, 6) AS mape,
  avg(abs(total_fare - prediction) / greatest(total_fare, 1.0)) * 100 > 60 AS alert
FROM scored GROUP BY 1""", *SPLIT_CTES, *sql_group_mean_scored("scored", ["travel_class", "destination"])))
def m7_windowed_mape(spark, sf_dir):
    from faresight.plans.common import scored_test
    from faresight.streaming.monitor import windowed_error
    w = windowed_error(scored_test(spark, sf_dir), "departure", Y, "prediction", "30 days")
    return w.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "n", rnd("mae", 4).alias("mae"),
                    rnd("mape").alias("mape"), "alert")


