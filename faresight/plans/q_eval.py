"""Registered split, lookup, encoder and evaluation analyses (T*, J*, W*,
E5–E10, V*, A20, A21). Predictions come from train group means, which
DuckDB can reproduce, so the evaluation operators are oracle-checked
without any learner."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from faresight.functions import scalar as S
from faresight.operators import encode as EN
from faresight.operators import evaluate as EV
from faresight.operators import lookup as LK
from faresight.operators import split as SP
from faresight.operators.features import engineer_features
from faresight.operators.profile import scalars
from faresight.plans.common import (FEATURE_CAT, FEATURE_FREQ, FEATURE_NUM, FEATURE_RAW, PRED_KEYS, SCORED_CTES, SPLIT_CTES, TIEBREAK, scored_test, split_flights,
                                    sql_feature_ctes, sql_features, sql_group_mean_scored)
from faresight.plans.registry import register, rnd
from faresight.roles import FLIGHT_ROLES
from faresight.session import materialize
from faresight.sources.flights import flights, with_flights

Y = "total_fare"


def _sql_metrics(y: str = "total_fare", p: str = "prediction", medae: bool = True, mape_floor: bool = True,
                 rounded: bool = True) -> str:
    e = f"({y} - {p})"
    denom = f"greatest({y}, 1)" if mape_floor else y
    cols = [f"count(*) AS n",
            f"round(CASE WHEN var_pop({y}) = 0 THEN (CASE WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END) "
            f"ELSE 1 - sum({e} * {e}) / (var_pop({y}) * count(*)) END, 6) AS r2",
            f"round(avg(abs({e})), 4) AS mae", f"round(sqrt(avg({e} * {e})), 4) AS rmse",
            f"round(avg(abs({e}) / {denom}) * 100, 6) AS mape"]
    if medae:
        cols.append(f"round(quantile_cont(abs({e}), 0.5), 4) AS medae")
    cols.append(f"round(avg({p} - {y}), 4) AS mean_error")
    out = ", ".join(cols)
    if not rounded:
        import re
        out = re.sub(r"round\((.*?), [46]\) AS", r"(\1) AS", out)
    return out


def _metrics_select(m, keys=(), medae=True):
    cols = [*keys, "n", rnd("r2").alias("r2"), rnd("mae", 4).alias("mae"), rnd("rmse", 4).alias("rmse"),
            rnd("mape").alias("mape")]
    if medae:
        cols.append(rnd("medae", 4).alias("medae"))
    cols.append(rnd("mean_error", 4).alias("mean_error"))
    return m.select(*cols)


# T1 / T3 ---------------------------------------------------------------------------------
@register("t1_temporal_split", with_flights("""
SELECT row_idx, split, airline, destination, travel_class, days_before, round(total_fare, 6) AS total_fare
FROM splitf""", *SPLIT_CTES[:2]))
def t1_temporal_split(spark, sf_dir):
    s = split_flights(spark, sf_dir)
    return s.select("row_idx", "split", "airline", "destination", "travel_class", "days_before",
                    rnd(Y).alias(Y))


@register("t1_split_summary", with_flights("""
SELECT split, count(*) AS n, strftime(min(departure), '%Y-%m-%d') AS first_departure,
  strftime(max(departure), '%Y-%m-%d') AS last_departure FROM splitf GROUP BY split""", *SPLIT_CTES[:2]))
def t1_split_summary(spark, sf_dir):
    s = split_flights(spark, sf_dir)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                  F.date_format(F.min("departure"), "yyyy-MM-dd").alias("first_departure"),
                                  F.date_format(F.max("departure"), "yyyy-MM-dd").alias("last_departure"))


@register("t3_holdout_last10", with_flights("""
SELECT CASE WHEN row_idx < (SELECT CAST(floor(count(*) * (1.0::DOUBLE - 0.1::DOUBLE)) AS BIGINT) FROM flights)
  THEN 'train' ELSE 'test' END AS split, count(*) AS n, round(avg(total_fare), 4) AS mean_fare
FROM ranked GROUP BY 1""", SPLIT_CTES[0]))
def t3_holdout_last10(spark, sf_dir):
    s = SP.temporal_split(flights(spark, sf_dir), "departure", 0.1, TIEBREAK)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg(Y), 4).alias("mean_fare"))


# T4 / V17 --------------------------------------------------------------------------------------
K_FOLDS = 5


def walk_forward_group_mean(spark, sf_dir, keys=PRED_KEYS, k=K_FOLDS):
    """Walk-forward CV of the group-mean predictor in one pass: per (key,
    block) sums, cumulative over earlier blocks (a window over the small
    aggregated table), joined to each test block."""
    s = split_flights(spark, sf_dir)
    n = s.count()
    b = SP.walk_forward_blocks(s, n, k)
    keys = list(keys)
    agg = b.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("bn"), F.sum(Y).alias("bs"))
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    cum = agg.select(*keys, "block", F.sum("bn").over(before).alias("cn"), F.sum("bs").over(before).alias("cs"))
    tot = b.groupBy("block").agg(F.count(F.lit(1)).alias("tn"), F.sum(Y).alias("ts"))
    gbefore = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # k+1 rows
    gcum = tot.select("block", (F.sum("ts").over(gbefore) / F.sum("tn").over(gbefore)).alias("gmean"),
                      F.sum("tn").over(gbefore).alias("n_train"))
    test = b.where(F.col("block") >= 0).select(*keys, "block", Y)
    scored = (LK.join_lookup(test, cum, [*keys, "block"]).join(F.broadcast(gcum), "block")  # k+1 rows
              .withColumn("prediction", F.when(F.col("cn") > 0, F.col("cs") / F.col("cn")).otherwise(F.col("gmean"))))
    m = EV.regression_metrics(scored, Y, "prediction", ["block", "n_train"], median=None)
    return m.select(F.col("block").alias("fold"), F.col("n_train").cast("bigint").alias("n_train"),
                    F.col("n").alias("n_test"), "r2", "mae", "rmse")


_T4_SQL = f"""folds AS (
  SELECT i AS fold, n - ({K_FOLDS} - i) * (n // {K_FOLDS + 1}) AS t0,
         n - ({K_FOLDS} - i - 1) * (n // {K_FOLDS + 1}) AS t1
  FROM (SELECT count(*) AS n FROM flights), range({K_FOLDS}) r(i)
), fold_lk AS (
  SELECT fo.fold, r.travel_class, r.destination, avg(r.total_fare) AS _pred
  FROM folds fo JOIN ranked r ON r.row_idx < fo.t0 GROUP BY ALL
), fold_gm AS (
  SELECT fo.fold, avg(r.total_fare) AS gm, count(*) AS n_train FROM folds fo JOIN ranked r ON r.row_idx < fo.t0 GROUP BY 1
), fold_scored AS (
  SELECT fo.fold, g.n_train, r.total_fare, coalesce(l._pred, g.gm) AS prediction
  FROM folds fo JOIN ranked r ON r.row_idx >= fo.t0 AND r.row_idx < fo.t1
  JOIN fold_gm g ON g.fold = fo.fold
  LEFT JOIN fold_lk l ON l.fold = fo.fold AND l.travel_class = r.travel_class AND l.destination = r.destination
), fold_metrics AS (
  SELECT fold, n_train, count(*) AS n_test,
    CASE WHEN var_pop(total_fare) = 0 THEN 0.0 ELSE 1 - sum((total_fare - prediction) * (total_fare - prediction))
      / (var_pop(total_fare) * count(*)) END AS r2,
    avg(abs(total_fare - prediction)) AS mae, sqrt(avg((total_fare - prediction) * (total_fare - prediction))) AS rmse
  FROM fold_scored GROUP BY fold, n_train
)"""


@register("t4_walk_forward_cv", with_flights("""
SELECT CAST(fold AS INTEGER) AS fold, CAST(n_train AS BIGINT) AS n_train, n_test, round(r2, 6) AS r2,
  round(mae, 4) AS mae, round(rmse, 4) AS rmse FROM fold_metrics""", SPLIT_CTES[0], _T4_SQL))
def t4_walk_forward_cv(spark, sf_dir):
    m = walk_forward_group_mean(spark, sf_dir)
    return m.select(F.col("fold").cast("int").alias("fold"), "n_train", "n_test", rnd("r2").alias("r2"),
                    rnd("mae", 4).alias("mae"), rnd("rmse", 4).alias("rmse"))


@register("v17_cv_summary", with_flights("""
SELECT round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std, round(avg(mae), 4) AS mae_mean,
  round(stddev_pop(mae), 4) AS mae_std FROM fold_metrics""", SPLIT_CTES[0], _T4_SQL))
def v17_cv_summary(spark, sf_dir):
    s = EV.cv_summary(walk_forward_group_mean(spark, sf_dir), ["r2", "mae"])
    return s.select(rnd("r2_mean").alias("r2_mean"), rnd("r2_std").alias("r2_std"),
                    rnd("mae_mean", 4).alias("mae_mean"), rnd("mae_std", 4).alias("mae_std"))


# V10 / J1 (flagship) ------------------------------------------------------------------------------
# The reference's growing key sets for the train→test ceiling test.
CEILING_CONFIGS = (
    ("class", ["travel_class"]),
    ("class_dest", ["travel_class", "destination"]),
    ("class_dest_stop", ["travel_class", "destination", "stopovers"]),
    ("plus_aircraft", ["travel_class", "destination", "stopovers", "aircraft_type"]),
    ("plus_airline", ["travel_class", "destination", "stopovers", "aircraft_type", "airline"]),
    ("plus_source", ["travel_class", "destination", "stopovers", "aircraft_type", "airline", "source"]),
    ("all_cats_booking", ["travel_class", "destination", "stopovers", "aircraft_type", "airline", "source",
                          "booking_source"]),
    ("all_cats_season", ["travel_class", "destination", "stopovers", "aircraft_type", "airline", "source",
                         "booking_source", "seasonality"]),
)


def _ceiling_metrics(name, scored):
    from faresight.functions.metrics import r2_from
    m = scored.agg(F.count(F.lit(1)).alias("_n"),
                   F.sum((F.col(Y) - F.col("prediction")) ** 2).alias("_sse"),
                   (F.var_pop(Y) * F.count(F.lit(1))).alias("_sst"),
                   F.avg(F.abs(F.col(Y) - F.col("prediction"))).alias("mae"),
                   F.avg(F.col("matched").cast("double")).alias("coverage"))
    return m.select(F.lit(name).alias("config"), r2_from(F.col("_sse"), F.col("_sst")).alias("r2"), "mae", "coverage")


def _union_rounded(outs):
    u = outs[0]
    for o in outs[1:]:
        u = u.unionByName(o)
    return u.select("config", rnd("r2").alias("r2"), rnd("mae", 4).alias("mae"), rnd("coverage").alias("coverage"))


def _ceiling_rows(train, test, configs):
    """Separate key sets: one fitted lookup per configuration."""
    gm = scalars(train.agg(F.avg(Y).alias("m")))["m"]
    return _union_rounded([_ceiling_metrics(name, LK.apply_group_mean(test, LK.fit_group_mean(train, keys, Y), keys, gm))
                           for name, keys in configs])


def _nested_ceiling_rows(train, test, configs):
    """Nested key sets (each extends the previous one): all lookups from one
    rollup aggregation, all predictions in one pass over the test rows
    (chained broadcast/AQE joins), all metrics in one aggregate."""
    from faresight.functions.metrics import r2_from
    keys = configs[-1][1]
    assert all(list(k) == keys[:len(k)] for _, k in configs)
    table, sizes, gm = LK.fit_nested_group_means(train, keys, Y, [len(k) for _, k in configs])
    scored = test.select(*keys, Y)
    for i, (_, k) in enumerate(configs):
        scored = (LK.apply_nested_level(scored, table, keys, len(k), sizes[len(k)], gm, f"_p{i}")
                  .withColumnRenamed("matched", f"_m{i}"))
    aggs = [(F.var_pop(Y) * F.count(F.lit(1))).alias("_sst")]
    for i in range(len(configs)):
        e = F.col(Y) - F.col(f"_p{i}")
        aggs += [F.sum(e * e).alias(f"_sse{i}"), F.avg(F.abs(e)).alias(f"_mae{i}"),
                 F.avg(F.col(f"_m{i}").cast("double")).alias(f"_cov{i}")]
    one = scored.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("config"), r2_from(F.col(f"_sse{i}"), F.col("_sst")).alias("r2"),
                     F.col(f"_mae{i}").alias("mae"), F.col(f"_cov{i}").alias("coverage"))
            for i, (name, _) in enumerate(configs)]
    long = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.select("config", rnd("r2").alias("r2"), rnd("mae", 4).alias("mae"), rnd("coverage").alias("coverage"))


def _sql_ceiling(configs, src_train="train", src_test="test", prefix="c") -> tuple[str, str]:
    ctes, sels = [], []
    for i, (name, keys) in enumerate(configs):
        ctes += list(sql_group_mean_scored(f"{prefix}{i}", keys, src_test, src_train))
        sels.append(f"""SELECT '{name}' AS config, round(CASE WHEN var_pop(total_fare) = 0 THEN 0.0 ELSE
  1 - sum((total_fare - prediction) * (total_fare - prediction)) / (var_pop(total_fare) * count(*)) END, 6) AS r2,
  round(avg(abs(total_fare - prediction)), 4) AS mae,
  round(avg(CASE WHEN matched THEN 1.0 ELSE 0.0 END), 6) AS coverage FROM {prefix}{i}""")
    return ",\n".join(ctes), "\nUNION ALL\n".join(sels)


_V10_CTES, _V10_SEL = _sql_ceiling(CEILING_CONFIGS)


@register("v10_group_mean_ceiling", with_flights(_V10_SEL, *SPLIT_CTES, _V10_CTES))
def v10_group_mean_ceiling(spark, sf_dir):
    s = split_flights(spark, sf_dir, *ALL_CATS, Y)
    return _nested_ceiling_rows(s.where(F.col("split") == "train"), s.where(F.col("split") == "test"), CEILING_CONFIGS)


# V11 / J2 / F13 -----------------------------------------------------------------------------------------
ALL_CATS = CEILING_CONFIGS[-1][1]
# The (duration, days-before) quantile-bin pairs.
QBIN_CONFIGS = ((5, 5), (10, 10), (20, 20), (50, 10))


@register("v11_quantile_bin_ceiling")
def v11_quantile_bin_ceiling(spark, sf_dir):
    """All bin codes are computed once, into a narrow written table."""
    s = split_flights(spark, sf_dir, Y, *ALL_CATS, "duration_hrs", "days_before")
    train = s.where(F.col("split") == "train")
    x = s
    for col, qs in (("duration_hrs", sorted({nd for nd, _ in QBIN_CONFIGS})), ("days_before", sorted({nb for _, nb in QBIN_CONFIGS}))):
        for q, edges in LK.qcut_edges_many(train, col, qs).items():
            x = LK.with_qcut_bin(x, col, edges, f"_{col}_{q}")
    x = materialize(x.drop("duration_hrs", "days_before"))
    train, test = x.where(F.col("split") == "train"), x.where(F.col("split") == "test")
    out = None
    for nd, nb in QBIN_CONFIGS:
        # a row per pair, written: the next pair's shuffles then follow this one's instead of standing beside them
        rows = materialize(_ceiling_rows(train, test, [(f"all_cats_dur{nd}_day{nb}", [*ALL_CATS, f"_duration_hrs_{nd}", f"_days_before_{nb}"])]))
        out = rows if out is None else out.unionByName(rows)
    return out


def _sql_qbin(col: str, q: int) -> str:
    probs = ", ".join(str(i / q) for i in range(q + 1))
    edges = f"(SELECT list_sort(list_distinct(quantile_cont({col}, [{probs}]))) FROM train)"
    return (f"CASE WHEN {col} IS NULL OR {col} < {edges}[1] OR {col} > {edges}[-1] THEN NULL "
            f"WHEN {col} = {edges}[1] THEN 0 ELSE len(list_filter({edges}, lambda e: e < {col})) - 1 END")


def _v11_sql() -> str:
    ctes, sels = [], []
    for nd, nb in QBIN_CONFIGS:
        for side in ("train", "test"):
            ctes.append(f"{side}_{nd}_{nb} AS (SELECT *, {_sql_qbin('duration_hrs', nd)} AS _dur_bin, "
                        f"{_sql_qbin('days_before', nb)} AS _day_bin FROM {side})")
        c, s_ = _sql_ceiling([(f"all_cats_dur{nd}_day{nb}", [*ALL_CATS, "_dur_bin", "_day_bin"])],
                             f"train_{nd}_{nb}", f"test_{nd}_{nb}", prefix=f"q{nd}_{nb}_")
        ctes.append(c)
        sels.append(s_)
    return with_flights("\nUNION ALL\n".join(sels), *SPLIT_CTES, *ctes)


from faresight.plans.registry import ORACLES, decimal_rounding  # noqa: E402

ORACLES["v11_quantile_bin_ceiling"] = decimal_rounding(_v11_sql())


def _scored(spark, sf_dir, *columns):
    """The scored test rows with what an analysis of target and prediction reads."""
    return scored_test(spark, sf_dir, split=split_flights(spark, sf_dir, *PRED_KEYS, Y, *columns))


# V1 / V16 / F19 -------------------------------------------------------------------------------------------
@register("v1_regression_metrics", with_flights(f"SELECT {_sql_metrics()} FROM scored", *SCORED_CTES))
def v1_regression_metrics(spark, sf_dir):
    return _metrics_select(EV.regression_metrics(_scored(spark, sf_dir), Y, "prediction"))


@register("v1_metrics_by_class", with_flights(
    f"SELECT travel_class, {_sql_metrics()} FROM scored GROUP BY travel_class", *SCORED_CTES))
def v1_metrics_by_class(spark, sf_dir):
    m = EV.regression_metrics(_scored(spark, sf_dir), Y, "prediction", ["travel_class"])
    return _metrics_select(m, ["travel_class"])


@register("f19_served_predictions", with_flights(
    "SELECT row_idx, round(greatest(prediction, 0.0), 2) AS served FROM scored", *SCORED_CTES))
def f19_served_predictions(spark, sf_dir):
    return scored_test(spark, sf_dir).select("row_idx", S.serve_prediction("prediction").alias("served"))


# V2 / V4 / A20 ----------------------------------------------------------------------------------------------
def _sql_segment(y, edges, labels, closed="right"):
    parts = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        hi_s = "'inf'::DOUBLE" if hi == float("inf") else str(hi)
        cond = f"{y} > {lo} AND {y} <= {hi_s}" if closed == "right" else f"{y} >= {lo} AND {y} < {hi_s}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


@register("v2_by_fare_segment", with_flights(f"""
SELECT segment, count(*) AS count, round(avg(total_fare), 4) AS mean_fare,
  CASE WHEN count(*) >= 11 THEN round(1 - sum((total_fare - prediction) * (total_fare - prediction))
    / (var_pop(total_fare) * count(*)), 6) END AS r2,
  round(avg(abs(total_fare - prediction)), 4) AS mae,
  round(avg(abs(total_fare - prediction) / greatest(total_fare, 1)) * 100, 6) AS mape
FROM (SELECT *, {_sql_segment('total_fare', EV.FARE_EDGES, EV.FARE_LABELS)} AS segment FROM scored)
WHERE segment IS NOT NULL GROUP BY segment HAVING count(*) >= 2""", *SCORED_CTES))
def v2_by_fare_segment(spark, sf_dir):
    r = EV.evaluate_by_segment(_scored(spark, sf_dir), Y, "prediction")
    return r.select("segment", "count", rnd("mean_fare", 4).alias("mean_fare"), rnd("r2").alias("r2"),
                    rnd("mae", 4).alias("mae"), rnd("mape").alias("mape"))


_V4_EDGES = (0, 10_000, 25_000, 50_000, 100_000, float("inf"))
_V4_LABELS = ("<10K", "10-25K", "25-50K", "50-100K", ">100K")


@register("v4_segment_variants", with_flights(f"""
SELECT segment, count(*) AS count, round(avg(total_fare), 4) AS mean_fare,
  CASE WHEN count(*) >= 11 THEN round(1 - sum((total_fare - prediction) * (total_fare - prediction))
    / (var_pop(total_fare) * count(*)), 6) END AS r2,
  round(avg(abs(total_fare - prediction)), 4) AS mae,
  round(avg(abs(total_fare - prediction) / total_fare) * 100, 6) AS mape
FROM (SELECT *, {_sql_segment('total_fare', _V4_EDGES, _V4_LABELS, 'left')} AS segment FROM scored)
WHERE segment IS NOT NULL GROUP BY segment HAVING count(*) >= 2""", *SCORED_CTES))
def v4_segment_variants(spark, sf_dir):
    r = EV.evaluate_by_segment(_scored(spark, sf_dir), Y, "prediction", _V4_EDGES, _V4_LABELS, closed="left",
                               mape_floor=None)
    return r.select("segment", "count", rnd("mean_fare", 4).alias("mean_fare"), rnd("r2").alias("r2"),
                    rnd("mae", 4).alias("mae"), rnd("mape").alias("mape"))


@register("a20_error_share", with_flights(f"""
SELECT segment, count(*) AS n, round(avg(total_fare), 4) AS mean_fare, round(avg(abs(total_fare - prediction)), 4) AS mae,
  round(avg(abs(total_fare - prediction) / total_fare) * 100, 6) AS mape,
  round(sum(abs(total_fare - prediction)) / (SELECT sum(abs(total_fare - prediction)) FROM scored) * 100, 6)
    AS pct_of_total
FROM (SELECT *, {_sql_segment('total_fare', EV.FARE_EDGES, EV.FARE_LABELS)} AS segment FROM scored)
WHERE segment IS NOT NULL GROUP BY segment""", *SCORED_CTES))
def a20_error_share(spark, sf_dir):
    seg = EV.segment_column(Y, EV.FARE_EDGES, EV.FARE_LABELS)
    r = EV.error_share(_scored(spark, sf_dir), Y, "prediction", seg)
    return r.select("segment", "n", rnd("mean_fare", 4).alias("mean_fare"), rnd("mae", 4).alias("mae"),
                    rnd("mape").alias("mape"), rnd("pct_of_total").alias("pct_of_total"))


@register("a21_error_quantiles", with_flights("""
SELECT round(quantile_cont(total_fare, 0.5), 4) AS median_target,
  round(quantile_cont(abs(total_fare - prediction), 0.5), 4) AS medae,
  round(quantile_cont(abs(total_fare - prediction), 0.9), 4) AS p90,
  round(quantile_cont(abs(total_fare - prediction), 0.95), 4) AS p95,
  round(quantile_cont(abs(total_fare - prediction), 0.5) / quantile_cont(total_fare, 0.5), 6) AS medae_ratio
FROM scored""", *SCORED_CTES))
def a21_error_quantiles(spark, sf_dir):
    q = EV.error_quantiles(_scored(spark, sf_dir), Y, "prediction")
    return q.select(*[rnd(c, 4).alias(c) for c in ("median_target", "medae", "p90", "p95")],
                    rnd("medae_ratio").alias("medae_ratio"))


# V3 ---------------------------------------------------------------------------------------------------------
for _col in ("travel_class", "airline"):
    def _mk(col):
        def q(spark, sf_dir):
            r = EV.evaluate_by_column(_scored(spark, sf_dir, col), Y, "prediction", col)
            return r.select("group", "count", rnd("mean_fare", 4).alias("mean_fare"), rnd("r2").alias("r2"),
                            rnd("mae", 4).alias("mae"))
        return q
    register(f"v3_by_column_{_col}", with_flights(f"""
SELECT {_col} AS "group", count(*) AS count, round(avg(total_fare), 4) AS mean_fare,
  CASE WHEN count(*) >= 11 THEN round(CASE WHEN var_pop(total_fare) = 0 THEN 0.0 ELSE
    1 - sum((total_fare - prediction) * (total_fare - prediction)) / (var_pop(total_fare) * count(*)) END, 6) END AS r2,
  round(avg(abs(total_fare - prediction)), 4) AS mae
FROM scored WHERE {_col} IS NOT NULL GROUP BY {_col} HAVING count(*) >= 2""", *SCORED_CTES))(_mk(_col))


# V5 -------------------------------------------------------------------------------------------------------------
@register("v5_mae_by_target_quintile", with_flights("""
SELECT quintile, count(*) AS n, round(avg(abs(total_fare - p_class)), 4) AS mae_class,
  round(avg(abs(total_fare - prediction)), 4) AS mae_class_dest FROM (
  SELECT s.*, p1.prediction AS p_class,
    CASE WHEN s.total_fare = e[1] THEN 0 ELSE len(list_filter(e, lambda x: x < s.total_fare)) - 1 END AS quintile
  FROM scored s JOIN p1 USING (row_idx),
       (SELECT list_sort(list_distinct(quantile_cont(total_fare, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM test)
) GROUP BY quintile""", *SCORED_CTES, *sql_group_mean_scored("p1", ["travel_class"])))
def v5_mae_by_target_quintile(spark, sf_dir):
    s = split_flights(spark, sf_dir, *PRED_KEYS, Y)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    p_cd = LK.group_mean_predictor(train, test, list(PRED_KEYS), Y).drop("matched")
    both = LK.group_mean_predictor(train, p_cd, ["travel_class"], Y, "p_class")       # on the same rows: no join by row
    edges = LK.qcut_edges(test, Y, 5)
    b = LK.with_qcut_bin(both, Y, edges, "quintile")
    return b.groupBy("quintile").agg(F.count(F.lit(1)).alias("n"),
                                     rnd(F.avg(F.abs(F.col(Y) - F.col("p_class"))), 4).alias("mae_class"),
                                     rnd(F.avg(F.abs(F.col(Y) - F.col("prediction"))), 4).alias("mae_class_dest"))


# V6 --------------------------------------------------------------------------------------------------------------
@register("v6_residual_histogram", with_flights("""
SELECT b AS bin, coalesce(c, 0) AS count FROM (SELECT range AS b FROM range(20)) bins
LEFT JOIN (SELECT CAST(least(floor((r - lo) / ((hi - lo) / 20.0)), 19) AS BIGINT) AS k, count(*) AS c
           FROM (SELECT total_fare - prediction AS r FROM scored),
                (SELECT min(total_fare - prediction) AS lo, max(total_fare - prediction) AS hi FROM scored)
           GROUP BY 1) h ON h.k = bins.b""", *SCORED_CTES))
def v6_residual_histogram(spark, sf_dir):
    from faresight.operators.profile import histogram
    r = EV.residuals(_scored(spark, sf_dir), Y, "prediction")
    return histogram(r, "residual", bins=20).select(F.col("bin").cast("bigint").alias("bin"), "count")


# V7 / V16 / V8 / W5 / V9 / V12 / V13 --------------------------------------------------------------------------------
MODEL_KEYS = {"p_class": ["travel_class"], "p_class_dest": ["travel_class", "destination"],
              "p_class_dest_stop": ["travel_class", "destination", "stopovers"]}


def predictions_frame(spark, sf_dir, on: str | None = "test"):
    """Test (or train, or with ``on`` None all) rows with the mean baseline (V16) and three
    group-mean predictors fitted on train, as one wide table, written once for the analyses
    that pass over it several times."""
    keys = list(MODEL_KEYS)[-1] and MODEL_KEYS[list(MODEL_KEYS)[-1]]
    s = split_flights(spark, sf_dir, *keys, Y)
    train = s.where(F.col("split") == "train")
    target = s if on is None else s.where(F.col("split") == on)
    table, sizes, gm = LK.fit_nested_group_means(train, keys, Y, [len(k) for k in MODEL_KEYS.values()])
    out = target.select("split", Y, *keys).withColumn("p_mean", F.lit(gm))
    for name, k in MODEL_KEYS.items():
        out = LK.apply_nested_level(out, table, keys, len(k), sizes[len(k)], gm, name).drop("matched")
    return materialize(out)


def _sql_predictions(on: str = "test") -> tuple[str, ...]:
    ctes = []
    for name, keys in MODEL_KEYS.items():
        ctes += list(sql_group_mean_scored(f"m_{name}", keys, on, "train"))
    joins = " ".join(f"JOIN (SELECT row_idx, prediction AS {name} FROM m_{name}) USING (row_idx)" for name in MODEL_KEYS)
    ctes.append(f"preds AS (SELECT t.row_idx, t.total_fare, (SELECT avg(total_fare) FROM train) AS p_mean, "
                f"{', '.join(MODEL_KEYS)} FROM {on} t {joins})")
    return tuple(ctes)


_MODELS = ("p_mean", *MODEL_KEYS)
_LONG = "\nUNION ALL\n".join(f"SELECT '{m}' AS model, total_fare, {m} AS prediction FROM preds" for m in _MODELS)


@register("v7_comparison_table", with_flights(f"""
SELECT model, n, round(r2, 6) AS r2, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(mape, 6) AS mape,
  round(medae, 4) AS medae, round(mean_error, 4) AS mean_error,
  round(r2 - (SELECT r2 FROM cmp_raw WHERE model = 'p_mean'), 6) AS delta_r2,
  round(mae - (SELECT mae FROM cmp_raw WHERE model = 'p_mean'), 4) AS delta_mae,
  round((mae - (SELECT mae FROM cmp_raw WHERE model = 'p_mean')) / (SELECT mae FROM cmp_raw WHERE model = 'p_mean')
    * 100, 6) AS delta_mae_pct
FROM cmp_raw""", *SPLIT_CTES, *_sql_predictions(), f"""cmp_raw AS (SELECT model, {_sql_metrics(rounded=False)}
  FROM ({_LONG}) GROUP BY model)"""))
def v7_comparison_table(spark, sf_dir):
    c = EV.comparison_table(predictions_frame(spark, sf_dir), Y, list(_MODELS), baseline="p_mean")
    return c.select("model", "n", rnd("r2").alias("r2"), rnd("mae", 4).alias("mae"), rnd("rmse", 4).alias("rmse"),
                    rnd("mape").alias("mape"), rnd("medae", 4).alias("medae"), rnd("mean_error", 4).alias("mean_error"),
                    rnd("delta_r2").alias("delta_r2"), rnd("delta_mae", 4).alias("delta_mae"),
                    rnd("delta_mae_pct").alias("delta_mae_pct"))


_CMP_CTES = (*SPLIT_CTES, *_sql_predictions(), f"""cmp AS (SELECT model, {_sql_metrics(medae=False)}
  FROM ({_LONG}) GROUP BY model)""")


@register("v8_champion", with_flights("""
SELECT model, r2, mae FROM cmp ORDER BY r2 IS NULL, r2 DESC, model LIMIT 1""", *_CMP_CTES))
def v8_champion(spark, sf_dir):
    c = EV.comparison_table(predictions_frame(spark, sf_dir), Y, list(_MODELS), median=None)
    c = c.select("model", rnd("r2").alias("r2"), rnd("mae", 4).alias("mae"))
    return EV.select_champion(c, "r2", True)


@register("v8_champion_lowest_mae", with_flights("""
SELECT model, r2, mae FROM cmp ORDER BY mae IS NULL, mae ASC, model LIMIT 1""", *_CMP_CTES))
def v8_champion_lowest_mae(spark, sf_dir):
    c = EV.comparison_table(predictions_frame(spark, sf_dir), Y, list(_MODELS), median=None)
    c = c.select("model", rnd("r2").alias("r2"), rnd("mae", 4).alias("mae"))
    return EV.select_champion(c, "mae", False)


@register("w5_rank_models", with_flights("""
SELECT model, r2, CAST(row_number() OVER (ORDER BY r2 DESC, model) AS INTEGER) AS rank FROM cmp""", *_CMP_CTES))
def w5_rank_models(spark, sf_dir):
    c = EV.comparison_table(predictions_frame(spark, sf_dir), Y, list(_MODELS), median=None)
    c = c.select("model", rnd("r2").alias("r2"))
    return c.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("r2"), "model")))  # one row per model


@register("v9_overfit_check", with_flights("""
SELECT te.model, tr.r2 AS train_r2, te.r2 AS test_r2, round(tr.r2 - te.r2, 6) AS gap, tr.r2 - te.r2 > 0.05 AS overfit
FROM cmp te JOIN cmp_tr tr USING (model) WHERE te.model <> 'p_mean'""", *SPLIT_CTES, *_sql_predictions(),
    f"""cmp AS (SELECT model, {_sql_metrics(medae=False)} FROM ({_LONG}) GROUP BY model)""",
    *[c.replace("m_p_", "mtr_p_").replace("preds AS", "preds_tr AS") for c in _sql_predictions("train")],
    f"""cmp_tr AS (SELECT model, {_sql_metrics(medae=False)} FROM ({_LONG.replace('FROM preds', 'FROM preds_tr')})
        GROUP BY model)"""))
def v9_overfit_check(spark, sf_dir):
    both = predictions_frame(spark, sf_dir, None).select("split", Y, *MODEL_KEYS)
    long = EV.long_predictions(both, Y, list(MODEL_KEYS), ["split"])
    m = EV.regression_metrics(long, Y, "prediction", ["model", "split"], median=None).select(
        "model", "split", rnd("r2").alias("r2"))
    wide = m.groupBy("model").agg(F.max(F.when(F.col("split") == "train", F.col("r2"))).alias("train_r2"),
                                  F.max(F.when(F.col("split") == "test", F.col("r2"))).alias("test_r2"))
    return wide.select("model", "train_r2", "test_r2", rnd(F.col("train_r2") - F.col("test_r2")).alias("gap"),
                       ((F.col("train_r2") - F.col("test_r2")) > 0.05).alias("overfit"))


_BLENDS = {"equal": (1 / 3, 1 / 3, 1 / 3), "fixed": (0.2, 0.3, 0.5)}


@register("v12_blends", with_flights("\nUNION ALL\n".join(
    f"SELECT '{name}' AS blend, {_sql_metrics(p='b', medae=False)} FROM (SELECT total_fare, "
    f"{w[0]} * p_class + {w[1]} * p_class_dest + {w[2]} * p_class_dest_stop AS b FROM preds, r2w)"
    for name, w in [*((n, [f"{x!r}::DOUBLE" for x in w]) for n, w in _BLENDS.items()),
                    ("r2_weighted", [f"{c} / (p_class_r2 + p_class_dest_r2 + p_class_dest_stop_r2)" for c in ("p_class_r2", "p_class_dest_r2", "p_class_dest_stop_r2")])]),
    *SPLIT_CTES, *_sql_predictions(), "r2w AS (SELECT " + ", ".join(
        f"1 - sum((total_fare - {c}) * (total_fare - {c})) / (var_pop(total_fare) * count(*)) AS {c}_r2" for c in ("p_class", "p_class_dest", "p_class_dest_stop")) + " FROM preds)"))
def v12_blends(spark, sf_dir):
    """Equal, R²-weighted and fixed blends of three models."""
    p = materialize(predictions_frame(spark, sf_dir).select(Y, *MODEL_KEYS))
    r2 = {r["model"]: r["r2"] for r in EV.comparison_table(p, Y, list(MODEL_KEYS), median=None).collect()}      # one row per model
    out = None
    for name, w in [*_BLENDS.items(), ("r2_weighted", EV.r2_weights([r2[m] for m in MODEL_KEYS]))]:
        b = EV.blend(p, list(MODEL_KEYS), w, "b")
        m = _metrics_select(EV.regression_metrics(b, Y, "b", median=None), medae=False).select(F.lit(name).alias("blend"), "*")
        out = m if out is None else out.unionByName(m)
    return out


@register("v13_blend_grid", with_flights("\nUNION ALL\n".join(
    f"SELECT {i} AS grid_id, {w[0]}::DOUBLE AS w_p_class, {w[1]}::DOUBLE AS w_p_class_dest, "
    f"{w[2]}::DOUBLE AS w_p_class_dest_stop, "
    f"round(avg(abs(total_fare - ({w[0]}::DOUBLE * p_class + {w[1]}::DOUBLE * p_class_dest "
    f"+ {w[2]}::DOUBLE * p_class_dest_stop))), 4) AS mae "
    f"FROM preds" for i, w in enumerate(EV.weight_grid(3, 0.1))), *SPLIT_CTES, *_sql_predictions()))
def v13_blend_grid(spark, sf_dir):
    g = EV.blend_grid_search(predictions_frame(spark, sf_dir), Y, list(MODEL_KEYS), 0.1)
    return g.withColumn("mae", rnd("mae", 4))


# J6 / W2 / W3 -------------------------------------------------------------------------------------------------------
@register("j6_ecdf_pctrank", with_flights("""
SELECT DISTINCT t.duration_hrs, round((SELECT count(*) FROM train r WHERE r.duration_hrs <= t.duration_hrs)
  / (SELECT count(duration_hrs) FROM train), 8) AS duration_hrs_pctrank FROM test t""", *SPLIT_CTES))
def j6_ecdf_pctrank(spark, sf_dir):
    s = split_flights(spark, sf_dir)
    r = LK.ecdf_against(s.where(F.col("split") == "train"), s.where(F.col("split") == "test"), "duration_hrs")
    return r.select("duration_hrs", rnd("duration_hrs_pctrank", 8).alias("duration_hrs_pctrank")).distinct()


@register("w2_average_rank_pct", with_flights("""
SELECT DISTINCT days_before, round((rank() OVER (ORDER BY days_before) + (count(*) OVER (PARTITION BY days_before) - 1)
  / 2.0) / count(*) OVER (), 8) AS days_before_pctrank FROM train WHERE days_before IS NOT NULL""", *SPLIT_CTES))
def w2_average_rank_pct(spark, sf_dir):
    s = split_flights(spark, sf_dir).where(F.col("split") == "train")
    r = LK.average_rank_pct(s, "days_before")
    return r.select("days_before", rnd("days_before_pctrank", 8).alias("days_before_pctrank")).distinct()


@register("w3_cume_dist", with_flights("""
SELECT DISTINCT duration_hrs, round(cume_dist() OVER (ORDER BY duration_hrs), 8) AS cume_dist
FROM train WHERE duration_hrs IS NOT NULL""", *SPLIT_CTES))
def w3_cume_dist(spark, sf_dir):
    tr = split_flights(spark, sf_dir).where(F.col("split") == "train")
    r = LK.ecdf_against(tr, tr, "duration_hrs", "cume_dist")
    return r.select("duration_hrs", rnd("cume_dist", 8).alias("cume_dist")).distinct()


# E5 / E6 ------------------------------------------------------------------------------------------------------------------
_FREQ = ("route", "airline", "airline_class", "destination")


def _engineered_split(spark, sf_dir):
    s = split_flights(spark, sf_dir, *FEATURE_RAW, "row_idx")
    fe = engineer_features(s, keep=["row_idx", "split", Y])
    return fe.where(F.col("split") == "train"), fe.where(F.col("split") == "test")


def _sql_engineered(src: str) -> str:
    return (f"SELECT row_idx, split, total_fare, airline, destination, travel_class, source || '__' || destination AS route, "
            f"airline || '__' || travel_class AS airline_class FROM {src}")


@register("e5_frequency_encoding", with_flights(f"""
SELECT t.row_idx, """ + ", ".join(
    f"round(coalesce((SELECT n FROM fq_{c} WHERE fq_{c}.v = t.{c}), 0.0), 8) AS {c}_freq" for c in _FREQ) + """
FROM fe_test t""", *SPLIT_CTES, f"fe_train AS ({_sql_engineered('train')})", f"fe_test AS ({_sql_engineered('test')})",
    *[f"fq_{c} AS (SELECT {c} AS v, count(*) / sum(count(*)) OVER () AS n FROM fe_train WHERE {c} IS NOT NULL "
      f"GROUP BY {c})" for c in _FREQ]))
def e5_frequency_encoding(spark, sf_dir):
    train, test = _engineered_split(spark, sf_dir)
    model = EN.FrequencyEncoder(list(_FREQ)).fit(train)
    out = model.transform(test)
    return out.select("row_idx", *[rnd(f"{c}_freq", 8).alias(f"{c}_freq") for c in _FREQ])


_E6_FREQ = {"route": "source || '__' || destination", "airline": "airline", "airline_class": "airline || '__' || travel_class",
            "destination": "destination"}
_E6_TEXT = ("airline", "source", "destination", "stopovers", "aircraft_type", "travel_class", "booking_source", "seasonality", "route",
            "airline_class", "booking_window", "haul_type")


def _e6_sql() -> str:
    from faresight.plans.q_profile import E1_SQL
    body = E1_SQL[E1_SQL.rindex("SELECT airline, source, destination"):].replace("SELECT airline,", "SELECT row_idx, airline,") \
        .replace("FROM flights", "FROM test")
    freq = [f"""fq_{k} AS (SELECT {e} AS v, count(*) / (SELECT count({e}) FROM train) AS f FROM train WHERE {e} IS NOT NULL GROUP BY 1)"""
            for k, e in _E6_FREQ.items()]
    text = ", ".join(f"coalesce({c}, 'nan') AS {c}" for c in _E6_TEXT)
    cols = ", ".join(f"round(coalesce((SELECT f FROM fq_{k} WHERE v = e.{k}), 0.0), 6) AS {k}_freq" for k in _E6_FREQ)
    return with_flights(f"SELECT e.* REPLACE ({text}), {cols} FROM e", *SPLIT_CTES, *freq, f"e AS ({body})")


@register("e6_preprocessor_matrix", _e6_sql())
def e6_preprocessor_matrix(spark, sf_dir):
    """Fit the full preprocessor (features + frequency maps) on train, apply to
    test; categoricals as strings with 'nan' for missing values."""
    from faresight.operators.preprocess import FarePreprocessor
    s = split_flights(spark, sf_dir)
    tr, te = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    model = FarePreprocessor(keep=["row_idx"]).fit(tr)
    out = model.transform(te)
    return out.withColumns({f.name: rnd(f.name) for f in out.schema.fields if f.dataType.simpleString() == "double"})


# E9 / F20 --------------------------------------------------------------------------------------------------------------
_ORD = FEATURE_CAT


@register("e9_ordinal_encoding", with_flights("""
SELECT t.row_idx, """ + ", ".join(f"coalesce(od_{c}.code, -1) AS {c}_code" for c in _ORD) + """
FROM fe_test t """ + " ".join(f"LEFT JOIN od_{c} ON od_{c}.v = CAST(t.{c} AS VARCHAR)" for c in _ORD), *SPLIT_CTES,
    *[f"fe_{side} AS ({sql_features(side)})" for side in ("train", "test")],
    *[f"od_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
      f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM fe_train WHERE {c} IS NOT NULL))" for c in _ORD]))
def e9_ordinal_encoding(spark, sf_dir):
    train, test = _engineered_split(spark, sf_dir)
    model = EN.OrdinalEncoder(list(_ORD)).fit(train)
    return model.transform(test).select("row_idx", *[f"{c}_code" for c in _ORD])


# E10 ---------------------------------------------------------------------------------------------------------------------
_TE = FEATURE_CAT


@register("e10_target_encoding", with_flights("""
SELECT t.row_idx, """ + ", ".join(f"round(coalesce(te_{c}.enc, (SELECT m FROM g)), 4) AS {c}_te" for c in _TE)
    + " FROM fe_test t " + " ".join(f"LEFT JOIN te_{c} ON te_{c}.v = t.{c}" for c in _TE), *SPLIT_CTES, f"fe_train AS ({sql_features('train')})",
    f"fe_test AS ({sql_features('test')})",
    "g AS (SELECT avg(total_fare) AS m, var_pop(total_fare) AS v FROM fe_train)",
    *[f"""te_{c} AS (SELECT v, CASE WHEN n * gv + cv = 0 THEN gm ELSE
       (n * gv / (n * gv + cv)) * cm + (1 - n * gv / (n * gv + cv)) * gm END AS enc FROM (
       SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n, avg(total_fare) AS cm, var_pop(total_fare) AS cv,
              (SELECT m FROM g) AS gm, (SELECT v FROM g) AS gv
       FROM fe_train WHERE {c} IS NOT NULL GROUP BY 1))""" for c in _TE]))
def e10_target_encoding(spark, sf_dir):
    train, test = _engineered_split(spark, sf_dir)
    model = EN.TargetEncoder(list(_TE), Y).fit(train)
    return model.transform(test).select("row_idx", *[rnd(f"{c}_te", 4).alias(f"{c}_te") for c in _TE])


def _sql_oof(c: str) -> str:
    """CTEs of one column's statistics over all folds but one, and its encoding."""
    return f"""st_{c} AS (SELECT {c} AS v, f, count(*) AS n, avg(total_fare) AS m, var_pop(total_fare) AS s
  FROM folded, (SELECT unnest(range(5)) AS f) WHERE fold <> f AND {c} IS NOT NULL GROUP BY 1, 2),
enc_{c} AS (SELECT v, f, CASE WHEN n * gs + s = 0 THEN gm ELSE n * gs / (n * gs + s) * m + (1 - n * gs / (n * gs + s)) * gm END AS e
  FROM st_{c} JOIN rest USING (f))"""


def _e10_oof_sql() -> str:
    ctes = [f"fe_train AS ({sql_features('train')})", f"""folded AS (SELECT *, {SP.sql_row_hash(["row_idx"])} % 5 AS fold FROM fe_train)""",
            """rest AS (SELECT f, avg(total_fare) AS gm, var_pop(total_fare) AS gs FROM folded, (SELECT unnest(range(5)) AS f)
  WHERE fold <> f GROUP BY f)""", *[_sql_oof(c) for c in _TE]]
    cols = ", ".join(f"round(coalesce(enc_{c}.e, rest.gm), 2) AS {c}_te" for c in _TE)
    joins = " ".join(f"LEFT JOIN enc_{c} ON enc_{c}.v = t.{c} AND enc_{c}.f = t.fold" for c in _TE)
    return with_flights(f"SELECT t.row_idx, {cols} FROM folded t JOIN rest ON rest.f = t.fold {joins}", *SPLIT_CTES, *ctes)


@register("e10_target_encoding_oof", _e10_oof_sql())
def e10_target_encoding_oof(spark, sf_dir):
    train, _ = _engineered_split(spark, sf_dir)
    _, oof = EN.TargetEncoder(list(_TE), Y, fold_cols=["row_idx"]).fit_transform_oof(train)
    return oof.select("row_idx", *[rnd(f"{c}_te", 2).alias(f"{c}_te") for c in _TE])


# E8 ------------------------------------------------------------------------------------------------------------------------
@register("e10_ordered_target_statistics", with_flights("SELECT row_idx, split, " + ", ".join(f"floor({c}_ots * 10000.0 + 0.5) / 10000.0 AS {c}_ots" for c in _TE) + """ FROM (
SELECT row_idx, split, """ + ", ".join(
    f"(coalesce(CAST(sum(CAST(total_fare AS DECIMAL(38,6))) OVER w_{c} AS DOUBLE), 0.0) + g.m) / (count(*) OVER w_{c} + 1.0) AS {c}_ots" for c in _TE) + f""" FROM (SELECT *, {SP.sql_row_hash(["row_idx"])} AS h FROM fe_train), g
WINDOW """ + ", ".join(f"w_{c} AS (PARTITION BY coalesce({c}, 'nan') ORDER BY h, row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in _TE) + """
UNION ALL
SELECT row_idx, split, """ + ", ".join(f"coalesce(s_{c}.e, g.m)" for c in _TE) + " FROM fe_test t " + " ".join(
    f"LEFT JOIN s_{c} ON s_{c}.v = coalesce(t.{c}, 'nan')" for c in _TE) + ", g)", *SPLIT_CTES, f"fe_train AS ({sql_features('train')})", f"fe_test AS ({sql_features('test')})",
    "g AS (SELECT CAST(sum(CAST(total_fare AS DECIMAL(38,6))) AS DOUBLE) / count(*) AS m FROM fe_train)",
    *[f"s_{c} AS (SELECT coalesce({c}, 'nan') AS v, (CAST(sum(CAST(total_fare AS DECIMAL(38,6))) AS DOUBLE) + (SELECT m FROM g)) / (count(*) + 1.0) AS e FROM fe_train GROUP BY 1)" for c in _TE]))
def e10_ordered_target_statistics(spark, sf_dir):
    """Ordered target statistics of all categorical features: training rows from the rows
    before them in a seeded permutation, test rows from all training rows."""
    train, test = _engineered_split(spark, sf_dir)
    model, ordered = EN.OrderedTargetEncoder(list(_TE), Y, ["row_idx"]).fit_transform_ordered(train.select("row_idx", "split", Y, *_TE))
    cols = ["row_idx", "split", *[f"{c}_ots" for c in _TE]]
    out = ordered.select(*cols).unionByName(model.transform(test).select(*cols))
    return out.select("row_idx", "split", *[(F.floor(F.col(f"{c}_ots") * 10000.0 + 0.5) / 10000.0).alias(f"{c}_ots") for c in _TE])


_SCALED = FEATURE_NUM + FEATURE_FREQ


@register("e8_population_scaling", with_flights("SELECT row_idx, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM fe WHERE split = 'train')) / (SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1.0 END "
    f"FROM fe WHERE split = 'train'), 6) AS {c}_z" for c in _SCALED) + " FROM fe WHERE split = 'test'", *SPLIT_CTES[:2], *sql_feature_ctes()))
def e8_population_scaling(spark, sf_dir):
    """Z-scores of all numeric features, fitted on train (a constant one is only centred)."""
    train, test = _engineered_split(spark, sf_dir)
    freq = EN.FrequencyEncoder(list(FLIGHT_ROLES.freq)).fit(train)
    m = EN.PopulationScaler(list(_SCALED)).fit(freq.transform(train))
    return m.transform(freq.transform(test)).select("row_idx", *[rnd(f"{c}_z").alias(f"{c}_z") for c in _SCALED])


# T2 / T5 / T8 (hash-based: rows-only checks) ---------------------------------------------------------------------------------
_HASHED = ("airline", "source", "destination", "stopovers", "aircraft_type", "travel_class", "booking_source", "seasonality",
           "days_before", "order_key", "line_no")


@register("t2_hash_split", with_flights(f"""
SELECT CASE WHEN ({SP.sql_row_hash(_HASHED)} % 1000000) / 1000000.0::DOUBLE < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM flights GROUP BY 1"""))
def t2_hash_split(spark, sf_dir):
    s = SP.hash_split(flights(spark, sf_dir), _HASHED, 0.2, portable=True)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("t5_hash_folds", with_flights(f"""
SELECT CAST({SP.sql_row_hash(_HASHED)} % 5 AS INTEGER) AS fold, count(*) AS n FROM flights GROUP BY 1"""))
def t5_hash_folds(spark, sf_dir):
    f = flights(spark, sf_dir)
    return f.withColumn("fold", SP.hash_fold(_HASHED, 5, portable=True)).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("t8_deterministic_sample", with_flights(f"""
SELECT {", ".join(_HASHED)} FROM flights ORDER BY {SP.sql_row_hash(_HASHED)}, {", ".join(f"{c} NULLS LAST" for c in _HASHED)} LIMIT 500"""))
def t8_deterministic_sample(spark, sf_dir):
    return SP.deterministic_sample(flights(spark, sf_dir).select(*_HASHED), 500, portable=True)


# P11 ------------------------------------------------------------------------------------------------------------------------
_DOMAINS = FLIGHT_ROLES.cat
_FAULTS = 40        # every 40th request has each kind of fault


def sql_requests() -> str:
    """Requests: the test flights, some of them with one field made wrong (by row number)."""
    wrong = {c: f"CASE WHEN row_idx % {_FAULTS} = {i} THEN 'Atlantis' WHEN row_idx % {_FAULTS} = {10 + i} THEN NULL ELSE {c} END" for i, c in enumerate(_DOMAINS)}
    wrong["duration_hrs"] = f"CASE WHEN row_idx % {_FAULTS} = 20 THEN -1.0 ELSE duration_hrs END"
    wrong["days_before"] = f"CASE WHEN row_idx % {_FAULTS} = 21 THEN -1 ELSE days_before END"
    return "SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in wrong.items()) + ") FROM test"


def requests(test):
    """The same as a DataFrame."""
    k = F.col("row_idx") % _FAULTS
    wrong = {c: F.when(k == i, F.lit("Atlantis")).when(k == 10 + i, F.lit(None)).otherwise(F.col(c)) for i, c in enumerate(_DOMAINS)}
    wrong["duration_hrs"] = F.when(k == 20, F.lit(-1.0)).otherwise(F.col("duration_hrs"))
    wrong["days_before"] = F.when(k == 21, F.lit(-1)).otherwise(F.col("days_before"))
    return test.withColumns(wrong)


@register("p11_input_validation", with_flights(f"""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN departure IS NULL OR {' OR '.join(f'{c} IS NULL' for c in _DOMAINS)} THEN 'missing_field'
              WHEN duration_hrs < 0 THEN 'negative_duration_hrs'
              WHEN days_before < 0 THEN 'negative_days_before'
              {' '.join(f"WHEN {c} NOT IN (SELECT {c} FROM train WHERE {c} IS NOT NULL) THEN 'unknown_{c}'" for c in _DOMAINS)}
              ELSE 'valid' END AS reason FROM requests) GROUP BY reason""", *SPLIT_CTES, f"requests AS ({sql_requests()})"))
def p11_input_validation(spark, sf_dir):
    """Requests with each kind of fault: missing fields, negative numbers and, for all eight
    option lists (the values seen in training), unknown values."""
    from faresight.operators.validate import validate_requests
    s = split_flights(spark, sf_dir)
    tr, te = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    v = validate_requests(requests(te), required=["departure", *_DOMAINS], non_negative=["duration_hrs", "days_before"], domains={c: tr for c in _DOMAINS})
    return v.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
