"""Registered profile, feature and predicate analyses (A*, E1–E4, F*, P*, T9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faresight.functions import scalar as S
from faresight.functions.metrics import avg_exact
from faresight.operators import features as FE
from faresight.operators import profile as PR
from faresight.plans.common import sql_features, staged_flights
from faresight.plans.registry import register, rnd
from faresight.session import materialize
from faresight.sources.flights import flights, with_flights
from faresight.sources.tables import read_table

CATS = ("airline", "source", "destination", "travel_class", "stopovers", "aircraft_type", "booking_source",
        "seasonality")
RAW_NUM = ("duration_hrs", "days_before", "base_fare", "tax", "total_fare")


def _sql_unpivot_agg(cols, expr_tpl: str, name_col: str = "column", value_col: str = "value") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS {name_col}, {expr_tpl.format(c=c)} AS {value_col} FROM flights" for c in cols)


# E1 ---------------------------------------------------------------------------
E1_SQL = with_flights("""
SELECT airline, source, destination, round(duration_hrs, 6) AS duration_hrs, stopovers, aircraft_type, travel_class,
  booking_source, seasonality, days_before,
  CAST(month(departure) AS INTEGER) AS month, CAST(isodow(departure) - 1 AS INTEGER) AS day_of_week,
  CAST(hour(departure) AS INTEGER) AS hour,
  round(sin(2 * pi() * month(departure) / 12.0), 6) AS month_sin,
  round(cos(2 * pi() * month(departure) / 12.0), 6) AS month_cos,
  round(sin(2 * pi() * hour(departure) / 24.0), 6) AS hour_sin,
  round(cos(2 * pi() * hour(departure) / 24.0), 6) AS hour_cos,
  CASE WHEN isodow(departure) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN month(departure) IN (1, 4, 5, 6, 12) THEN 1 ELSE 0 END AS is_peak,
  source || '__' || destination AS route,
  airline || '__' || travel_class AS airline_class,
  round(ln(1 + greatest(duration_hrs, 0)), 6) AS log_duration,
  round(greatest(duration_hrs, 0) * greatest(duration_hrs, 0), 6) AS duration_sq,
  round(ln(1 + greatest(days_before, 0)), 6) AS log_days_before,
  CASE WHEN greatest(days_before, 0) > -1 AND greatest(days_before, 0) <= 3 THEN 'last_min'
       WHEN greatest(days_before, 0) > 3 AND greatest(days_before, 0) <= 7 THEN '3_7d'
       WHEN greatest(days_before, 0) > 7 AND greatest(days_before, 0) <= 14 THEN '1_2wk'
       WHEN greatest(days_before, 0) > 14 AND greatest(days_before, 0) <= 30 THEN '2_4wk'
       WHEN greatest(days_before, 0) > 30 AND greatest(days_before, 0) <= 60 THEN '1_2mo'
       WHEN greatest(days_before, 0) > 60 AND greatest(days_before, 0) <= 999 THEN '2mo_plus'
       ELSE 'nan' END AS booking_window,
  CASE WHEN greatest(duration_hrs, 0) > -1 AND greatest(duration_hrs, 0) <= 2 THEN 'short'
       WHEN greatest(duration_hrs, 0) > 2 AND greatest(duration_hrs, 0) <= 5 THEN 'medium'
       WHEN greatest(duration_hrs, 0) > 5 AND greatest(duration_hrs, 0) <= 10 THEN 'long'
       WHEN greatest(duration_hrs, 0) > 10 AND greatest(duration_hrs, 0) <= 999 THEN 'ultra_long'
       ELSE 'nan' END AS haul_type,
  CASE WHEN stopovers = 'Direct' THEN 1 ELSE 0 END AS is_direct
FROM flights""")

_E1_ROUND = ("duration_hrs", "month_sin", "month_cos", "hour_sin", "hour_cos", "log_duration", "duration_sq",
             "log_days_before")


@register("e1_feature_builder", E1_SQL)
def e1_feature_builder(spark, sf_dir):
    fe = FE.engineer_features(flights(spark, sf_dir))
    return fe.withColumns({c: rnd(c) for c in _E1_ROUND})


# E2 (hour features are exercised on events.ts, which has times of day) ----------
@register("e2_short_date_features", """
SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(hour(ts) AS INTEGER) AS hour,
  round(sin(2 * pi() * month(ts) / 12.0), 6) AS month_sin, round(cos(2 * pi() * month(ts) / 12.0), 6) AS month_cos,
  CASE WHEN month(ts) IN (1, 4, 5, 12) THEN 1 ELSE 0 END AS is_peak_season
FROM events""")
def e2_short_date_features(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    out = FE.short_date_features(ev, "ts")
    return out.withColumns({"month_sin": rnd("month_sin"), "month_cos": rnd("month_cos")})


@register("f2_hour_cyclic_events", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, round(sin(2 * pi() * hour(ts) / 24.0), 6) AS hour_sin,
  round(cos(2 * pi() * hour(ts) / 24.0), 6) AS hour_cos,
  CASE WHEN isodow(ts) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend, dayname(ts) AS day_name
FROM events""")
def f2_hour_cyclic_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    h = S.hour("ts")
    return ev.select("event_id", h.alias("hour"), rnd(S.cyclic_sin(h, 24)).alias("hour_sin"),
                     rnd(S.cyclic_cos(h, 24)).alias("hour_cos"), S.is_weekend(S.day_of_week("ts")).alias("is_weekend"),
                     S.day_name("ts").alias("day_name"))


# E3 ----------------------------------------------------------------------------
_CLS = "coalesce(CASE travel_class WHEN 'Economy' THEN 1 WHEN 'Business' THEN 2 WHEN 'First Class' THEN 3 END, 1)"
_E3_SQL = E1_SQL.replace("  source || '__' || destination AS route,", "  coalesce(source, 'nan') || '__' || coalesce(destination, 'nan') AS route,") \
    .replace("  airline || '__' || travel_class AS airline_class,", "  coalesce(airline, 'nan') || '__' || coalesce(travel_class, 'nan') AS airline_class,") \
    .replace("THEN 1 ELSE 0 END AS is_direct\n", f"""THEN 1 ELSE 0 END AS is_direct, round(tax, 6) AS tax, {_CLS} AS class_numeric,
  round(greatest(duration_hrs, 0) * {_CLS}, 6) AS duration_x_class,
  round(greatest(days_before, 0) * {_CLS}, 6) AS days_before_x_class
""")


@register("e3_leaky_experiment_features", _E3_SQL)
def e3_leaky_experiment_features(spark, sf_dir):
    fe = FE.leaky_experiment_features(flights(spark, sf_dir), include_tax=True)
    return fe.withColumns({c: rnd(c) for c in (*_E1_ROUND, "tax", "duration_x_class", "days_before_x_class")})


# E4 (cross part) ------------------------------------------------------------------
@register("e4_class_crosses", with_flights(f"""
SELECT class_route, class_dest, class_haul, class_book_win, class_numeric, count(*) AS n,
  round(avg(CAST(total_fare AS DECIMAL(38,6))), 4) AS mean_fare,
  round(avg(CAST(duration_hrs * class_numeric AS DECIMAL(38,6))), 4) AS mean_duration_x_class,
  round(avg(CAST(days_before * class_numeric AS DECIMAL(38,6))), 4) AS mean_days_before_x_class
FROM (
  SELECT *, coalesce(travel_class, 'nan') || '__' || coalesce(route, 'nan') AS class_route,
    coalesce(travel_class, 'nan') || '__' || coalesce(destination, 'nan') AS class_dest,
    coalesce(travel_class, 'nan') || '__' || coalesce(haul_type, 'nan') AS class_haul,
    coalesce(travel_class, 'nan') || '__' || coalesce(booking_window, 'nan') AS class_book_win, {_CLS} AS class_numeric
  FROM e1) GROUP BY ALL""", "e1 AS (" + E1_SQL[E1_SQL.rindex("SELECT airline, source, destination"):].replace(
    "round(duration_hrs, 6) AS duration_hrs", "duration_hrs, total_fare") + ")"))
def e4_class_crosses(spark, sf_dir):
    fe = FE.class_crosses(FE.engineer_features(flights(spark, sf_dir), keep=["total_fare"]))
    return fe.groupBy("class_route", "class_dest", "class_haul", "class_book_win", "class_numeric").agg(
        F.count(F.lit(1)).alias("n"), rnd(avg_exact("total_fare"), 4).alias("mean_fare"),
        rnd(avg_exact("duration_x_class"), 4).alias("mean_duration_x_class"),
        rnd(avg_exact("days_before_x_class"), 4).alias("mean_days_before_x_class"))


# A1 ---------------------------------------------------------------------------------
_A1_TYPES = {"airline": "string", "source": "string", "source_name": "string", "destination": "string",
             "destination_name": "string", "departure": "timestamp_ntz", "arrival": "timestamp_ntz",
             "duration_hrs": "double", "stopovers": "string", "aircraft_type": "string", "travel_class": "string",
             "booking_source": "string", "seasonality": "string", "days_before": "int", "base_fare": "double",
             "tax": "double", "total_fare": "double", "order_key": "bigint", "line_no": "int"}
_A1_COLS = tuple(_A1_TYPES)


@register("a1_audit", with_flights("\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{_A1_TYPES[c]}' AS dtype, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS nulls, CAST(count(DISTINCT {c}) AS BIGINT) AS \"distinct\" FROM flights"
    for i, c in enumerate(_A1_COLS))))
def a1_audit(spark, sf_dir):
    return PR.audit(staged_flights(spark, sf_dir, *_A1_COLS))


@register("a7_total_nulls", with_flights(
    "SELECT CAST(" + " + ".join(f"(count(*) - count({c}))" for c in _A1_COLS) + " AS BIGINT) AS null_count FROM flights"))
def a7_total_nulls(spark, sf_dir):
    return PR.total_nulls(flights(spark, sf_dir).select(*_A1_COLS))


# A2 / A3 ---------------------------------------------------------------------------
@register("a2_group_mean", with_flights(
    "SELECT airline, round(avg(total_fare), 4) AS mean, count(*) AS n FROM flights GROUP BY airline"))
def a2_group_mean(spark, sf_dir):
    g = PR.group_mean(flights(spark, sf_dir), ["airline"], "total_fare")
    return g.select("airline", rnd("mean", 4).alias("mean"), "n").orderBy("mean")


@register("a3_group_mean_median", with_flights(
    "SELECT travel_class, round(avg(total_fare), 4) AS mean, count(*) AS n, "
    "round(quantile_cont(total_fare, 0.5), 4) AS median FROM flights GROUP BY travel_class"))
def a3_group_mean_median(spark, sf_dir):
    g = PR.group_mean_median(staged_flights(spark, sf_dir, "travel_class", "total_fare"), ["travel_class"], "total_fare")
    return g.select("travel_class", rnd("mean", 4).alias("mean"), "n", rnd("median", 4).alias("median"))


# A4 / A5 -----------------------------------------------------------------------------
_A4_SQL_COLS = """count(total_fare) AS count, round(avg(total_fare), 4) AS mean, round(stddev_samp(total_fare), 4) AS std,
  round(min(total_fare), 4) AS min, round(max(total_fare), 4) AS max, round(skewness(total_fare), 6) AS skew,
  round(kurtosis(total_fare), 6) AS kurtosis, round(quantile_cont(total_fare, 0.25), 4) AS p25,
  round(quantile_cont(total_fare, 0.5), 4) AS median, round(quantile_cont(total_fare, 0.75), 4) AS p75,
  round(max(total_fare) - min(total_fare), 4) AS range,
  round(quantile_cont(total_fare, 0.75) - quantile_cont(total_fare, 0.25), 4) AS iqr,
  round(stddev_samp(total_fare) / avg(total_fare), 6) AS cov"""


def _a4_select(d, keys=()):
    r4 = ("mean", "std", "min", "max", "p25", "median", "p75", "range", "iqr")
    return d.select(*keys, "count", *[rnd(c, 4).alias(c) for c in r4], rnd("skew").alias("skew"),
                    rnd("kurtosis").alias("kurtosis"), rnd("cov").alias("cov"))


@register("a4_describe_target", with_flights(f"SELECT {_A4_SQL_COLS} FROM flights"))
def a4_describe_target(spark, sf_dir):
    d = PR.describe_numeric(staged_flights(spark, sf_dir, "total_fare"), "total_fare")
    return _a4_select(d)


@register("a4_describe_by_class", with_flights(
    f"SELECT travel_class, {_A4_SQL_COLS} FROM flights GROUP BY travel_class"))
def a4_describe_by_class(spark, sf_dir):
    d = PR.describe_numeric(staged_flights(spark, sf_dir, "travel_class", "total_fare"), "total_fare", ["travel_class"])
    return _a4_select(d, ["travel_class"])


@register("a4_mode_duration", with_flights("""
SELECT travel_class, arg_min(duration_hrs, struct_pack(a := -c, b := duration_hrs)) AS mode FROM (
  SELECT travel_class, duration_hrs, count(*) AS c FROM flights WHERE duration_hrs IS NOT NULL GROUP BY ALL
) GROUP BY travel_class"""))
def a4_mode_duration(spark, sf_dir):
    return PR.mode_of(flights(spark, sf_dir), "duration_hrs", ["travel_class"])


# A6 / F17 ------------------------------------------------------------------------------
_A6_COLS = ("duration_hrs", "days_before", "month", "day_of_week", "hour", "month_sin", "month_cos", "hour_sin", "hour_cos", "is_weekend", "is_peak",
            "log_duration", "duration_sq", "log_days_before", "is_direct", "base_fare", "tax", "total_fare")


@register("a6_numeric_profile", with_flights("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, '{st}' AS stat, round(coalesce({fn}, 0.0), 4) AS value, "
    f"'feat_' || regexp_replace('{c}', '[^a-zA-Z0-9_\\-\\. /]', '_', 'g') || '__{st}' AS metric_name FROM fe"
    for c in _A6_COLS for st, fn in (("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("min", f"min({c})"),
                                     ("max", f"max({c})"), ("median", f"quantile_cont(CAST({c} AS DOUBLE), 0.5)"))),
    f"fe AS ({sql_features('flights', 'base_fare, tax, total_fare')})"))
def a6_numeric_profile(spark, sf_dir):
    """All numeric features and the fares."""
    x = FE.engineer_features(flights(spark, sf_dir), keep=["base_fare", "tax", "total_fare"])
    p = PR.numeric_profile(materialize(x.select(*_A6_COLS)), list(_A6_COLS))
    return p.select("feature", "stat", rnd("value", 4).alias("value"),
                    F.concat(F.lit("feat_"), S.sanitize_metric_name("feature"), F.lit("__"), F.col("stat"))
                    .alias("metric_name"))


# A8 --------------------------------------------------------------------------------------
@register("a8_describe_categorical", with_flights("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
  arg_min(v, struct_pack(a := -n, b := v)) AS top, max(n) AS freq
FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM flights WHERE {c} IS NOT NULL GROUP BY 1)"""
    for c in CATS)))
def a8_describe_categorical(spark, sf_dir):
    return PR.describe_categorical(flights(spark, sf_dir), list(CATS))


# A9 ---------------------------------------------------------------------------------------
_FREQ_SRC = {"route": "source || '__' || destination", "airline": "airline",
             "airline_class": "airline || '__' || travel_class", "destination": "destination"}


@register("a9_relative_frequency", with_flights("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", v AS value, n AS count, round(n / sum(n) OVER (), 8) AS freq
FROM (SELECT {e} AS v, count(*) AS n FROM flights WHERE {e} IS NOT NULL GROUP BY 1)""" for c, e in _FREQ_SRC.items())))
def a9_relative_frequency(spark, sf_dir):
    fe = FE.engineer_features(flights(spark, sf_dir))
    r = PR.relative_frequency(fe, list(_FREQ_SRC))
    return r.withColumn("freq", rnd("freq", 8))


# A10 --------------------------------------------------------------------------------------
@register("a10_top_category_counts", with_flights("""
SELECT "column", value, count, rank FROM (
  SELECT "column", value, count, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC) AS rank
  FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({e} AS VARCHAR) AS value, count(*) AS count FROM flights "
    f"WHERE {e} IS NOT NULL GROUP BY 2" for c, e in {**{c: c for c in CATS}, "route": _FREQ_SRC["route"]}.items())
    + """)
) WHERE rank <= 30"""))
def a10_top_category_counts(spark, sf_dir):
    fe = FE.engineer_features(flights(spark, sf_dir))
    t = PR.top_category_counts(fe, list(CATS) + ["route"], 30)
    return t.select("column", "value", "count", F.col("rank").cast("bigint").alias("rank"))


# A12 / A13 -----------------------------------------------------------------------------------
@register("a12_correlation_matrix", with_flights("\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM flights"
    for a in RAW_NUM for b in RAW_NUM)))
def a12_correlation_matrix(spark, sf_dir):
    c = PR.correlation_matrix(flights(spark, sf_dir), list(RAW_NUM))
    return c.withColumn("corr", rnd("corr"))


@register("a13_target_correlation", with_flights("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(corr({c}, total_fare), 6) AS corr FROM flights"
    for c in RAW_NUM if c != "total_fare")))
def a13_target_correlation(spark, sf_dir):
    t = PR.target_correlations(flights(spark, sf_dir), [c for c in RAW_NUM if c != "total_fare"], "total_fare")
    return t.withColumn("corr", rnd("corr"))


# A14 -------------------------------------------------------------------------------------------
@register("a14_eta_squared", with_flights("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, round(sum(n * (m - mu) * (m - mu)) / (var_pop_all * sum(n)), 6) AS eta2 FROM (
  SELECT count(*) AS n, avg(total_fare) AS m, (SELECT avg(total_fare) FROM flights) AS mu,
         (SELECT var_pop(total_fare) FROM flights) AS var_pop_all
  FROM flights GROUP BY coalesce(CAST({c} AS VARCHAR), 'nan')) GROUP BY var_pop_all""" for c in CATS)))
def a14_eta_squared(spark, sf_dir):
    e = PR.eta_squared(staged_flights(spark, sf_dir, *CATS, "total_fare"), list(CATS), "total_fare")
    return e.withColumn("eta2", rnd("eta2"))


# A15 / P8 / T6 ------------------------------------------------------------------------------------
_KEY_GROUP = ("airline", "source", "destination", "travel_class", "stopovers")
# The five-key groups of these tables hold a few rows each, so their least size is 2 here; the
# four-key variant (without source) keeps the usual least size of 10.
_SPREADS = (("", _KEY_GROUP, 2), ("_four_keys", ("airline", "destination", "travel_class", "stopovers"), 10))


def _spread_cte(keys, least: int) -> str:
    return f"""spread AS (
  SELECT {", ".join(keys)}, avg(total_fare) AS mean, stddev_samp(total_fare) AS std, count(*) AS count,
         min(total_fare) AS min, max(total_fare) AS max,
         stddev_samp(total_fare) / avg(total_fare) AS cv, max(total_fare) - min(total_fare) AS range
  FROM flights GROUP BY ALL HAVING count(*) >= {least}
)"""


def _register_spread(suffix: str, keys: tuple, least: int) -> None:
    @register(f"a15_group_spread_top10{suffix}", with_flights(f"""
SELECT {", ".join(keys)}, count, round(mean, 3) AS mean, round(cv, 6) AS cv, round(range, 2) AS range
FROM spread ORDER BY round(cv, 9) DESC, {", ".join(keys)} LIMIT 10""", _spread_cte(keys, least)))
    def top10(spark, sf_dir):
        s = PR.group_spread(flights(spark, sf_dir), list(keys), "total_fare", min_count=least)
        top = s.orderBy(F.round("cv", 9).desc(), *keys).limit(10)
        return top.select(*keys, "count", rnd("mean", 3).alias("mean"), rnd("cv").alias("cv"), rnd("range", 2).alias("range"))

    @register(f"a15_group_spread_summary{suffix}", with_flights("""
SELECT count(*) AS n_groups, round(avg(cv), 6) AS mean_cv, round(avg(range), 4) AS mean_range,
  round(quantile_cont(range, 0.5), 4) AS median_range FROM spread""", _spread_cte(keys, least)))
    def summary(spark, sf_dir):
        s = materialize(PR.group_spread(flights(spark, sf_dir), list(keys), "total_fare", min_count=least))
        out = PR.group_spread_summary(s)
        return out.select("n_groups", rnd("mean_cv").alias("mean_cv"), rnd("mean_range", 4).alias("mean_range"),
                          rnd("median_range", 4).alias("median_range"))


for _spread in _SPREADS:
    _register_spread(*_spread)


# A16 / W1 / F12 ----------------------------------------------------------------------------------------
_A16_SETS = {"key5": list(_KEY_GROUP), "key6": list(_KEY_GROUP) + ["booking_source"],
             "key6_bins": list(_KEY_GROUP) + ["booking_source", "duration_hrs_bin", "days_before_bin"]}


def _sql_ewbin(c: str, k: int = 10) -> str:
    lo, hi = f"(SELECT min({c}) FROM flights)", f"(SELECT max({c}) FROM flights)"
    w = f"(({hi} - {lo}) / {float(k)})"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {hi} = {lo} THEN 0 WHEN {c} = {lo} THEN 0 "
            f"ELSE CAST(least(greatest(ceil(({c} - {lo}) / {w}) - 1, 0), {k - 1}) AS INTEGER) END")


_A16_BINNED = (f"""binned AS (SELECT *, {_sql_ewbin('duration_hrs')} AS duration_hrs_bin,
  {_sql_ewbin('days_before')} AS days_before_bin FROM flights)""",)


@register("a16_in_sample_ceiling", with_flights("\nUNION ALL\n".join(
    f"""SELECT '{name}' AS key_set, round(CASE WHEN var_pop(total_fare) = 0 THEN 0.0 ELSE
  1 - sum((total_fare - gm) * (total_fare - gm)) / (var_pop(total_fare) * count(*)) END, 6) AS r2,
  round(avg(abs(total_fare - gm)), 4) AS mae
FROM (SELECT total_fare, avg(total_fare) OVER (PARTITION BY {", ".join(keys)}) AS gm FROM binned)"""
    for name, keys in _A16_SETS.items()), *_A16_BINNED))
def a16_in_sample_ceiling(spark, sf_dir):
    f = PR.equal_width_bins(staged_flights(spark, sf_dir, *_KEY_GROUP, "booking_source", "duration_hrs", "days_before", "total_fare"),
                            {"duration_hrs": 10, "days_before": 10})
    outs = [PR.in_sample_ceiling(f, keys, "total_fare").select(F.lit(name).alias("key_set"), "r2", "mae")
            for name, keys in _A16_SETS.items()]
    u = outs[0]
    for o in outs[1:]:
        u = u.unionByName(o)
    return u.select("key_set", rnd("r2").alias("r2"), rnd("mae", 4).alias("mae"))


# A17 ------------------------------------------------------------------------------------------------
_NOISE_FEATURES = ("airline", "source", "destination", "duration_hrs", "stopovers", "aircraft_type",
                   "travel_class", "booking_source", "seasonality", "days_before")


@register("a17_noise_floor", with_flights(f"""
SELECT count(*) AS n_groups, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_multi,
  round(avg(CASE WHEN n > 1 THEN std END), 4) AS within_std,
  round(avg(CASE WHEN n > 1 THEN mx - mn END), 4) AS within_range,
  round(sqrt(sum(CASE WHEN n > 1 THEN std * std * n END) / sum(CASE WHEN n > 1 THEN n END)), 4) AS pooled_std
FROM (SELECT count(*) AS n, stddev_samp(total_fare) AS std, min(total_fare) AS mn, max(total_fare) AS mx
      FROM flights GROUP BY {", ".join(_NOISE_FEATURES)})"""))
def a17_noise_floor(spark, sf_dir):
    nf = PR.noise_floor(flights(spark, sf_dir), list(_NOISE_FEATURES), "total_fare")
    return nf.select("n_groups", "n_multi", *[rnd(c, 4).alias(c) for c in ("within_std", "within_range", "pooled_std")])


# A18 -------------------------------------------------------------------------------------------------
@register("a18_monthly_trend", with_flights("""
SELECT strftime(departure, '%Y-%m') AS month, round(avg(total_fare), 4) AS mean,
  round(stddev_samp(total_fare), 4) AS std, count(total_fare) AS count FROM flights GROUP BY 1"""))
def a18_monthly_trend(spark, sf_dir):
    m = PR.monthly_trend(flights(spark, sf_dir), "departure", "total_fare")
    return m.select("month", rnd("mean", 4).alias("mean"), rnd("std", 4).alias("std"), "count")


# A19 --------------------------------------------------------------------------------------------------
@register("a19_cardinality", with_flights(
    "SELECT \"column\", n_unique, CAST(sum(n_unique) OVER () AS BIGINT) AS ohe_width FROM (" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique FROM flights" for c in CATS)
    + ")"))
def a19_cardinality(spark, sf_dir):
    return PR.cardinality(flights(spark, sf_dir), list(CATS))


# A22 ---------------------------------------------------------------------------------------------------
@register("a22_histogram", with_flights("""
SELECT b AS bin, coalesce(c, 0) AS count FROM
  (SELECT range AS b FROM range(80)) bins
  CROSS JOIN (SELECT min(total_fare) AS lo, (max(total_fare) - min(total_fare)) / 80.0 AS w FROM flights) mm
  LEFT JOIN (SELECT CAST(least(floor((total_fare - (SELECT min(total_fare) FROM flights))
                    / ((SELECT max(total_fare) - min(total_fare) FROM flights) / 80.0)), 79) AS BIGINT) AS k,
                    count(*) AS c FROM flights GROUP BY 1) h ON h.k = bins.b"""))
def a22_histogram(spark, sf_dir):
    h = PR.histogram(flights(spark, sf_dir), "total_fare", bins=80)
    return h.select(F.col("bin").cast("bigint").alias("bin"), "count")


_EDGES_1E5 = [i * 100000.0 / 49 for i in range(50)]


@register("a22_histogram_fixed_edges", with_flights(f"""
SELECT b AS bin, count, round(count / (total * (hi - lo)), 12) AS density FROM (
  SELECT e.b, e.lo, e.hi, coalesce(h.c, 0) AS count, (SELECT count(total_fare) FROM flights) AS total FROM
    (SELECT b, edges[b + 1] AS lo, edges[b + 2] AS hi FROM (SELECT range AS b FROM range(49)),
       (SELECT {[float(x) for x in _EDGES_1E5]}::DOUBLE[] AS edges)) e
    LEFT JOIN (SELECT CASE WHEN total_fare = {_EDGES_1E5[-1]} THEN 48 ELSE
                 len(list_filter({[float(x) for x in _EDGES_1E5]}::DOUBLE[], lambda x: x <= total_fare)) - 1 END AS k,
                 count(*) AS c FROM flights WHERE total_fare >= 0 AND total_fare <= {_EDGES_1E5[-1]} GROUP BY 1) h
    ON h.k = e.b)"""))
def a22_histogram_fixed_edges(spark, sf_dir):
    h = PR.histogram(flights(spark, sf_dir), "total_fare", edges=_EDGES_1E5, density=True)
    return h.select(F.col("bin").cast("bigint").alias("bin"), "count", rnd("density", 12).alias("density"))


# A23 ----------------------------------------------------------------------------------------------------
@register("a23_boxplot_by_class", with_flights("""
SELECT q.travel_class, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(min(CASE WHEN total_fare BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN total_fare END), 4)
    AS whisker_lo,
  round(max(CASE WHEN total_fare BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN total_fare END), 4)
    AS whisker_hi,
  CAST(sum(CASE WHEN total_fare BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS BIGINT)
    AS n_outliers
FROM (SELECT travel_class, quantile_cont(total_fare, 0.25) AS q1, quantile_cont(total_fare, 0.5) AS median,
             quantile_cont(total_fare, 0.75) AS q3 FROM flights GROUP BY 1) q
JOIN flights f ON f.travel_class = q.travel_class
GROUP BY q.travel_class, q1, median, q3"""))
def a23_boxplot_by_class(spark, sf_dir):
    b = PR.boxplot_stats(staged_flights(spark, sf_dir, "travel_class", "total_fare"), ["travel_class"], "total_fare")
    return b.select("travel_class", *[rnd(c, 4).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                    "n_outliers")


# A24 -----------------------------------------------------------------------------------------------------
@register("a24_ranges", with_flights("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max "
    f"FROM flights" for c in RAW_NUM)))
def a24_ranges(spark, sf_dir):
    r = PR.ranges(flights(spark, sf_dir), list(RAW_NUM))
    return r.select("column", rnd("min", 4).alias("min"), rnd("max", 4).alias("max"))


# P5 / P6 / P7 -------------------------------------------------------------------------------------------------
@register("p6_half_open_range_filter", with_flights("""
SELECT travel_class, count(*) AS n, round(avg(total_fare), 4) AS mean_fare FROM flights
WHERE travel_class = 'Economy' AND total_fare >= 10000 AND total_fare < 50000 AND
  CASE WHEN month(departure) IN (1, 4, 5, 6, 12) THEN 1 ELSE 0 END = 1
GROUP BY travel_class"""))
def p6_half_open_range_filter(spark, sf_dir):
    f = flights(spark, sf_dir)
    sel = f.where((F.col("travel_class") == "Economy") & (F.col("total_fare") >= 10000) & (F.col("total_fare") < 50000)
                  & (S.in_set_flag(S.month("departure"), S.PEAK_MONTHS) == 1))
    return sel.groupBy("travel_class").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("total_fare"), 4).alias("mean_fare"))


# P9 / F18 ------------------------------------------------------------------------------------------------------
@register("p9_equality_rate", with_flights("""
SELECT 'source' AS col_a, 'source_name_code' AS col_b,
  round(avg(CASE WHEN source = trim(replace(string_split(source_name, '(')[-1], ')', '')) THEN 1.0 ELSE 0.0 END), 6)
    AS match_rate FROM flights
UNION ALL
SELECT 'source', 'destination', round(avg(CASE WHEN source = destination THEN 1.0 ELSE 0.0 END), 6) FROM flights"""))
def p9_equality_rate(spark, sf_dir):
    f = flights(spark, sf_dir).withColumn("source_name_code", S.code_from_display("source_name"))
    r = PR.equality_rate(f, [("source", "source_name_code"), ("source", "destination")])
    return r.withColumn("match_rate", rnd("match_rate"))


@register("f18_code_from_display", with_flights("""
SELECT DISTINCT source_name, trim(replace(string_split(source_name, '(')[-1], ')', '')) AS code FROM flights"""))
def f18_code_from_display(spark, sf_dir):
    f = flights(spark, sf_dir)
    return f.select("source_name", S.code_from_display("source_name").alias("code")).distinct()


# P10 -------------------------------------------------------------------------------------------------------------
@register("p10_additive_identity", with_flights("""
SELECT round(max(abs(total_fare - (base_fare + tax))), 6) AS max_diff,
  round(avg(abs(total_fare - (base_fare + tax))), 6) AS mean_diff,
  coalesce(bool_and(abs(total_fare - (base_fare + tax)) < 0.01), true) AS exact_match FROM flights"""))
def p10_additive_identity(spark, sf_dir):
    r = PR.additive_identity(flights(spark, sf_dir), "base_fare", "tax", "total_fare")
    return r.select(rnd("max_diff").alias("max_diff"), rnd("mean_diff").alias("mean_diff"), "exact_match")


# P12 --------------------------------------------------------------------------------------------------------------
@register("p12_option_domains", with_flights("\nUNION ALL\n".join(
    f"SELECT DISTINCT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM flights WHERE {c} IS NOT NULL"
    for c in CATS)))
def p12_option_domains(spark, sf_dir):
    return PR.option_domains(flights(spark, sf_dir), list(CATS))


# T9 ---------------------------------------------------------------------------------------------------------------
@register("t9_key_uniqueness", with_flights("""
SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT order_key, line_no FROM flights)) AS n_keys,
  count(*) = (SELECT count(*) FROM (SELECT DISTINCT order_key, line_no FROM flights)) AS is_unique FROM flights"""))
def t9_key_uniqueness(spark, sf_dir):
    return PR.key_is_unique(flights(spark, sf_dir), ["order_key", "line_no"])


# F16 ---------------------------------------------------------------------------------------------------------------
@register("f16_elapsed_hours", with_flights("""
SELECT round(corr(epoch_us(arrival) / 3.6e9 - epoch_us(departure) / 3.6e9, duration_hrs), 6) AS corr,
  round(max(abs((epoch_us(arrival) - epoch_us(departure)) / 3.6e9 - duration_hrs)), 6) AS max_abs_diff
FROM flights"""))
def f16_elapsed_hours(spark, sf_dir):
    f = flights(spark, sf_dir).withColumn("calc", S.elapsed_hours("departure", "arrival"))
    return f.agg(rnd(F.corr("calc", "duration_hrs")).alias("corr"),
                 rnd(F.max(F.abs(F.col("calc") - F.col("duration_hrs")))).alias("max_abs_diff"))


# F3 / J7 -------------------------------------------------------------------------------------------------------------
_DOW = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


@register("j7_mean_by_day_name", with_flights(
    "SELECT d.ordinal, d.day_name, round(m.mean, 4) AS mean FROM (VALUES " +
    ", ".join(f"({i}, '{d}')" for i, d in enumerate(_DOW)) +
    ") d(ordinal, day_name) LEFT JOIN (SELECT dayname(departure) AS day_name, avg(total_fare) AS mean FROM flights "
    "GROUP BY 1) m USING (day_name)"))
def j7_mean_by_day_name(spark, sf_dir):
    from faresight.operators.lookup import reindex_domain
    f = flights(spark, sf_dir)
    g = f.groupBy(S.day_name("departure").alias("day_name")).agg(F.avg("total_fare").alias("mean"))
    return reindex_domain(g, "day_name", _DOW).select("ordinal", "day_name", rnd("mean", 4).alias("mean"))


# F21 ----------------------------------------------------------------------------------------------------------------
@register("f21_sample_weights", with_flights("""
SELECT travel_class, round(avg(w / wbar), 6) AS mean_weight, round(min(w / wbar), 6) AS min_weight,
  round(max(w / wbar), 6) AS max_weight FROM (
  SELECT travel_class, 1 / sqrt(greatest(total_fare, 1)) AS w,
         avg(1 / sqrt(greatest(total_fare, 1))) OVER () AS wbar FROM flights) GROUP BY travel_class"""))
def f21_sample_weights(spark, sf_dir):
    from faresight.operators.encode import inverse_sqrt_weight
    w = inverse_sqrt_weight(flights(spark, sf_dir), "total_fare", "w")
    return w.groupBy("travel_class").agg(rnd(F.avg("w")).alias("mean_weight"), rnd(F.min("w")).alias("min_weight"),
                                         rnd(F.max("w")).alias("max_weight"))


# F22 ----------------------------------------------------------------------------------------------------------------
@register("f22_json_fallback_keys", """
SELECT event_type, CAST(sum(CAST(coalesce(json_extract_string(props, '$.key'), json_extract_string(props, '$.k'))
  AS BIGINT)) AS BIGINT) AS sum_k, count(*) AS n FROM events GROUP BY event_type""")
def f22_json_fallback_keys(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_type", "props"])
    k = S.json_first("props", "$.key", "$.k")
    return ev.groupBy("event_type").agg(F.sum(k.cast("bigint")).cast("bigint").alias("sum_k"),
                                        F.count(F.lit(1)).alias("n"))
