"""Shared building blocks of the registered analyses, in Spark and in the
DuckDB oracle dialect: the temporal 80/20 split of the flight view and the
test set scored by the train group mean of (class, destination)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from faresight.operators.lookup import group_mean_predictor
from faresight.operators.split import temporal_flag, temporal_positions, temporal_split
from faresight.roles import ENGINEERED_CAT, FLIGHT_ROLES
from faresight.session import materialize
from faresight.sources.flights import flights

FLIGHT_COLUMNS = ("airline", "source", "source_name", "destination", "destination_name", "departure", "arrival",
                  "duration_hrs", "stopovers", "aircraft_type", "travel_class", "booking_source", "seasonality",
                  "days_before", "base_fare", "tax", "total_fare", "order_key", "line_no")
# Tie-break after the departure time: key-like columns first (comparisons
# end early), then every other column, so equal sort keys mean identical rows.
TIEBREAK = ("order_key", "line_no") + tuple(c for c in FLIGHT_COLUMNS if c not in ("departure", "order_key", "line_no"))
TEST_SIZE = 0.2
PRED_KEYS = ("travel_class", "destination")


def staged_flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of the flight view, joined once and written as a table: an analysis
    that passes over its rows several times then reads a narrow file instead of repeating the
    joins."""
    return materialize(flights(spark, sf_dir).select(*columns))


# The features of the fitted model: 12 categorical, 15 built numeric and 4 frequency columns.
FEATURE_CAT = ENGINEERED_CAT
FEATURE_NUM = ("duration_hrs", "days_before", "month", "day_of_week", "hour", "month_sin", "month_cos", "hour_sin", "hour_cos",
               "is_weekend", "is_peak", "log_duration", "duration_sq", "log_days_before", "is_direct")
FEATURE_FREQ = tuple(f"{c}_freq" for c in FLIGHT_ROLES.freq)


def sql_features(src: str, extra: str = "row_idx, split, total_fare") -> str:
    """SELECT of the built features (E1, not rounded) from a CTE of flights."""
    from faresight.plans.q_profile import E1_SQL
    body = re.sub(r"round\((.*?), 6\) AS", r"\1 AS", E1_SQL[E1_SQL.rindex("SELECT airline, source, destination"):])
    return body.replace("SELECT airline,", f"SELECT {extra}, airline,", 1).replace("FROM flights", f"FROM {src}")


def sql_feature_ctes(name: str = "fe") -> tuple[str, ...]:
    """CTEs of all features of both splits, the frequencies fitted on train."""
    freq = [f"""fq_{c} AS (SELECT {c} AS v, count(*) / (SELECT count({c}) FROM {name}0 WHERE split = 'train') AS f FROM {name}0
  WHERE split = 'train' AND {c} IS NOT NULL GROUP BY 1)""" for c in FLIGHT_ROLES.freq]
    cols = ", ".join(f"coalesce(fq_{c}.f, 0.0) AS {c}_freq" for c in FLIGHT_ROLES.freq)
    joins = " ".join(f"LEFT JOIN fq_{c} ON fq_{c}.v = b.{c}" for c in FLIGHT_ROLES.freq)
    return f"{name}0 AS ({sql_features('splitf')})", *freq, f"{name} AS (SELECT b.*, {cols} FROM {name}0 b {joins})"


# The raw columns that the feature builder reads, with the target.
FEATURE_RAW = (*FLIGHT_ROLES.cat, *FLIGHT_ROLES.num, "departure", "total_fare")


def split_flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The flight view with ``split`` and ``row_idx``; with ``columns``, only those and
    ``split``: the table is then sorted only if ``row_idx`` is among them."""
    f = flights(spark, sf_dir)
    if not columns:
        return temporal_split(f, "departure", TEST_SIZE, TIEBREAK)
    names = [c for c in FLIGHT_COLUMNS if c in columns]        # in the order of the view
    if "row_idx" in columns:
        return temporal_positions(f, "departure", names, TEST_SIZE, TIEBREAK)
    return temporal_flag(f, "departure", names, TEST_SIZE, TIEBREAK, rows_at=lambda at_cut: flights(spark, sf_dir, at_cut))


def scored_test(spark: SparkSession, sf_dir: str, keys=PRED_KEYS, split: DataFrame | None = None) -> DataFrame:
    s = split if split is not None else split_flights(spark, sf_dir)
    train = s.where(F.col("split") == "train")
    test = s.where(F.col("split") == "test")
    return group_mean_predictor(train, test, list(keys), "total_fare")


_ORDER = ", ".join(["departure ASC NULLS LAST"] + [f"{c} ASC NULLS LAST" for c in TIEBREAK])

SPLIT_CTES = (f"""ranked AS (
  SELECT f.*, CAST(row_number() OVER (ORDER BY {_ORDER}) - 1 AS BIGINT) AS row_idx FROM flights f
)""", f"""splitf AS (
  SELECT r.*, CASE WHEN row_idx < (SELECT CAST(floor(count(*) * (1.0::DOUBLE - {TEST_SIZE}::DOUBLE)) AS BIGINT)
                                   FROM flights) THEN 'train' ELSE 'test' END AS split
  FROM ranked r
)""", """train AS (SELECT * FROM splitf WHERE split = 'train')""",
               """test AS (SELECT * FROM splitf WHERE split = 'test')""")


def sql_group_mean_scored(name: str, keys, src_test: str = "test", src_train: str = "train") -> tuple[str, ...]:
    """CTEs ``{name}_lk`` and ``{name}`` (test rows with prediction, matched)."""
    k = ", ".join(keys)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    using = ", ".join(keys)
    return (f"""{name}_lk AS (SELECT {k}, avg(total_fare) AS _pred FROM {src_train} WHERE {notnull} GROUP BY {k})""",
            f"""{name} AS (
  SELECT t.*, coalesce(l._pred, (SELECT avg(total_fare) FROM {src_train})) AS prediction, l._pred IS NOT NULL AS matched
  FROM {src_test} t LEFT JOIN {name}_lk l USING ({using})
)""")


SCORED_CTES = SPLIT_CTES + sql_group_mean_scored("scored", PRED_KEYS)
