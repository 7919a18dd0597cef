"""Registered source/sink round trips (S1–S8, S10) and column selection (P1, P2, P4): each writes a result
derived from the supplied tables under the session's checkpoint folder
with the library's sinks, reads it back with its scans and returns what was
read, so that the DuckDB oracle (computed directly from the tables) checks
the whole write → read path."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from faresight.plans.common import SCORED_CTES, SPLIT_CTES, scored_test, split_flights
from faresight.plans.registry import register, rnd
from faresight.session import ensure_checkpoint_dir
from faresight.sources import io as IO
from faresight.sources.flights import flights, with_flights


def _scratch(spark, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io/{what}-{uuid.uuid4().hex}"


# S1 / S3 / S2 -----------------------------------------------------------------------------------------
_VIEW_TO_RAW = {v: k for k, v in IO.RAW_TO_VIEW.items()}


@register("s1_csv_staging_roundtrip", with_flights("""
SELECT airline, travel_class, count(*) AS n, round(sum(total_fare), 2) AS sum_total_fare,
       sum(days_before) AS sum_days_before, round(sum(duration_hrs), 2) AS sum_duration_hrs,
       strftime(min(departure), '%Y-%m-%d %H:%M:%S') AS first_departure,
       strftime(max(arrival), '%Y-%m-%d %H:%M:%S') AS last_arrival
FROM flights GROUP BY airline, travel_class"""))
def s1_csv_staging_roundtrip(spark, sf_dir):
    """The flight view written as the raw header CSV (reference
    column names, text timestamps), staged CSV → parquet with the explicit
    raw schema, scanned back and renamed/parsed to the view."""
    csv_path, pq_path = _scratch(spark, "raw-csv"), _scratch(spark, "staged")
    raw = flights(spark, sf_dir).select(
        *[(F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c in ("departure", "arrival") else F.col(c)).alias(raw_name)
          for c, raw_name in _VIEW_TO_RAW.items()])
    raw.write.mode("overwrite").option("header", True).csv(csv_path)
    IO.stage_csv_to_parquet(spark, csv_path, pq_path)
    view = IO.raw_to_view(IO.read_parquet(spark, pq_path))
    return view.groupBy("airline", "travel_class").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("total_fare"), 2).alias("sum_total_fare"),
        F.sum("days_before").alias("sum_days_before"), rnd(F.sum("duration_hrs"), 2).alias("sum_duration_hrs"),
        F.date_format(F.min("departure"), "yyyy-MM-dd HH:mm:ss").alias("first_departure"),
        F.date_format(F.max("arrival"), "yyyy-MM-dd HH:mm:ss").alias("last_arrival"))


# S4 / S2 ----------------------------------------------------------------------------------------------
@register("s4_split_artifacts_roundtrip", with_flights("""
SELECT split, count(*) AS n, min(row_idx) AS first_row, max(row_idx) AS last_row,
       round(sum(total_fare), 2) AS sum_total_fare
FROM splitf GROUP BY split""", *SPLIT_CTES))
def s4_split_artifacts_roundtrip(spark, sf_dir):
    """The split written as one parquet dataset partitioned by
    split (target kept as a column); each side is read back by partition
    pruning on the split directory."""
    path = _scratch(spark, "splits")
    IO.write_splits(split_flights(spark, sf_dir).select("row_idx", "split", "total_fare"), path)
    back = IO.read_parquet(spark, path)
    sides = [back.where(F.col("split") == s) for s in ("train", "test")]
    both = sides[0].unionByName(sides[1])
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("row_idx").alias("first_row"),
                                     F.max("row_idx").alias("last_row"),
                                     rnd(F.sum("total_fare"), 2).alias("sum_total_fare"))


# S5 ---------------------------------------------------------------------------------------------------
@register("s5_predictions_roundtrip", with_flights(
    "SELECT row_idx, round(prediction, 4) AS prediction FROM scored", *SCORED_CTES))
def s5_predictions_roundtrip(spark, sf_dir):
    """Group-mean predictions of the test rows written keyed by row
    index and read back."""
    path = _scratch(spark, "predictions")
    IO.write_predictions(scored_test(spark, sf_dir), path, ["row_idx"])
    return IO.read_parquet(spark, path).select("row_idx", rnd("prediction", 4).alias("prediction"))


# S6 ---------------------------------------------------------------------------------------------------
@register("s6_sample_sink", with_flights("""
SELECT row_idx, airline, travel_class, total_fare
FROM train ORDER BY row_idx LIMIT 200""", *SPLIT_CTES))
def s6_sample_sink(spark, sf_dir):
    """The first 200 training rows (a top-n by row index, the feature of
    this sink) written as parquet and read back."""
    path = _scratch(spark, "sample")
    train = split_flights(spark, sf_dir).where(F.col("split") == "train")
    IO.write_sample(train.select("row_idx", "airline", "travel_class", "total_fare"), path, ["row_idx"], 200)
    return IO.read_parquet(spark, path).select("row_idx", "airline", "travel_class", "total_fare")


# S7 ---------------------------------------------------------------------------------------------------
_MAPPED = ("airline", "destination", "travel_class")


@register("s7_json_roundtrip", with_flights("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n, round(count(*) / (SELECT count({c}) FROM flights), 8) AS freq FROM flights WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in _MAPPED)))
def s7_json_roundtrip(spark, sf_dir):
    """Frequency maps written as JSON lines with a nested entry, read back with a schema."""
    from faresight.operators.profile import relative_frequency
    path = _scratch(spark, "frequency-maps")
    maps = relative_frequency(flights(spark, sf_dir), list(_MAPPED))
    IO.write_json(maps.select("column", F.struct("value", F.col("count").alias("n"), rnd("freq", 8).alias("freq")).alias("entry")), path)
    back = spark.read.schema("column string, entry struct<value:string,n:long,freq:double>").json(path)
    return back.select("column", "entry.value", "entry.n", "entry.freq")


# P1 / P2 / P4 -----------------------------------------------------------------------------------------
_NUMBERS = ("days_before", "duration_hrs", "total_fare")


@register("p1_column_selection", with_flights("\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", round(sum({c}), 2) AS total, count({c}) AS n FROM flights" for i, c in enumerate(_NUMBERS))))
def p1_column_selection(spark, sf_dir):
    """Leaky columns dropped (absent names ignored), the numeric ones taken by type
    and put in a fixed order; their totals."""
    from faresight.operators import features as FE
    from faresight.operators.profile import unpivot
    f = FE.drop_if_present(flights(spark, sf_dir), ["base_fare", "tax", "a column that is not there"])
    numbers = sorted(FE.numeric_columns(f, exclude=("order_key", "line_no")))
    x = FE.reorder_like(f, numbers)
    at = F.array_position(F.array(*[F.lit(c) for c in numbers]), F.col("column")) - 1
    long = unpivot(x, [], numbers, "column", "v", cast="decimal(38,6)")
    return long.groupBy("column").agg(F.sum("v").alias("t"), F.count("v").alias("n")).select(at.cast("int").alias("position"), "column", rnd("t", 2).alias("total"), "n")


# S8 ---------------------------------------------------------------------------------------------------
@register("s8_csv_sink_roundtrip", with_flights("""
SELECT airline, count(*) AS n, round(avg(total_fare), 4) AS mean_total_fare,
       CAST(to_json(list_sort(list(DISTINCT travel_class))) AS VARCHAR) AS classes
FROM flights GROUP BY airline"""))
def s8_csv_sink_roundtrip(spark, sf_dir):
    """A per-airline summary with an array column written as header CSV
    (the array rendered as JSON text) and read back with an explicit schema."""
    path = _scratch(spark, "summary-csv")
    summary = flights(spark, sf_dir).groupBy("airline").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("total_fare"), 4).alias("mean_total_fare"),
        F.array_sort(F.collect_set("travel_class")).alias("classes"))  # ≤ #classes values per airline
    IO.write_csv(summary, path)
    back = spark.read.schema("airline string, n long, mean_total_fare double, classes string") \
        .option("header", True).csv(path)
    return back


# S10 --------------------------------------------------------------------------------------------------
_RUNS = ("20260101_020000", "20260104_020000")


@register("s10_report_partitions", with_flights(" UNION ALL ".join(
    f"""SELECT '{ts}' AS run_ts, travel_class, count(*) AS n, round(avg(total_fare), 4) AS mean_total_fare
FROM {side} GROUP BY travel_class""" for ts, side in zip(_RUNS, ("train", "test"))), *SPLIT_CTES))
def s10_report_partitions(spark, sf_dir):
    """Two runs of a per-class report appended under one report name,
    partitioned by their run timestamp, read back with the run as a column."""
    base = _scratch(spark, "reports")
    s = split_flights(spark, sf_dir)
    for ts, side in zip(_RUNS, ("train", "test")):
        rep = s.where(F.col("split") == side).groupBy("travel_class").agg(
            F.count(F.lit(1)).alias("n"), rnd(F.avg("total_fare"), 4).alias("mean_total_fare"))
        IO.write_report(rep, base, "class_report", ts)
    back = IO.read_parquet(spark, f"{base}/class_report")
    return back.select(F.col("run_ts").cast("string").alias("run_ts"), "travel_class", "n", "mean_total_fare")
