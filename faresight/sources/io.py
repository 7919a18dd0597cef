"""Sources and sinks (S1–S10): CSV/parquet scans, split/prediction/sample
writers, JSON and CSV artefacts, and the drift-report reader that accepts
both report layouts."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Schema of the raw flight CSV (17 columns, reference names and types).
RAW_FLIGHT_SCHEMA = T.StructType([
    T.StructField("Airline", T.StringType()), T.StructField("Source", T.StringType()),
    T.StructField("Source Name", T.StringType()), T.StructField("Destination", T.StringType()),
    T.StructField("Destination Name", T.StringType()), T.StructField("Departure Date & Time", T.StringType()),
    T.StructField("Arrival Date & Time", T.StringType()), T.StructField("Duration (hrs)", T.DoubleType()),
    T.StructField("Stopovers", T.StringType()), T.StructField("Aircraft Type", T.StringType()),
    T.StructField("Class", T.StringType()), T.StructField("Booking Source", T.StringType()),
    T.StructField("Seasonality", T.StringType()), T.StructField("Days Before Departure", T.IntegerType()),
    T.StructField("Base Fare (BDT)", T.DoubleType()), T.StructField("Tax & Surcharge (BDT)", T.DoubleType()),
    T.StructField("Total Fare (BDT)", T.DoubleType()),
])

# Raw CSV column → flight-view column.
RAW_TO_VIEW = {
    "Airline": "airline", "Source": "source", "Source Name": "source_name", "Destination": "destination",
    "Destination Name": "destination_name", "Departure Date & Time": "departure", "Arrival Date & Time": "arrival",
    "Duration (hrs)": "duration_hrs", "Stopovers": "stopovers", "Aircraft Type": "aircraft_type",
    "Class": "travel_class", "Booking Source": "booking_source", "Seasonality": "seasonality",
    "Days Before Departure": "days_before", "Base Fare (BDT)": "base_fare", "Tax & Surcharge (BDT)": "tax",
    "Total Fare (BDT)": "total_fare",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_FLIGHT_SCHEMA) -> DataFrame:
    """Header CSV with an explicit schema; a missing path raises FileNotFoundError."""
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"Dataset not found at {path}") from e
        raise


def raw_to_view(df: DataFrame, ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Rename the raw columns to view names and parse the two timestamps
    (unparsable → null)."""
    out = df.select(*[F.col(f"`{k}`").alias(v) for k, v in RAW_TO_VIEW.items() if k in df.columns])
    for c in ("departure", "arrival"):
        if c in out.columns:
            out = out.withColumn(c, F.try_to_timestamp(F.col(c), F.lit(ts_format)))
    return out


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """S2."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def stage_csv_to_parquet(spark: SparkSession, csv_path: str, out: str, schema: T.StructType = RAW_FLIGHT_SCHEMA) -> None:
    """S3: CSV → parquet staging."""
    read_csv(spark, csv_path, schema).write.mode("overwrite").parquet(out)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One parquet dataset partitioned by split (the target stays a column)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def write_predictions(df: DataFrame, path: str, key: Sequence[str], prediction: str = "prediction") -> None:
    """Predictions keyed by row key."""
    df.select(*key, prediction).write.mode("overwrite").parquet(path)


def write_sample(df: DataFrame, path: str, order: Sequence[str], n: int = 200) -> None:
    """The first ``n`` rows in a fixed order (a top-n, not a scan of all rows to the driver)."""
    df.orderBy(*order).limit(n).write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines (maps, arrays and structs are kept nested)."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; complex columns are rendered as JSON text."""
    simple = df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                         if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)) else F.col(f.name)
                         for f in df.schema.fields])
    simple.write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, base: str, name: str, run_ts: str | None = None) -> str:
    """Append a report under ``base/name`` partitioned by ``run_ts``."""
    ts = run_ts or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    df.withColumn("run_ts", F.lit(ts)).write.mode("append").partitionBy("run_ts").parquet(f"{base}/{name}")
    return ts


# S9 / F22 ------------------------------------------------------------------------------------------
def read_drift_report(spark: SparkSession, path: str) -> DataFrame:
    """Metric entries of a drift report JSON in either layout:
    ``metric_results``/``metrics`` list; ``type``/``metric``; ``column``/
    ``column_name``; ``value``/``result`` as a number or an object with
    ``count``/``number_of_drifted_columns`` and ``drift_detected``.

    Returns (metric_type, column, number, count, drift_detected); a file
    that is not valid JSON yields no rows and ``parse_ok`` false.
    """
    raw = spark.read.text(path, wholetext=True)
    arr = F.coalesce(F.get_json_object("value", "$.metric_results"), F.get_json_object("value", "$.metrics"))
    doc = raw.select(F.from_json(arr, T.ArrayType(T.StringType())).alias("entries"),
                     F.try_parse_json(F.col("value")).isNotNull().alias("parse_ok"))
    e = doc.select("parse_ok", F.explode_outer("entries").alias("e"))

    def first(*paths):
        return F.coalesce(*[F.get_json_object("e", p) for p in paths])
    val = first("$.value", "$.result")
    return e.select(
        "parse_ok",
        first("$.type", "$.metric").alias("metric_type"),
        first("$.column", "$.column_name").alias("column"),
        val.try_cast("double").alias("number"),
        F.coalesce(F.get_json_object(val, "$.count"), F.get_json_object(val, "$.number_of_drifted_columns"))
        .try_cast("long").alias("count"),
        F.get_json_object(val, "$.drift_detected").try_cast("boolean").alias("drift_detected"))


def decision_from_report(spark: SparkSession, path: str, share_threshold: float = 0.3) -> DataFrame:
    """M6 over a report file: no file → retrain (safety); unparsable →
    retrain; else share = drifted ÷ max(#ValueDrift entries, 1) and retrain
    when share ≥ threshold."""
    schema = "needs_retraining boolean, drift_detected boolean, drift_share double, n_drifted_features long, " \
             "triggers array<string>"
    try:
        entries = read_drift_report(spark, path)
        entries.first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame(
            [(True, False, 0.0, 0, ["No drift report found — retraining as safety measure"])], schema)
    kind = F.coalesce(F.col("metric_type"), F.lit(""))
    agg = entries.agg(
        F.bool_and("parse_ok").alias("ok"),
        F.coalesce(F.max(F.when(kind.contains("DriftedColumnsCount"),
                                F.coalesce(F.col("count"), F.col("number").cast("long")))), F.lit(0)).alias("nd"),
        F.sum(kind.contains("ValueDrift").cast("long")).alias("nt"))
    share = F.col("nd") / F.greatest(F.coalesce(F.col("nt"), F.lit(0)), F.lit(1))
    msg = F.concat(F.lit("Data drift detected: "), F.col("nd").cast("string"), F.lit("/"),
                   F.coalesce(F.col("nt"), F.lit(0)).cast("string"), F.lit(" features ("),
                   F.format_number(share * 100, 1), F.lit(f"%) exceeded {share_threshold:.0%} threshold"))
    trig = (F.when(~F.col("ok"), F.array(F.lit("Could not parse drift report")))
             .when(share >= share_threshold, F.array(msg)).otherwise(F.array().cast("array<string>")))
    return agg.select(
        (F.size(trig) > 0).alias("needs_retraining"),
        (F.col("ok") & (share >= share_threshold)).alias("drift_detected"),
        F.when(F.col("ok"), share).otherwise(F.lit(0.0)).alias("drift_share"),
        F.when(F.col("ok"), F.col("nd")).otherwise(F.lit(0)).cast("long").alias("n_drifted_features"),
        trig.alias("triggers"))
