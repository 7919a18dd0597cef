"""Run log, model registry and feature profile as plain parquet tables
(M8–M11). Appends are distributed writes; look-ups are top-1 queries.

Tables under a base folder:
  runs/       run_id, experiment, run_name, ts, model, family, flavor, champion,
              params map<string,string>, metrics map<string,double>, tags map<string,string>
  versions/   name, version int, run_id, ts
  aliases/    name, alias, version int, ts
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from hashlib import sha256

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("experiment", T.StringType()),
    T.StructField("run_name", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("model", T.StringType()), T.StructField("family", T.StringType()),
    T.StructField("flavor", T.StringType()), T.StructField("champion", T.BooleanType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])


def _now():
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def runs_from_metrics(results: DataFrame, experiment: str, model_col: str = "model",
                      metric_cols: Sequence[str] = ("r2", "mae", "rmse", "mape", "medae"),
                      champion: str | None = None, family: str = "regressor", flavor: str = "spark",
                      tags: dict | None = None) -> DataFrame:
    """M8: one run row per model of a comparison table (no driver loop)."""
    now = _now()
    present = [m for m in metric_cols if m in results.columns]
    metrics = F.map_from_arrays(F.array(*[F.lit(m.upper() if m != "r2" else "R2") for m in present]),
                                F.array(*[F.col(m).cast("double") for m in present]))
    params_cols = [c for c in results.columns if c.startswith("param_")]
    params = (F.map_from_arrays(F.array(*[F.lit(c[6:]) for c in params_cols]),
                                F.array(*[F.col(c).cast("string") for c in params_cols]))
              if params_cols else F.create_map().cast("map<string,string>"))
    tag_map = F.create_map(*[x for k, v in (tags or {}).items() for x in (F.lit(k), F.lit(v))]) \
        if tags else F.create_map().cast("map<string,string>")
    return results.select(
        F.md5(F.concat_ws("|", F.lit(experiment), F.col(model_col).cast("string"), F.lit(str(now)))).alias("run_id"), F.lit(experiment).alias("experiment"),
        F.col(model_col).alias("run_name"), F.lit(now).cast("timestamp").alias("ts"),
        F.col(model_col).alias("model"), F.lit(family).alias("family"), F.lit(flavor).alias("flavor"),
        (F.col(model_col) == F.lit(champion)).alias("champion") if champion else F.lit(False).alias("champion"),
        params.alias("params"), metrics.alias("metrics"), tag_map.alias("tags"))


def log_runs(runs: DataFrame, base: str) -> None:
    """Append run rows to ``base/runs``."""
    runs.select(*[f.name for f in RUN_SCHEMA.fields]).write.mode("append").parquet(f"{base}/runs")


def read_runs(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(f"{base}/runs")


def best_run(runs: DataFrame, metric: str, ascending: bool = False, experiment: str | None = None) -> DataFrame:
    """M9: the run with the best ``metrics[metric]``; runs without it lose."""
    r = runs if experiment is None else runs.where(F.col("experiment") == experiment)
    m = F.col("metrics")[metric]
    return r.where(m.isNotNull()).orderBy(m.asc() if ascending else m.desc(), F.col("ts").desc()).limit(1)


def _claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist; False if another writer has it."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    try:
        if fs.getScheme() == "file":        # the local file system's own create is not exclusive
            return jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).createNewFile()
        fs.create(p, False).close()
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
            return False
        raise


def register_version(spark: SparkSession, base: str, name: str, run_id: str) -> int:
    """Next numeric version of ``name`` (numeric not string order), unique under any number
    of writers: a version is taken by creating its commit file, which only one writer can; the
    others try the next number. A writer that is lost after that leaves a number unused."""
    path = f"{base}/versions"
    try:
        cur = spark.read.parquet(path).where(F.col("name") == name).agg(F.max("version").alias("v")).first()["v"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        cur = None  # the first version of the first model
    v = (cur or 0) + 1
    folder = f"{base}/_commits/{sha256(name.encode()).hexdigest()}"
    while not _claim(spark, f"{folder}/{v}"):
        v += 1
    row = spark.createDataFrame([(name, v, run_id, _now())], "name string, version int, run_id string, ts timestamp")
    _append_file(spark, row, base, path)
    return v


def _append_file(spark: SparkSession, df: DataFrame, base: str, path: str) -> None:
    """Append by moving finished files in: writers that append to one folder at the same time
    would share its folder of unfinished files, and the first to end would delete it."""
    jvm = spark._jvm
    part = f"{base}/_staging/{uuid.uuid4().hex}"
    df.write.parquet(part)
    src, dst = jvm.org.apache.hadoop.fs.Path(part), jvm.org.apache.hadoop.fs.Path(path)
    fs = dst.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(dst)
    for f in fs.listStatus(src):
        if f.getPath().getName().startswith("part-"):
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(dst, f.getPath().getName()))
    fs.delete(src, True)


def set_alias(spark: SparkSession, base: str, name: str, alias: str, version: int) -> None:
    spark.createDataFrame([(name, alias, int(version), _now())], "name string, alias string, version int, ts timestamp") \
        .write.mode("append").parquet(f"{base}/aliases")


def resolve_version(versions: DataFrame, aliases: DataFrame | None, name: str, alias: str = "production") -> DataFrame:
    """The version an alias points at (latest assignment wins), else the
    latest numeric version. One row: name, version, source."""
    latest = (versions.where(F.col("name") == name).agg(F.max(F.col("version").cast("int")).alias("v"))
              .select(F.lit(name).alias("name"), F.col("v").alias("version"), F.lit("latest").alias("source")))
    if aliases is None:
        return latest
    w = Window.partitionBy("name", "alias").orderBy(F.col("ts").desc())  # assignments of one alias: a short history
    al = (aliases.where((F.col("name") == name) & (F.col("alias") == alias))
          .withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
          .select("name", F.col("version").cast("int").alias("version"), F.lit("alias").alias("source")))
    return al.unionByName(latest).orderBy(F.when(F.col("source") == "alias", 0).otherwise(1)).limit(1)


def feature_profile(train: DataFrame, test: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str]) -> dict:
    """The profile tables of a feature matrix — schema record (E13),
    counts (A11), numeric stats with sanitised metric names (A6, F17), null
    totals (A7) and top-30 category counts (A10). Returns DataFrames; write
    them with ``faresight.sources.io``."""
    from faresight.functions.scalar import sanitize_metric_name
    from faresight.operators.features import feature_schema
    from faresight.operators.profile import numeric_profile, top_category_counts, total_nulls
    counts = train.agg(F.count(F.lit(1)).alias("train_rows")).select(
        F.lit(len(train.columns)).alias("num_features_total"), F.lit(len(cat_cols)).alias("num_categorical"),
        F.lit(len(num_cols)).alias("num_numeric"), "train_rows",
        F.lit(test.count()).alias("test_rows"))
    stats = numeric_profile(train, list(num_cols)).withColumn(
        "metric_name", F.concat(F.lit("feat_"), sanitize_metric_name("feature"), F.lit("__"), F.col("stat")))
    nulls = total_nulls(train).withColumnRenamed("null_count", "train_null_count").select(
        "train_null_count", F.lit(total_nulls(test).first()["null_count"]).alias("test_null_count"))
    return {"schema": feature_schema(train, cat_cols, num_cols), "params": counts, "stats": stats, "nulls": nulls,
            "categories": top_category_counts(train, list(cat_cols), 30)}
