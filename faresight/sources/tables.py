"""Reading the supplied parquet tables with explicit column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_SCANS: dict = {}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
               spread: bool = False) -> DataFrame:
    """Scan one table (columns pruned at the reader). With ``spread`` a scan
    that yields fewer partitions than the cluster's default parallelism
    (a small file of one row group) is spread round-robin over the cores;
    a large input already has many splits and is left as it is."""
    key = (spark.sparkContext.applicationId, id(spark._jsparkSession), table_path(sf_dir, name))
    df = _SCANS.get(key)
    if df is None:  # plan only: file listing and footer schema are resolved once per session
        df = _SCANS[key] = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*columns) if columns else df
    if spread:
        par = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < par:
            df = df.repartition(par)
    return df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast hint for a table whose row count is bounded by construction
    (one row per partition, per fold, per feature or per model).

    Every other lookup is joined without a hint: adaptive execution measures
    the materialised side at runtime and broadcasts it only below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise it keeps
    the shuffle join (with skew splitting). That runtime measurement is the
    size check, and it costs no extra job.
    """
    return F.broadcast(df)
