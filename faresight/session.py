"""Spark session defaults and lineage cutting.

The checkpoint folder is taken from the session (``spark.checkpoint.dir``),
which on a cluster names a shared file system. A private folder is only
created when nothing is configured and the master is local (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "faresight",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting it from the session conf."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="faresight-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")


_TABLES: list[str] = []
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def track(path: str) -> str:
    """Note a folder that ``release_tables`` may delete."""
    _TABLES.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True))


def release_tables(spark: SparkSession) -> int:
    """Delete the tables that this process has written below the checkpoint folder. Results
    built on them must have been written or collected before; returns the number deleted."""
    n = 0
    while _TABLES:
        n += _delete(spark, _TABLES.pop())
    return n


def drop_table(df: DataFrame) -> None:
    """Delete the table behind a frame that ``materialize`` returned, once nothing reads it
    any more. Other frames are left alone."""
    path = getattr(df, "_table", None)
    if path:
        _delete(df.sparkSession, path)
        if path in _TABLES:
            _TABLES.remove(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table under the session's checkpoint folder
    and read it back, cutting the lineage.

    A lost executor then re-reads the table instead of recomputing the
    upstream plan; a layout decided before the call (range bounds come from
    sampling) is fixed as data (callers keep partition ids and positions as
    columns); and later passes read only the columns they use, vectorised.
    The shuffle files of the write go with it: nothing reads them again.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = track(f"{base}/faresight-tables/{uuid.uuid4().hex}")
    was = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, was)
    out = spark.read.schema(df.schema).parquet(path)
    out._table = path
    return out
