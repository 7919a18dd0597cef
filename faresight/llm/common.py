"""Shared tables, skew-safe joins and connected components for the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from faresight.session import ensure_checkpoint_dir, track

#: A key is heavy when it holds at least 1/HEAVY of the counted rows, so there are at most HEAVY heavy keys.
HEAVY = 1000


class Workspace:
    """A private folder below ``spark.checkpoint.dir`` for the written tables of one
    operator call. ``table`` cuts the lineage: an executor that is lost later costs a
    re-read, not a recomputation. ``drop`` deletes what the result no longer reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        track(self.path)

    def folder(self, name: str) -> str:
        self.n += 1
        return f"{self.path}/{self.n:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.folder(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._llm_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for f in frames:
            path = getattr(f, "_llm_path", f if isinstance(f, str) else None)
            if path:
                p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_back(rows: DataFrame, stats: DataFrame, keys: list[str], total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``stats`` (one row per key, ``cnt`` = the key's rows).

    Keys that hold 1/HEAVY of all ``total`` rows or more (at most HEAVY of them, since the
    counts add up to the total) are joined by a broadcast of that proven size; the rest, in
    which no key is large any more, by a shuffle. So no task gets all rows of a hot key."""
    heavy = F.broadcast(stats.filter(F.col("cnt") * HEAVY >= F.lit(total)))
    light = stats.filter(F.col("cnt") * HEAVY < F.lit(total)).drop("cnt")
    hot = rows.join(heavy.drop("cnt"), keys, "inner")
    rest = rows.join(heavy.select(*keys), keys, "left_anti").join(light, keys, how)
    return hot.unionByName(rest)


def checksum(df: DataFrame, *cols: str) -> tuple:
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected ``edges`` (u, v); component = the
    smallest node reachable. Alternates large-star and small-star steps until the edges are
    stars around the minima: a logarithmic number of rounds, each one aggregate and one join,
    nothing but a row count and a checksum on the driver."""
    e = ws.table(edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
                 .filter("a <> b").distinct(), "edges")
    was = checksum(e, "a", "b")
    while was[0]:
        both = e.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
            e.select(F.col("b").alias("x"), F.col("a").alias("y")))
        least = ws.table(both.groupBy("x").agg(F.min("y").alias("m"), F.count(F.lit(1)).alias("cnt"))
                         .withColumn("m", F.least("m", "x")), "large-min")
        large = join_back(both.filter("y > x"), least, ["x"], 2 * was[0])
        mid = ws.table(large.select(F.col("y").alias("a"), F.col("m").alias("b")).distinct(), "large")
        n = mid.count()
        least2 = ws.table(mid.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("cnt")), "small-min")
        small = join_back(mid, least2, ["a"], n).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = ws.table(small.unionByName(least2.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = checksum(new, "a", "b")
        ws.drop(e, least, mid, least2)
        e = new
        if now == was:
            break
        was = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
