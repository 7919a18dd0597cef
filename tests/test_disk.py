"""What the shared steps leave on disk, and that they return what they did."""

import os
import time

import pytest
from pyspark.sql import functions as F

from faresight.plans import common, q_eval
from faresight.session import drop_table, materialize


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, fs in os.walk(d.getPath()) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}


def _left(spark, before, tries=50):
    for _ in range(tries):
        left = _shuffle_files(spark) - before
        if not left:
            return set()
        time.sleep(0.1)
    return left


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    df = spark.range(5000, numPartitions=4).withColumn("k", F.col("id") % 97).groupBy("k").agg(F.sum("id").alias("s"))
    x = materialize(df)
    assert not _left(spark, before)
    assert {r["k"]: r["s"] for r in df.collect()} == {r["k"]: r["s"] for r in x.collect()}      # the frame still works
    assert x.count() == 97


def test_drop_table_deletes_only_its_own(spark):
    a, b = materialize(spark.range(10)), materialize(spark.range(20))
    drop_table(a)
    assert not os.path.exists(a._table.removeprefix("file:")) and b.count() == 20
    drop_table(b.where("id > 3"))          # another frame: nothing is deleted
    assert b.count() == 20


def test_narrow_scored_frame_reads_two_keys_and_the_target(spark, sf_dir, monkeypatch):
    seen = []
    was = q_eval.split_flights
    monkeypatch.setattr(q_eval, "split_flights", lambda s, d, *c: seen.append(c) or was(s, d, *c))
    q_eval.v2_by_fare_segment(spark, sf_dir)
    assert seen == [(*common.PRED_KEYS, q_eval.Y)]


@pytest.mark.parametrize("full", [False, True])
def test_positions_equal_the_sort_of_the_whole_view(spark, sf_dir, full):
    from pyspark.sql import Window
    from faresight.sources.flights import flights
    s = common.split_flights(spark, sf_dir, *(() if full else ("row_idx", "total_fare", "tax")))
    w = Window.orderBy(F.col("departure").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in common.TIEBREAK])
    want = flights(spark, sf_dir).select((F.row_number().over(w) - 1).alias("row_idx"), "total_fare", "tax")
    assert sorted(map(tuple, s.select("row_idx", "total_fare", "tax").collect())) == sorted(map(tuple, want.collect()))
