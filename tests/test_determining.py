from pyspark.sql import functions as F

from faresight.operators import drift as DR


def test_duplicates_by_determining_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (2, None), (2, "y")], "k int, s string").withColumn("k2", F.col("k") * 2)
    whole, _ = DR.data_quality(df, df.limit(0), ["k", "s", "k2"], ["s"])
    part, _ = DR.data_quality(df, df.limit(0), ["k", "s", "k2"], ["s"], ["k", "s"])
    assert part.collect() == whole.collect() and part.first()["duplicate_rows"] == 2
