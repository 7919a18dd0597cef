import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from faresight.operators.prefix import exact_quantiles, prefix_sums, with_row_index


def test_row_index_is_global_sorted_position(spark):
    rng = np.random.default_rng(1)
    vals = rng.integers(0, 50, 500).tolist()
    df = spark.createDataFrame([(int(v), i) for i, v in enumerate(vals)], "v long, i long")
    out = with_row_index(df, [F.col("v"), F.col("i")], num_partitions=7).toPandas()
    exp = sorted(range(500), key=lambda i: (vals[i], i))
    assert out.sort_values("row_idx")["i"].tolist() == exp
    assert sorted(out["row_idx"].tolist()) == list(range(500))


def test_grouped_prefix_sums_match_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 300, p=[0.7, 0.2, 0.1]), "k": np.arange(300),
                        "w": rng.integers(1, 5, 300)})
    df = spark.createDataFrame(pdf)
    got = prefix_sums(df, ["k"], ["w"], ["g"], num_partitions=5).toPandas().sort_values(["g", "k"])
    exp = pdf.sort_values(["g", "k"]).groupby("g")["w"].cumsum()
    assert got["cum_w"].tolist() == exp.tolist()


def test_exact_quantiles_match_numpy_linear(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g, n in (("one", 1), ("two", 2), ("ten", 10), ("eleven", 11), ("big", 400)):
        rows += [(g, float(x)) for x in rng.integers(0, 30, n)]  # ties included
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, "v", probs, ["g"], num_partitions=6).toPandas().set_index("g")
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, part in pdf.groupby("g"):
        exp = np.percentile(part["v"].to_numpy(), [p * 100 for p in probs])
        assert np.allclose(got.loc[g, [f"q_{i}" for i in range(len(probs))]].to_numpy(dtype=float), exp)


def test_exact_quantiles_ignore_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert exact_quantiles(df, "v", [0.5]).first()["q_0"] == 2.0


def test_row_index_with_adaptive_partition_count(spark):
    rng = np.random.default_rng(5)
    vals = rng.integers(0, 1000, 3000).tolist()
    df = spark.createDataFrame([(int(v), i) for i, v in enumerate(vals)], "v long, i long").repartition(5)
    out = with_row_index(df, [F.col("v"), F.col("i")]).toPandas()
    exp = sorted(range(3000), key=lambda i: (vals[i], i))
    assert out.sort_values("row_idx")["i"].tolist() == exp


def test_wall_clock_elapsed_ignores_session_zone(spark):
    import datetime as dt
    from faresight.functions.scalar import elapsed_hours
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 4, 30, 0, 500000))],
                                   "a timestamp_ntz, b timestamp_ntz")
        assert df.select(elapsed_hours("a", "b")).first()[0] == 3.0 + 0.5 / 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
