from faresight.operators import encode as EN


def test_one_hot_stages_index_all_columns_in_one_pass(spark):
    stages = EN.one_hot_stages(["a", "b"])
    assert [type(s).__name__ for s in stages] == ["StringIndexer", "OneHotEncoder"]
    df = spark.createDataFrame([("x", "p"), ("y", "q"), ("x", "r")], "a string, b string")
    m = EN.feature_pipeline(["a", "b"], [], encoding="onehot").fit(df)
    assert [list(x) for x in m.stages[0].labelsArray] == [["x", "y"], ["p", "q", "r"]]


def test_scaler_keeps_nulls_out_and_needs_no_wide_aggregate(spark):
    df = spark.createDataFrame([(1.0, None, 4), (3.0, None, 4), (None, None, 4)], "a double, b double, c int")
    m = EN.PopulationScaler(["a", "b", "c"]).fit(df)
    assert m.stats == {"a": (2.0, 1.0), "b": (None, None), "c": (4.0, 0.0)}
