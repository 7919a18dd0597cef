import datetime as dt
import math

from pyspark.sql import functions as F

from faresight.functions import scalar as S


def _col(spark, values, dtype="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_clip_keeps_null(spark):
    out = [r[0] for r in _col(spark, [-2.0, None, 3.0]).select(S.clip_lower("x", 0.0)).collect()]
    assert out == [0.0, None, 3.0]


def test_cut_labels_right_closed_edges(spark):
    vals = [0.0, 2.0, 3.0, 5.0, 7.0, 999.0, 1000.0, -1.0, None]
    got = [r[0] for r in _col(spark, vals).select(
        S.cut_labels("x", S.BOOKING_WINDOW_EDGES, S.BOOKING_WINDOW_LABELS)).collect()]
    assert got == ["last_min", "last_min", "last_min", "3_7d", "3_7d", "2mo_plus", "nan", "nan", "nan"]


def test_flags_treat_null_as_zero(spark):
    df = spark.createDataFrame([(5,), (None,), (2,)], "d int")
    assert [r[0] for r in df.select(S.is_weekend("d")).collect()] == [1, 0, 0]
    m = spark.createDataFrame([(6,), (7,), (None,)], "m int")
    assert [r[0] for r in m.select(S.in_set_flag("m", S.PEAK_MONTHS)).collect()] == [1, 0, 0]


def test_weekday_monday_zero_and_parse(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("garbage",)], "s string")
    ts = S.parse_ts("s", "yyyy-MM-dd HH:mm:ss")
    r = df.select(S.day_of_week(ts).alias("d"), S.hour(ts).alias("h"), S.day_name(ts).alias("n")).collect()
    assert (r[0]["d"], r[0]["h"], r[0]["n"]) == (0, 10, "Monday")
    assert r[1]["d"] is None


def test_crosses(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b")], "x string, y string")
    r = df.select(S.cross("x", "y").alias("c"), S.cross_str("x", "y").alias("s")).collect()
    assert (r[0]["c"], r[0]["s"]) == ("a__b", "a__b")
    assert (r[1]["c"], r[1]["s"]) == (None, "nan__b")


def test_equal_width_codes_match_pandas_cut(spark):
    # pd.cut(range(11), bins=10, labels=False): first edge at -0.01, right-closed
    expected = [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    df = _col(spark, [float(i) for i in range(11)])
    got = [r[0] for r in df.select(S.equal_width_code("x", F.lit(0.0), F.lit(10.0), 10)).collect()]
    assert got == expected


def test_code_from_display_and_sanitize_and_serve(spark):
    df = spark.createDataFrame([("Dhaka (DAC)", "a b#c", -5.0), ("Plain", "x/y.z", 12.345)], "d string, n string, p double")
    r = df.select(S.code_from_display("d"), S.sanitize_metric_name("n"), S.serve_prediction("p")).collect()
    assert [tuple(x) for x in r] == [("DAC", "a b_c", 0.0), ("Plain", "x/y.z", 12.35)]


def test_cyclic_and_recode(spark):
    df = spark.createDataFrame([(3, "Business"), (12, "Unknown")], "m int, c string")
    r = df.select(S.cyclic_sin("m", 12).alias("s"), S.recode("c", S.CLASS_ORDINAL, 1).alias("k")).collect()
    assert math.isclose(r[0]["s"], 1.0, abs_tol=1e-12) and r[0]["k"] == 2 and r[1]["k"] == 1


def test_elapsed_hours(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 2, 30)
    df = spark.createDataFrame([(a, b)], "a timestamp, b timestamp")
    assert df.select(S.elapsed_hours("a", "b")).first()[0] == 2.5
