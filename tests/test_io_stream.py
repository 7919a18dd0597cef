import pytest
from pyspark.sql import functions as F

from faresight.operators import models as MD
from faresight.plans.common import split_flights
from faresight.sources import io as IO
from faresight.streaming.scoring import score, score_stream


def test_csv_scan_missing_path_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        IO.read_csv(spark, str(tmp_path / "absent.csv")).count()


def test_raw_csv_roundtrip_and_staging(spark, sf_dir, tmp_path):
    s = split_flights(spark, sf_dir)
    inv = {v: k for k, v in IO.RAW_TO_VIEW.items()}
    raw = s.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(inv[c]) if c in ("departure", "arrival")
                     else F.col(c).alias(inv[c]) for c in IO.RAW_TO_VIEW.values()])
    raw.write.option("header", True).csv(str(tmp_path / "raw"))
    back = IO.raw_to_view(IO.read_csv(spark, str(tmp_path / "raw")))
    assert back.count() == s.count() and back.where(F.col("departure").isNull()).count() == 0
    IO.stage_csv_to_parquet(spark, str(tmp_path / "raw"), str(tmp_path / "staged"))
    assert spark.read.parquet(str(tmp_path / "staged")).count() == s.count()


def test_split_writer_sample_and_csv_sink(spark, sf_dir, tmp_path):
    s = split_flights(spark, sf_dir)
    IO.write_splits(s.select("row_idx", "split", "total_fare"), str(tmp_path / "splits"))
    test_only = spark.read.parquet(str(tmp_path / "splits")).where(F.col("split") == "test")
    assert test_only.count() == s.where("split = 'test'").count()
    IO.write_sample(s.select("row_idx", "total_fare"), str(tmp_path / "sample"), ["row_idx"], 200)
    assert spark.read.parquet(str(tmp_path / "sample")).count() == 200
    m = spark.createDataFrame([("a", {"x": 1.0})], "k string, m map<string,double>")
    IO.write_csv(m, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["m"] == '{"x":1.0}'
    ts = IO.write_report(m, str(tmp_path / "reports"), "drift", run_ts="20240101_000000")
    assert spark.read.parquet(str(tmp_path / "reports/drift")).where(F.col("run_ts") == ts).count() == 1


def test_stream_scoring_equals_batch(spark, sf_dir, tmp_path):
    s = split_flights(spark, sf_dir)
    tr, te = s.where("split = 'train'"), s.where("split = 'test'")
    m = MD.fit_model(tr, "DecisionTree", MD.preset("DecisionTree")[1], keep=["row_idx"])
    src = tmp_path / "requests"
    te.drop("split").repartition(3).write.parquet(str(src))
    batch = score(m, spark.read.parquet(str(src)), keep=["row_idx"])
    q = score_stream(m, spark.readStream.schema(spark.read.parquet(str(src)).schema).parquet(str(src)),
                     str(tmp_path / "out"), str(tmp_path / "ck"), keep=["row_idx"])
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    a = {r["row_idx"]: (r["reason"], r["predicted_fare"]) for r in batch.collect()}
    b = {r["row_idx"]: (r["reason"], r["predicted_fare"]) for r in got.collect()}
    assert a == b and len(a) == te.count()


def test_stream_rejects_what_batch_rejects(spark, sf_dir, tmp_path):
    """All eight option lists, missing fields and negative numbers, batch and stream alike."""
    from faresight.plans.q_eval import requests
    from faresight.roles import FLIGHT_ROLES
    s = split_flights(spark, sf_dir)
    tr, te = s.where("split = 'train'"), s.where("split = 'test'")
    m = MD.fit_model(tr, "DecisionTree", MD.preset("DecisionTree", "quick")[1], keep=["row_idx"])
    src = tmp_path / "requests"
    requests(te).drop("split").repartition(3).write.parquet(str(src))
    domains = {c: tr for c in FLIGHT_ROLES.cat}
    batch = score(m, spark.read.parquet(str(src)), keep=["row_idx"], domains=domains)
    q = score_stream(m, spark.readStream.schema(spark.read.parquet(str(src)).schema).parquet(str(src)),
                     str(tmp_path / "out"), str(tmp_path / "ck"), keep=["row_idx"], domains=domains)
    q.awaitTermination()
    a, b = ({r["row_idx"]: (r["reason"], r["predicted_fare"]) for r in d.collect()} for d in (batch, spark.read.parquet(str(tmp_path / "out"))))
    assert a == b and len(a) == te.count()
    assert {r for r, _ in a.values()} == {"valid", "missing_field", "negative_duration_hrs", "negative_days_before", *(f"unknown_{c}" for c in FLIGHT_ROLES.cat)}
    assert all((p is None) == (r != "valid") for r, p in a.values())
