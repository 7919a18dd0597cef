import datetime as dt

import pytest

from faresight.operators import split as SP

SCHEMA = "id long, ts timestamp, a string, y double"


def _rows(n=120, null_every=29, days=7):
    base = dt.datetime(2024, 1, 1)
    return [(i // 2, base + dt.timedelta(days=i % days) if i % null_every else None, "ab"[i % 2], float(i % 5)) for i in range(n)]



@pytest.mark.parametrize("rows", [
    _rows(), _rows(days=1), _rows(null_every=2), _rows(null_every=1), _rows(days=5, n=100, null_every=101), [(1, None, "a", 1.0)] * 10, []])
def test_flag_agrees_with_the_sorted_split(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    full = SP.temporal_split(df, "ts", 0.2, ["id", "a", "y"])
    flag = SP.temporal_flag(df, "ts", ["a", "y"], 0.2, ["id", "a", "y"])
    assert flag.columns == ["a", "y", "split"]
    assert sorted(map(str, flag.collect())) == sorted(map(str, full.select("a", "y", "split").collect()))
    placed = SP.temporal_positions(df, "ts", ["y"], 0.2, ["id", "a", "y"])
    assert placed.columns == ["y", "row_idx", "split"]
    assert sorted(map(str, placed.collect())) == sorted(map(str, full.select("y", "row_idx", "split").collect()))


def test_flag_does_not_sort_the_table(spark, monkeypatch):
    """Only the rows of the time at the cut get positions."""
    ordered = []
    real = SP.row_index_and_count
    monkeypatch.setattr(SP, "row_index_and_count", lambda df, *a, **k: ordered.append(df.count()) or real(df, *a, **k))
    df = spark.createDataFrame(_rows(n=140, null_every=1000), SCHEMA)
    SP.temporal_flag(df, "ts", ["y"], 0.2, ["id", "a", "y"]).count()
    assert ordered == [20]
