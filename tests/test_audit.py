import datetime as dt
import re

import pytest

from faresight.operators.profile import audit

SCHEMA = "a string, b double, c int, d string, e double, f timestamp_ntz"
ROWS = [("x", 0.0, 1, "x", float("nan"), dt.datetime(2024, 1, 1)), ("x", -0.0, None, None, float("nan"), None),
        (None, None, 2, "", 1.5, dt.datetime(2024, 1, 1)), ("x", 0.0, 1, "x", None, None), ("Y", 3.0, 1, "y", 2.5, None)]
WANT = [(0, "a", "string", 1, 2), (1, "b", "double", 1, 2), (2, "c", "int", 1, 2), (3, "d", "string", 1, 3),
        (4, "e", "double", 1, 3), (5, "f", "timestamp_ntz", 3, 1)]


def test_nulls_and_distinct_values(spark):
    assert [tuple(r) for r in audit(spark.createDataFrame(ROWS, SCHEMA)).collect()] == WANT


@pytest.mark.parametrize("approx", [False, True])
def test_no_rows(spark, approx):
    got = [tuple(r) for r in audit(spark.createDataFrame([], SCHEMA), approx).collect()]
    assert got == [(i, c, t, None, 0) for i, c, t, _, _ in WANT]


def test_copies_of_a_row_are_one_value_wide(spark):
    """Distinct counts of all columns in one aggregate copied every row, all columns wide, once a column."""
    plan = audit(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    widths = [len(x.split(",")) for x in re.findall(r"Expand .*\[([^\[\]]*)\]\s*$", plan, re.M)]
    assert widths and max(widths) <= 2
