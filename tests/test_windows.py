"""Date windows and the anchor mapping."""

import pytest

from pairscope.operators.logs import anchor_map, assign_anchors
from pairscope.windows import SERVING, TRAINING, Offsets, date_range, shift


def test_shift_and_ranges_cross_month_and_leap_year():
    assert shift("20240301", -1) == "20240229"
    assert shift("20240130", -731) == "20220129"
    assert SERVING.history.bounds("20240130") == ("20220129", "20240127")
    assert TRAINING.history.bounds("20240120") == ("20220118", "20240119")
    assert date_range("20240227", "20240302") == ["20240227", "20240228", "20240229", "20240301", "20240302"]


def test_anchors_are_grouped_by_history_window():
    with pytest.raises(ValueError):
        SERVING.check_anchors([])
    assert SERVING.anchor_groups(["20240101", "20200101", "20200105"]) == [["20200101", "20200105"], ["20240101"]]
    assert SERVING.anchor_groups("20240101") == [["20240101"]]
    assert SERVING.check_anchors(["20240103", "20240102", "20240103"]) == ["20240102", "20240103"]


def test_anchor_map_and_assignment(spark):
    w = Offsets(2, 1)
    rows = {(r.dt, r.anchor_dt) for r in anchor_map(spark, ["20240105", "20240106"], w).collect()}
    assert rows == {("20240103", "20240105"), ("20240104", "20240105"),
                    ("20240104", "20240106"), ("20240105", "20240106")}
    df = spark.createDataFrame([("a", "20240104"), ("b", "20240105"), ("c", "20240106")], "k string, dt string")
    got = sorted((r.k, r.anchor_dt) for r in assign_anchors(df, ["20240105", "20240106"], w).collect())
    assert got == [("a", "20240105"), ("a", "20240106"), ("b", "20240106")]
    single = sorted((r.k, r.anchor_dt) for r in assign_anchors(df, ["20240105"], w).collect())
    assert single == [("a", "20240105")]
