"""Training set on hand-written rows (label day 2024-01-10)."""

import pytest

from helpers import order, rows_by, search, sorted_rows, tables
from pairscope.operators.labels import pre_order_searches, training_set
from pairscope.windows import TRAINING, DateWindows, Offsets

L = "20240110"


def test_fanout_time_residual_and_having_edge(spark):
    # Searches on L-1 .. L so that search times can fall before, between and
    # after the two order times of the label day.
    windows = DateWindows(searches=Offsets(1, 0), recent_buyers=Offsets(2, 1),
                          history=Offsets(732, 1), output_offset=None)
    orders = [order("u1", "D0", "A0", L, "10:00:00"), order("u1", "D1", "A1", L, "15:00:00")]
    orders += [order("u2", "D3", "A3", L, "11:00:00")] * 20      # 20 orders: route dropped
    orders += [order("u2", "D3", "A0", L, "11:00:00")] * 19      # 19 orders: kept
    t = tables(spark, lists=[
        search("u1", "D0", "A0", 4, L, "09:00:00"),    # before both: counted twice
        search("u1", "D2", "A2", 6, L, "12:00:00"),    # between: counted once
        search("u1", "D1", "A1", 8, L, "16:00:00"),    # after both: dropped
        search("u2", "D3", "A3", 9, "20240109", "08:00:00"),
    ], orders=orders)
    rows = rows_by(training_set(t, L, windows), "username", "search_route")
    assert set(rows) == {("u1", "D0-A0"), ("u1", "D2-A2"), ("u2", "D3-A3")}
    a, b = rows[("u1", "D0-A0")], rows[("u1", "D2-A2")]
    assert (a["search_route_single_cnt"], b["search_route_single_cnt"], a["search_route_cnt"]) == (2, 1, 3)
    assert a["search_rate"] == pytest.approx(2 / 3)
    # weighted average: (4*2 + 6*1) / 3 over the user is not a feature; per route it is the value
    assert (a["search_pre_days_avg"], b["search_pre_days_avg"]) == (4.0, 6.0)
    assert (a["label"], b["label"]) == (1, 0)
    assert (a["route_cnt"], a["label_dt"]) == (2, L)
    # D3-A3 left the label set (20 orders) but D3-A0 keeps u2 in with fan-out 1
    c = rows[("u2", "D3-A3")]
    assert (c["label"], c["search_route_single_cnt"]) == (0, 1)
    fan = {(r["username"], r["search_route"]): r["fanout"]
           for r in pre_order_searches(t, L, windows).collect()}
    assert fan == {("u1", "D0-A0"): 2, ("u1", "D2-A2"): 1, ("u2", "D3-A3"): 1}


def test_recent_buyers_excluded_history_kept_null_route_label(spark):
    t = tables(spark, lists=[
        search("u3", "D0", "A0", 1, "20240109"),
        search("u4", "D0", "A0", 2, "20240108"),
        search("u4", "D1", None, 3, "20240109"),
    ], otas=[search("u4", "D0", "A0", 5, "20240109")], orders=[
        order("u3", "D0", "A0", L), order("u3", "D2", "A2", "20240109"),   # also paid on L-1
        order("u4", "D0", "A0", L), order("u4", "D1", None, L),            # null order route
        order("u4", "D0", "A0", "20240107"),                               # L-3: history
    ])
    rows = rows_by(training_set(t, [L], TRAINING), "username", "search_route")
    assert set(rows) == {("u4", "D0-A0"), ("u4", None)}
    r = rows[("u4", "D0-A0")]
    # two order routes (one null) -> every search counted twice
    assert (r["search_route_single_cnt"], r["ota_route_single_cnt"]) == (2, 2)
    assert (r["label"], r["has_history_route"]) == (1, 1)
    assert rows[("u4", None)]["label"] == 0
    assert (r["dep_city_cnt"], r["arr_city_cnt"]) == (2, 1)


def test_pooled_label_days_equal_single_days(spark):
    t = tables(spark, lists=[
        search("u1", "D0", "A0", 1, "20240108"), search("u1", "D1", "A1", 2, "20240109"),
        search("u2", "D0", "A0", 3, "20240109"), search("u2", "D0", "A1", 4, "20240110"),
    ], orders=[
        order("u1", "D0", "A0", "20240110"), order("u1", "D1", "A1", "20240111"),
        order("u2", "D0", "A1", "20240111"), order("u1", "D0", "A0", "20240105"),
    ])
    days = ["20240110", "20240111"]
    pooled = sorted_rows(training_set(t, days))
    single = sorted(sum((sorted_rows(training_set(t, d)) for d in days), []),
                    key=lambda r: tuple((x is None, str(x)) for x in r))
    assert pooled == single and pooled


def test_training_history_window_edges(spark):
    t = tables(spark, lists=[
        search("u5", "D0", "A0", 1, "20240109"), search("u5", "D1", "A1", 1, "20240109"),
    ], orders=[
        order("u5", "D2", "A2", L),
        order("u5", "D0", "A0", "20220108"),    # L-732: first history day
        order("u5", "D1", "A1", "20220107"),    # L-733: outside
    ])
    rows = rows_by(training_set(t, L), "username", "search_route")
    assert rows[("u5", "D0-A0")]["has_history_route"] == 1
    assert rows[("u5", "D1-A1")]["has_history_route"] == 0
