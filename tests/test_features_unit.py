"""Serving features on hand-written rows (run date 2024-01-10)."""

import pytest

from helpers import order, rows_by, search, sorted_rows, tables
from pairscope.operators.features import serving_features

R = "20240110"          # searches and recent buyers: 0108..0109, history 20220109..20240107
D1, D2 = "20240108", "20240109"


@pytest.fixture(scope="module")
def feats(spark):
    t = tables(
        spark,
        lists=[
            search("a", "D0", "A0", 10, D1), search("a", "D0", "A0", 20, D2), search("a", "D1", "A1", 5, D2),
            search("c", "D0", None, 3, D1), search("c", "D1", None, 4, D2), search("c", "D0", "A1", 6, D2),
            search("d", "D0", "A0", 1, D1),                         # recent buyer: excluded
            search("", "D0", "A0", 1, D1), search("NULL", "D0", "A0", 1, D1),
            search("null", "D0", "A0", 1, D1), search(None, "D0", "A0", 1, D1),
            search("a", "D0", "A0", 99, "20240107"),                # outside the search window
        ],
        otas=[search("b", "D2", "A2", 7, D2)],
        orders=[
            order("d", "D0", "A0", D2),                             # paid on R-1
            order("a", "D3", "A3", D2, pay_ok=0),                   # unpaid: does not exclude a
            order("a", "D0", "A0", "20220109"),                     # R-731: first history day
            order("b", "D2", "A2", "20240107"),                     # R-3: last history day
            order("c", "D0", "A1", "20220108"),                     # R-732: outside
        ],
        tags=[("a", "is_trader"), ("b", "is_student"), ("b", "other"), ("c", "other")],
    )
    return rows_by(serving_features(t, R), "username", "search_route")


def test_rows_and_exclusions(feats):
    assert set(feats) == {("a", "D0-A0"), ("a", "D1-A1"), ("b", "D2-A2"), ("c", None), ("c", "D0-A1")}
    assert {r["dt"] for r in feats.values()} == {"20240109"}


def test_list_only_user_zero_ota_denominator_and_fallback(feats):
    r = feats[("a", "D0-A0")]
    assert (r["route_cnt"], r["search_route_cnt"], r["search_route_single_cnt"]) == (2, 3, 2)
    assert r["search_rate"] == pytest.approx(2 / 3)
    assert (r["ota_route_cnt"], r["ota_route_single_cnt"], r["ota_rate"]) == (0, 0, None)
    assert (r["search_pre_days_max"], r["search_pre_days_min"], r["search_pre_days_avg"]) == (20.0, 10.0, 15.0)
    # one-way fallback: ota lead days take the search values
    assert (r["ota_pre_days_max"], r["ota_pre_days_min"], r["ota_pre_days_avg"]) == (20.0, 10.0, 15.0)
    assert (r["dep_city_cnt"], r["arr_city_cnt"]) == (2, 2)


def test_ota_only_user_keeps_null_search_lead_days(feats):
    r = feats[("b", "D2-A2")]
    assert r["search_rate"] is None and r["ota_rate"] == 1.0
    assert r["search_pre_days_max"] is None
    assert r["ota_pre_days_max"] == 7.0


def test_null_route_is_one_group_across_departure_cities(feats):
    r = feats[("c", None)]
    assert r["route_cnt"] == 2 and r["search_route_single_cnt"] == 2
    assert (r["dep_city_cnt"], r["arr_city_cnt"]) == (2, 1)
    assert r["has_history_route"] == 0


def test_history_window_edges(feats):
    assert feats[("a", "D0-A0")]["has_history_route"] == 1     # R-731 inclusive
    assert feats[("a", "D1-A1")]["has_history_route"] == 0
    assert feats[("b", "D2-A2")]["has_history_route"] == 1     # R-3 inclusive
    assert feats[("c", "D0-A1")]["has_history_route"] == 0     # R-732 outside


def test_tags_null_when_untagged(feats):
    assert (feats[("a", "D0-A0")]["is_trader"], feats[("a", "D0-A0")]["is_student"]) == (1, 0)
    assert (feats[("b", "D2-A2")]["is_trader"], feats[("b", "D2-A2")]["is_student"]) == (0, 1)
    assert (feats[("c", None)]["is_trader"], feats[("c", None)]["is_student"]) == (None, None)


def test_backfill_equals_daily_runs(spark):
    """Several run dates in one pass give the same rows as one run per date."""
    t = tables(
        spark,
        lists=[search("a", "D0", "A0", 1, "20240105"), search("a", "D1", "A0", 2, "20240106"),
               search("b", "D0", "A0", 3, "20240106"), search("b", "D0", "A1", 4, "20240107")],
        otas=[search("a", "D0", "A0", 5, "20240107")],
        orders=[order("b", "D0", "A0", "20240105"), order("a", "D0", "A0", "20240104")],
        tags=[],
    )
    runs = ["20240106", "20240107", "20240108"]
    together = sorted_rows(serving_features(t, runs))
    single = sorted(sum((sorted_rows(serving_features(t, d)) for d in runs), []),
                    key=lambda r: tuple((x is None, str(x)) for x in r))
    assert together == single and together
