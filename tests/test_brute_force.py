"""Spark operators vs the brute-force statement of the reference, on random rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import brute
from helpers import order, search, tables
from pairscope.operators.features import serving_features
from pairscope.operators.labels import training_set

DAY = "20240110"
DAYS = ["20240106", "20240107", "20240108", "20240109", "20240110"]
users = st.sampled_from(["u1", "u2", "u3", "", "NULL", None])
deps = st.sampled_from(["D0", "D1", None])
arrs = st.sampled_from(["A0", "A1", "A-1", None])
times = st.sampled_from(["08:00:00", "12:00:00", "18:30:00"])
searches = st.builds(search, users, deps, arrs, st.integers(0, 9), st.sampled_from(DAYS), times)
orders = st.builds(order, users, deps, arrs, st.sampled_from(DAYS + ["20230101"]), times,
                   st.sampled_from([0, 1, 1]))
tags = st.tuples(users, st.sampled_from(["is_trader", "is_student", "other"]))
inputs = st.tuples(st.lists(searches, max_size=14), st.lists(searches, max_size=14),
                   st.lists(orders, max_size=10), st.lists(tags, max_size=5))

SETTINGS = settings(max_examples=6, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def _spark_rows(df):
    return {(r["username"], r["search_route"]): r.asDict() for r in df.collect()}


def _same(expected, got):
    assert set(expected) == set(got)
    for k, e in expected.items():
        for col, v in e.items():
            g = got[k][col]
            if isinstance(v, float):
                assert g == pytest.approx(v, rel=1e-12), (k, col)
            else:
                assert g == v, (k, col, g, v)


@SETTINGS
@given(inputs)
def test_serving_matches_brute_force(spark, data):
    lists, otas, ords, tg = data
    got = _spark_rows(serving_features(tables(spark, lists, otas, ords, tg), DAY))
    _same(brute.serving(lists, otas, ords, tg, DAY), got)


@SETTINGS
@given(inputs)
def test_training_matches_brute_force(spark, data):
    lists, otas, ords, tg = data
    # make sure some label-day orders exist
    ords = ords + [order("u1", "D0", "A0", DAY, "12:00:00"), order("u2", "D1", None, DAY, "20:00:00")]
    got = _spark_rows(training_set(tables(spark, lists, otas, ords, tg), DAY))
    _same(brute.training(lists, otas, ords, tg, DAY), got)
