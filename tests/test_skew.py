"""A user with far more than a third of all searches: bounded work per task, same results."""

import pytest
from pyspark.sql import functions as F

import brute
from helpers import order, search, tables
from pairscope.operators.features import by_user, cell_aggregates, serving_features, serving_log

RUN = "20240110"
ROUTES = [("D0", "A0"), ("D1", "A1"), ("D2", None), ("D3", "A3")]


def _data():
    hot = [search("hot", dep, arr, i % 30, ("20240108", "20240109")[i % 2], f"{10 + i % 12}:00:00")
           for i in range(3000) for dep, arr in [ROUTES[i % len(ROUTES)]]]
    cold = [search(f"u{i}", "D0", "A1", i, "20240109") for i in range(40)]
    orders = [order("hot", "D0", "A0", "20231201"), order("u3", "D0", "A1", "20240109")]
    return hot, cold, orders


def test_hot_user_is_bounded_after_cell_aggregation(spark):
    hot, cold, orders = _data()
    t = tables(spark, lists=hot + cold, otas=hot[:500], orders=orders)
    cells = by_user(cell_aggregates(serving_log(t, [RUN])))
    # 3,500 raw rows of the hot user become one row per (route, cities, anchor)
    assert cells.where(F.col("username") == "hot").count() == len(ROUTES)
    biggest = cells.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest <= len(ROUTES) + 40


def test_hot_user_results_match_brute_force(spark):
    hot, cold, orders = _data()
    lists, otas = hot + cold, hot[:500]
    got = {(r["username"], r["search_route"]): r.asDict()
           for r in serving_features(tables(spark, lists=lists, otas=otas, orders=orders), RUN).collect()}
    expected = brute.serving(lists, otas, orders, [], RUN)
    assert set(got) == set(expected)
    for k, e in expected.items():
        for col, v in e.items():
            g = got[k][col]
            assert (g == pytest.approx(v, rel=1e-12)) if isinstance(v, float) else g == v, (k, col, g, v)
