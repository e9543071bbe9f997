"""The training set: features of (user, route) pairs labelled by later purchases.

For a label day L the reference takes the users who paid on L (routes with
fewer than 20 orders that day, users who did not also pay on L-2 .. L-1),
joins each of their searches of L-2 .. L-1 to *each* ordered route whose last
order time is not earlier than the search, and builds the serving features on
that joined set.  A search is therefore counted once per such route (the
"fan-out"), and the label says whether the searched route is one of the
user's ordered routes.

Here the join emits no pairs: each user-day's ordered routes travel as sorted
arrays, and each search row gets its multiplicity (by halving the array, so a
buyer of very many routes costs a logarithm of them per search)

    fanout = #{ordered routes r of the user-day : last_order_time(r) >= log_time}

and its label membership directly; rows with fanout 0 are the ones the inner
join drops.  The features are then the serving aggregates with ``fanout`` as
the row weight (counts become sums, averages weighted averages).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TRAINING_COLUMNS
from ..session import stored
from ..sources.tables import SourceTables
from ..windows import MAX_ORDERS_PER_ROUTE, TRAINING, DateWindows
from .features import assemble, feature_exprs, pair_aggregates
from .logs import ANCHOR, ROUTE, USER, anchored_search_log, paid_orders, recent_buyers

USER_KEYS = [USER, ANCHOR]


def _anchors(label_dates, windows: DateWindows) -> list[str]:
    return windows.check_anchors(label_dates)


def label_day_orders(tables: SourceTables, label_dates: list[str] | str,
                     windows: DateWindows = TRAINING) -> DataFrame:
    """A7 + A8: per (user, label day, route) the last order time, routes
    ordered 20 times or more that day removed."""
    anchors = _anchors(label_dates, windows)
    return (_label_day_paid(tables, anchors)
            .withColumnRenamed("dt", ANCHOR)
            .groupBy(USER, ANCHOR, "order_route")
            .agg(F.expr("max(create_time) AS create_time_max"),
                 F.expr("CAST(count(1) AS INT) AS order_cnt"))
            .where(f"order_cnt < {MAX_ORDERS_PER_ROUTE}"))


def _label_day_paid(tables: SourceTables, anchors: list[str]) -> DataFrame:
    days = ", ".join(f"'{a}'" for a in anchors)
    return paid_orders(tables, anchors[0], anchors[-1]).where(f"dt IN ({days})")


def with_route_set_size(label_orders: DataFrame) -> DataFrame:
    """W4 on top of the HAVING: ``size(collect_set(route))`` per user-day, i.e.
    the number of non-null routes left after the 20-order cut."""
    return label_orders.selectExpr(
        "*", f"CAST(count(order_route) OVER (PARTITION BY {USER}, {ANCHOR}) AS INT) AS route_set_cnt")


def label_orders_without_recent_buyers(tables: SourceTables, label_dates: list[str] | str,
                                       windows: DateWindows = TRAINING) -> DataFrame:
    """Drop label-day buyers who also paid in the two days before."""
    anchors = _anchors(label_dates, windows)
    return (label_day_orders(tables, anchors, windows)
            .join(recent_buyers(tables, anchors, windows.recent_buyers), on=USER_KEYS, how="left_anti"))


def first_not_below(array: str, value: str) -> str:
    """SQL text: the first index (from 0) of a sorted array whose element is not below ``value``, by halving."""
    middle = "(s.lo + s.hi) div 2"
    return (f"aggregate(sequence(1, cast(ceil(log2(size({array}) + 1)) as int) + 1), named_struct('lo', 0, 'hi', size({array})), "
            f"(s, i) -> if(s.lo >= s.hi, s, if({array}[cast({middle} as int)] < {value}, "
            f"named_struct('lo', cast({middle} as int) + 1, 'hi', s.hi), named_struct('lo', s.lo, 'hi', cast({middle} as int)))), s -> s.lo)")


def order_sets(label_orders: DataFrame) -> DataFrame:
    """W4 as one row per (user, label day): the last order times and the
    ordered routes, both in ascending order, so that a search is placed among
    them by halving.  Its size is bounded by the routes one user orders in a day.

    The user is passed through a computed key, so that a join shuffles this
    small side on its own: with a shuffle right below both sides adaptive
    execution can split a user with very many searches."""
    return (label_orders.groupBy(USER, ANCHOR)
            .agg(F.expr("sort_array(collect_list(create_time_max)) AS order_times"),
                 F.expr("sort_array(collect_set(order_route)) AS order_routes"))
            .withColumn(USER, F.expr(f"concat({USER}, '')")))


def pre_order_searches(tables: SourceTables, label_dates: list[str] | str,
                       windows: DateWindows = TRAINING, orders: DataFrame | None = None) -> DataFrame:
    """J1 + F5 + P7 per search row: ``fanout`` (its multiplicity in the
    reference join) and ``in_label`` (searched route is an ordered route).
    ``orders``: the label-day orders, if they are at hand."""
    anchors = _anchors(label_dates, windows)
    if orders is None:
        orders = label_orders_without_recent_buyers(tables, anchors, windows)
    log = anchored_search_log(tables, anchors, windows.searches)
    joined = log.join(order_sets(orders), on=USER_KEYS)
    return (joined.where("log_time <= element_at(order_times, -1)")
            .selectExpr(
                "*",
                f"size(order_times) - {first_not_below('order_times', 'log_time')} AS fanout",
                # a null route never matches (null -> label 0)
                f"coalesce(get(order_routes, {first_not_below('order_routes', ROUTE)}) = {ROUTE}, false) AS in_label")
            .drop("order_times", "order_routes"))


def training_set(tables: SourceTables, label_dates: list[str] | str,
                 windows: DateWindows = TRAINING) -> DataFrame:
    """One labelled feature row per (user, route, label day).

    The label-day orders (a row per buyer and route) and the cells are stored
    once each (this starts jobs), so every source is read once."""
    def group(anchors: list[str]) -> DataFrame:
        orders = stored(label_orders_without_recent_buyers(tables, anchors, windows), "label-orders")
        pairs = pair_aggregates(pre_order_searches(tables, anchors, windows, orders), weight="fanout")
        feats = assemble(tables, pairs, anchors, windows, orders.select(USER).distinct())
        return feats.selectExpr(*feature_exprs(), "label", f"{ANCHOR} AS label_dt")

    out = reduce(DataFrame.unionByName, [group(a) for a in windows.anchor_groups(label_dates)])
    assert out.columns == TRAINING_COLUMNS
    return out
