"""Scans of the search logs, orders and tags, and the small derived sets.

Multi-date runs: every operator here takes a list of *anchor* dates (run dates
for serving, label dates for training) and tags each row with the anchors
whose window contains it (``anchor_dt``).  A row of day d belongs to the
anchors d+near .. d+back, so one scan of the union range serves a whole
backfill; each row is repeated at most ``back - near + 1`` times (2 for the
search and recent-buyer windows), by a broadcast join with the small
day-to-anchor map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (PROCESS_LIST, PROCESS_OTA, TAG_STUDENT, TAG_TRADER,
                                 route_sql, valid_user_sql)
from ..sources.tables import SourceTables
from ..windows import Offsets, parse, shift, shift_sql

ANCHOR = "anchor_dt"
USER = "username"
ROUTE = "search_route"


def anchor_map(spark: SparkSession, anchors: list[str], window: Offsets) -> DataFrame:
    """(dt, anchor_dt) for every day in every anchor's window.

    Its size is known on the driver: len(anchors) x (back - near + 1) rows."""
    rows = [(shift(a, -k), a) for a in anchors for k in range(window.near, window.back + 1)]
    return spark.createDataFrame(rows, "dt string, anchor_dt string")


def assign_anchors(df: DataFrame, anchors: list[str], window: Offsets, dt: str = "dt") -> DataFrame:
    """Add ``anchor_dt`` = every anchor A with A-back <= dt <= A-near.

    One anchor: a literal.  Several: an equi-join with the small day-to-anchor
    map, broadcast (its size is bounded by the parameters), which repeats a
    row once per anchor whose window contains its day."""
    if len(anchors) == 1:
        lo, hi = window.bounds(anchors[0])
        return df.where(f"`{dt}` BETWEEN '{lo}' AND '{hi}'").withColumn(ANCHOR, F.lit(anchors[0]))
    amap = F.broadcast(anchor_map(df.sparkSession, anchors, window).withColumnRenamed("dt", dt))
    return df.join(amap, on=dt, how="inner")


def _search_rows(log: DataFrame, process: str) -> DataFrame:
    return (log.where(valid_user_sql("username"))
               .selectExpr(f"username AS {USER}", f"{route_sql()} AS {ROUTE}",
                           "dep_city", "arr_city", "pre_days",
                           "concat(search_date, ' ', search_time) AS log_time",
                           f"'{process}' AS process", "dt"))


def unified_search_log(tables: SourceTables, lo: str, hi: str) -> DataFrame:
    """S1 + S2 + U1: both search logs in [lo, hi], valid users, route key, source tag."""
    return (_search_rows(tables.list_log(lo, hi), PROCESS_LIST)
            .unionByName(_search_rows(tables.ota_log(lo, hi), PROCESS_OTA)))


def anchored_search_log(tables: SourceTables, anchors: list[str], window: Offsets) -> DataFrame:
    lo, hi = window.span(anchors)
    return assign_anchors(unified_search_log(tables, lo, hi), anchors, window)


def paid_orders(tables: SourceTables, lo: str, hi: str) -> DataFrame:
    """S3 + F1-F3: paid orders of valid users in [lo, hi], with their route."""
    return (tables.orders(lo, hi)
            .where(f"pay_ok = 1 AND {valid_user_sql(USER)}")
            .selectExpr(USER, f"{route_sql()} AS order_route", "dep_city", "arr_city",
                        "create_time", "dt"))


def recent_buyers(tables: SourceTables, anchors: list[str], window: Offsets) -> DataFrame:
    """A5: distinct (user, anchor) with a paid order in the anchor's window."""
    lo, hi = window.span(anchors)
    rows = paid_orders(tables, lo, hi).select(USER, "dt")
    return assign_anchors(rows, anchors, window).select(USER, ANCHOR).distinct()


def order_history_routes(tables: SourceTables, lo: str, hi: str) -> DataFrame:
    """Distinct (user, route) of paid orders in [lo, hi]."""
    return paid_orders(tables, lo, hi).select(USER, "order_route").distinct()


def history_summary(tables: SourceTables, anchors: list[str], window: Offsets,
                    users: DataFrame | None = None) -> DataFrame:
    """Per (user, route): what the history flag of every anchor needs.

    The flag of anchor A is "a paid order of (user, route) on a day in
    [A-back, A-near]".  With P = min(anchors) - near, a day <= P is in A's
    window iff it is >= A-back, and a day > P is in it iff it is <= A-near
    (anchors lie within back-near days of each other).  So two aggregates
    per (user, route) decide the flag for every anchor, and the two-year
    history is scanned and shuffled once, partially aggregated map-side.
    Days are aggregated as yyyyMMdd integers so that the aggregate is a hash
    aggregate (min/max over strings would fall back to a sort aggregate).

    ``users``: the distinct users whose flags are wanted.  Two years of orders
    of everyone are then cut to theirs before the aggregate, by a left-semi
    join: a broadcast if they are few, else one shuffle by user, which the
    aggregate and the later join with the pairs both reuse.
    """
    lo, hi = window.span(anchors)
    if (parse(max(anchors)) - parse(min(anchors))).days > window.back - window.near:
        raise ValueError("anchors must lie within one history window (see DateWindows.anchor_groups)")
    pivot = int(shift(min(anchors), -window.near))
    day = "try_cast(dt AS INT)"
    orders = paid_orders(tables, lo, hi).where("order_route IS NOT NULL").select(USER, "order_route", "dt")
    if users is not None:
        orders = orders.join(users, on=USER, how="left_semi")
    return (orders.groupBy(USER, "order_route")
            .agg(F.expr(f"max(CASE WHEN {day} <= {pivot} THEN {day} END) AS last_on_or_before_pivot"),
                 F.expr(f"min(CASE WHEN {day} > {pivot} THEN {day} END) AS first_after_pivot")))


def history_flag(anchor: str, window: Offsets) -> Column:
    """P6 on top of ``history_summary`` columns, for the anchor column ``anchor``."""
    near = f"CAST({shift_sql(anchor, -window.near)} AS INT)"
    back = f"CAST({shift_sql(anchor, -window.back)} AS INT)"
    return F.expr(f"CASE WHEN coalesce(first_after_pivot <= {near} OR last_on_or_before_pivot >= {back}, false) "
                  "THEN 1 ELSE 0 END")


def user_tag_flags(tables: SourceTables, users: DataFrame | None = None) -> DataFrame:
    """S4 + F4 + A9: tall tags -> one row per key with two 0/1 flags (of ``users`` only, if given)."""
    tags = tables.user_tags().where(f"tag IN ('{TAG_TRADER}', '{TAG_STUDENT}')")
    if users is not None:
        tags = tags.join(users.withColumnRenamed(USER, "key"), on="key", how="left_semi")
    return (tags.groupBy("key")
            .agg(F.expr(f"max(CASE WHEN tag = '{TAG_TRADER}' THEN 1 ELSE 0 END) AS is_trader"),
                 F.expr(f"max(CASE WHEN tag = '{TAG_STUDENT}' THEN 1 ELSE 0 END) AS is_student")))
