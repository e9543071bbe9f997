"""One feature row per (user, route): the serving query and its parts.

Formulation (aggregate first):

1. Raw rows are grouped to *cells* (user, anchor, route, dep_city, arr_city)
   with numeric aggregates only (counts or weight sums, min, max, sums), so the
   raw-row aggregate is a code-generated hash aggregate with map-side partial
   aggregation before the only shuffle of raw rows.  (A string or set
   aggregate here would force a sort-based or object aggregate over every raw
   row.)  Cells are nearly pairs: a route fixes its cities except for the null
   route.  They are stored once: the user values, the pairs and the set of
   users are all taken from that table, and each log is read once.
2. User values are aggregates of the cells, one row per (user, anchor):
     search_route_cnt = sum of list counts        (count(if list) over user)
     ota_route_cnt    = sum of ota counts
     dep_city_cnt     = distinct dep_city          (size(collect_set) over user)
     route_cnt        = distinct routes of the user, a null route counting
                        once (count(1) over user after the 1:1 joins)
   Distinct values are (user, anchor, value) rows that spread over all tasks
   and are then counted by partial sums, so no task holds a user's cells.
3. Cells are shuffled once, by user, and fold into pairs with a second hash
   aggregate on that partitioning, streaming; the user values join there.

A hot user never sends its raw rows to one task: partial aggregation leaves
at most one row per cell and map task.  The recent-buyer exclusion, the tag
join and the history join all run on the user partitioning (their small sides
are broadcast, or partitioned by user to match), so no pair row moves twice.
This needs ``spark.sql.requireAllClusterKeysForCoPartition=false`` (set by
``pairscope.session``), which lets a partitioning on the user alone serve
joins keyed by (user, anchor) and (user, route).

Recent-buyer exclusion (J3) drops whole users; it runs on the pair rows
after the user shuffle (see ``exclude_recent_buyers``).

Tags and order history come from the source tables, or from the stored tables
of ``operators.history_state`` and a bucketed tag table, which lie partitioned
by user already.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import PROCESS_LIST, PROCESS_OTA
from ..schemas import FEATURE_COLUMNS
from ..session import stored
from ..sources.partitioned import PartitionedTable
from ..sources.tables import SourceTables
from ..windows import SERVING, DateWindows, shift_sql
from .history_state import HistoryState
from .logs import ANCHOR, ROUTE, USER, anchored_search_log, history_flag, history_summary, recent_buyers, user_tag_flags

PAIR_KEYS = [USER, ANCHOR, ROUTE]
USER_KEYS = [USER, ANCHOR]
CELL_KEYS = PAIR_KEYS + ["dep_city", "arr_city"]
USER_STATS = ["search_route_cnt", "ota_route_cnt", "dep_city_cnt", "arr_city_cnt", "route_cnt"]


def _sum_if(cond: str, value: str) -> str:
    return f"sum(CASE WHEN {cond} THEN {value} END)"


def cell_aggregates(log: DataFrame, weight: str | None = None) -> DataFrame:
    """A1 + A2 partial state per (user, anchor, route, dep_city, arr_city).

    ``weight`` (training) is the multiplicity of each log row: counts become
    sums of weights and averages weighted averages; min/max are unchanged."""
    w = "1" if weight is None else f"`{weight}`"
    aggs = []
    for name, process in (("list", PROCESS_LIST), ("ota", PROCESS_OTA)):
        cond = f"process = '{process}'"
        aggs += [
            f"CAST(coalesce({_sum_if(cond, w)}, 0) AS BIGINT) AS {name}_cnt",
            f"max(CASE WHEN {cond} THEN pre_days END) AS {name}_pre_max",
            f"min(CASE WHEN {cond} THEN pre_days END) AS {name}_pre_min",
            f"CAST({_sum_if(cond, f'{w} * pre_days')} AS BIGINT) AS {name}_pre_sum",
            f"CAST(coalesce({_sum_if(cond + ' AND pre_days IS NOT NULL', w)}, 0) AS BIGINT) AS {name}_pre_n",
        ]
    if "in_label" in log.columns:
        aggs.append("max(CAST(in_label AS INT)) AS label")
    return log.groupBy(*CELL_KEYS).agg(*[F.expr(a) for a in aggs])


def by_user(df: DataFrame) -> DataFrame:
    """Hash-partition on the user alone (the partitioning the feature tail shares)."""
    return df.repartition(USER)


def user_stats(cells: DataFrame) -> DataFrame:
    """W1 + W2 + W3: one row per (user, anchor)."""
    return cells.groupBy(*USER_KEYS).agg(
        F.expr("CAST(sum(list_cnt) AS INT) AS search_route_cnt"),
        F.expr("CAST(sum(ota_cnt) AS INT) AS ota_route_cnt"),
        F.expr("CAST(count(DISTINCT dep_city) AS INT) AS dep_city_cnt"),
        F.expr("CAST(count(DISTINCT arr_city) AS INT) AS arr_city_cnt"),
        # distinct routes, the null route counting once
        F.expr(f"CAST(count(DISTINCT {ROUTE}) + max(CAST({ROUTE} IS NULL AS INT)) AS INT) AS route_cnt"))


def pair_aggregates(log: DataFrame, weight: str | None = None) -> DataFrame:
    """One row per (user, anchor, route) with A1/A2 and the user values of W1-W3.

    The cells of the raw rows are stored first (this starts a job)."""
    return pairs_of(stored(cell_aggregates(log, weight), "cells"))


def pairs_of(cells: DataFrame) -> DataFrame:
    """The pairs of stored cells, partitioned by user."""
    def avg(prefix):
        return f"try_divide(CAST(sum({prefix}_pre_sum) AS DOUBLE), CAST(sum({prefix}_pre_n) AS DOUBLE))"

    aggs = [
        "CAST(sum(list_cnt) AS INT) AS search_route_single_cnt",
        "CAST(sum(ota_cnt) AS INT) AS ota_route_single_cnt",
        "CAST(max(list_pre_max) AS DOUBLE) AS search_pre_days_max",
        "CAST(min(list_pre_min) AS DOUBLE) AS search_pre_days_min",
        f"{avg('list')} AS search_pre_days_avg",
        "CAST(max(ota_pre_max) AS DOUBLE) AS ota_pre_days_max_raw",
        "CAST(min(ota_pre_min) AS DOUBLE) AS ota_pre_days_min_raw",
        f"{avg('ota')} AS ota_pre_days_avg_raw",
    ]
    if "label" in cells.columns:
        aggs.append("max(label) AS label")
    pairs = by_user(cells).groupBy(*PAIR_KEYS).agg(*[F.expr(a) for a in aggs])
    return pairs.join(by_user(user_stats(cells)), USER_KEYS)


def user_aggregates(pairs: DataFrame) -> DataFrame:
    """W1 + W2 + W3 as one row per (user, anchor) (the per-user report)."""
    return pairs.groupBy(*USER_KEYS).agg(*[F.expr(f"max({c}) AS {c}") for c in USER_STATS])


def attach_user_tags(df: DataFrame, tags: DataFrame) -> DataFrame:
    """Left join of the tag flags on the user (untagged users keep nulls)."""
    if "key" in tags.columns:
        tags = tags.withColumnRenamed("key", USER)
    return df.join(tags, on=USER, how="left")


def attach_history_flag(pairs: DataFrame, summary: DataFrame, windows: DateWindows) -> DataFrame:
    """J4 + P6: has_history_route per (user, anchor, route)."""
    joined = pairs.join(summary.withColumnRenamed("order_route", ROUTE), on=[USER, ROUTE], how="left")
    return (joined.withColumn("has_history_route", history_flag(ANCHOR, windows.history))
                  .drop("last_on_or_before_pivot", "first_after_pivot"))


def feature_exprs() -> list[str]:
    """P4 + P5 and the final column list in table order (without dt), as SQL."""
    def rate(part, total):
        # part * 1.0 / total in double; null when total is 0
        return f"try_divide(CAST({part} AS DOUBLE), CAST({total} AS DOUBLE))"

    derived = {
        "search_rate": rate("search_route_single_cnt", "search_route_cnt"),
        "ota_rate": rate("ota_route_single_cnt", "ota_route_cnt"),
        # one-way fallback: ota lead days take the search values when null
        "ota_pre_days_max": "coalesce(ota_pre_days_max_raw, search_pre_days_max)",
        "ota_pre_days_min": "coalesce(ota_pre_days_min_raw, search_pre_days_min)",
        "ota_pre_days_avg": "coalesce(ota_pre_days_avg_raw, search_pre_days_avg)",
    }
    return [f"{derived[c]} AS {c}" if c in derived else c for c in FEATURE_COLUMNS if c != "dt"]


@dataclass
class StoredTables:
    """Tables that daily runs keep: the order history as day bits, and the tag flags of a snapshot day."""
    history: HistoryState | None = None
    tags: PartitionedTable | None = None
    tags_dt: str | None = None


def assemble(tables: SourceTables, pairs: DataFrame, anchors: list[str], windows: DateWindows,
             users: DataFrame, buyers: DataFrame | None = None, kept: StoredTables = StoredTables()) -> DataFrame:
    """Shared tail of serving and training: J3, tags, history flag; ``users``: all users of the pairs."""
    if buyers is not None:
        pairs = exclude_recent_buyers(pairs, buyers)
    tags = user_tag_flags(tables, users) if kept.tags is None else kept.tags.read(kept.tags_dt).drop("dt")
    summary = (history_summary(tables, anchors, windows.history, users) if kept.history is None
               else kept.history.summary(anchors, windows.history))
    return attach_history_flag(attach_user_tags(pairs, tags), summary, windows)


def colocated_flags(features: DataFrame, kept: StoredTables, run_date: str, windows: DateWindows = SERVING) -> DataFrame:
    """J4 + J5 of a published day again, from tables that lie bucketed by user: no side is exchanged."""
    pairs = features.select(USER, ROUTE, F.lit(run_date).alias(ANCHOR), "dt")
    tagged = attach_user_tags(pairs, kept.tags.read(kept.tags_dt).drop("dt"))
    flagged = attach_history_flag(tagged, kept.history.summary([run_date], windows.history), windows)
    return flagged.select(USER, ROUTE, "dt", "is_student", "is_trader", "has_history_route")


def exclude_recent_buyers(df: DataFrame, buyers: DataFrame) -> DataFrame:
    """Drop every row of a (user, anchor) that paid in the recent window.

    Written as a left join plus null filter rather than an anti join: Catalyst
    would push an anti join below the aggregation onto raw log rows (a raw
    shuffle by user unless broadcast), while this stays on the user-partitioned
    pair rows.  AQE turns it into a broadcast join when the buyer set proves
    small at run time, and the pair rows never move either way."""
    marked = buyers.withColumn("_recent", F.lit(True))
    return df.join(marked, on=USER_KEYS, how="left").where(F.col("_recent").isNull()).drop("_recent")


def serving_log(tables: SourceTables, anchors: list[str], windows: DateWindows = SERVING) -> DataFrame:
    """U1 rows of every run date's search window (before the J3 exclusion)."""
    return anchored_search_log(tables, anchors, windows.searches)


def serving_features(tables: SourceTables, run_dates: list[str] | str,
                     windows: DateWindows = SERVING, kept: StoredTables = StoredTables()) -> DataFrame:
    """The feature partition of each run date (dt = run date - 1).

    Stores the cells of the search window (this starts a job); orders and tags
    are then cut to the users of the cells, unless they come from ``kept`` tables."""
    def group(anchors: list[str]) -> DataFrame:
        buyers = recent_buyers(tables, anchors, windows.recent_buyers)
        cells = stored(cell_aggregates(serving_log(tables, anchors, windows)), "cells")
        feats = assemble(tables, pairs_of(cells), anchors, windows, cells.select(USER).distinct(), buyers, kept)
        return feats.selectExpr(*feature_exprs(), f"{shift_sql(ANCHOR, windows.output_offset)} AS dt")

    return reduce(DataFrame.unionByName, [group(a) for a in windows.anchor_groups(run_dates)])
