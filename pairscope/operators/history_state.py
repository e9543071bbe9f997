"""The order history as daily state: which days each (user, route) was bought, as bits.

A row holds 64 days of one (user, route): bit b of ``bits`` is day b of the
64-day block that starts on ``dt``.  The table is partitioned by block, so one
day's orders change one partition, days that leave the window are masked out,
and blocks that leave it are dropped without reading them.  It is bucketed by
user, so the flags meet the pairs without an exchange.  A run thus reads one
day of orders and the bits, never two years of orders.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from ..sources.partitioned import PartitionedTable
from ..sources.tables import SourceTables
from ..windows import Offsets, date_range, parse, shift
from .logs import USER, paid_orders

BLOCK = 64
EPOCH = _dt.date(1970, 1, 1)
SCHEMA = T.StructType([T.StructField(USER, T.StringType()), T.StructField("order_route", T.StringType()),
                       T.StructField("bits", T.LongType()), T.StructField("dt", T.StringType())])
#: Day number of the block's first day.
START = "unix_date(to_date(dt, 'yyyyMMdd'))"


def day_number(day: str) -> int:
    return (parse(day) - EPOCH).days


def block_of(day: str) -> str:
    """First day of the block that a day lies in."""
    return shift(day, -(day_number(day) % BLOCK))


def _from(k: str) -> str:
    """Bits of the days from number ``k`` of the block on (SQL text; k may lie outside the block)."""
    return f"(CASE WHEN {k} >= {BLOCK} THEN 0L ELSE shiftleft(-1L, greatest(cast({k} AS INT), 0)) END)"


def _highest(bits: str) -> str:
    """Number of the highest set bit; null for none."""
    return f"(CASE WHEN {bits} <> 0 THEN length(bin({bits})) - 1 END)"


def _lowest(bits: str) -> str:
    return f"(CASE WHEN {bits} <> 0 THEN instr(reverse(bin({bits})), '1') - 1 END)"


class HistoryState:
    def __init__(self, spark: SparkSession, name: str, buckets: int = 64):
        self.table = PartitionedTable(spark, name, SCHEMA, "orc", buckets, [USER])

    def create(self) -> HistoryState:
        self.table.create()
        return self

    def _bits(self, orders: DataFrame) -> DataFrame:
        """(user, route, bits, dt) of paid orders; a day that is no date counts nowhere, nor does a null route."""
        day = "unix_date(cast(try_to_timestamp(dt, 'yyyyMMdd') AS DATE))"
        return (orders.where("order_route IS NOT NULL").selectExpr(USER, "order_route", f"{day} AS day").where("day IS NOT NULL")
                .selectExpr(USER, "order_route", f"shiftleft(1L, cast(pmod(day, {BLOCK}) AS INT)) AS bits",
                            f"date_format(date_from_unix_date(cast(day - pmod(day, {BLOCK}) AS INT)), 'yyyyMMdd') AS dt")
                .groupBy(USER, "order_route", "dt").agg(F.bit_or("bits").alias("bits")))

    def load(self, tables: SourceTables, first: str, last: str) -> HistoryState:
        """Fill the state from the orders of a range of days, in one pass; blocks that it touches are replaced."""
        self.table.overwrite_partitions(self._bits(paid_orders(tables, first, last)))
        return self

    def advance(self, tables: SourceTables, day: str) -> HistoryState:
        """Take over the orders of one day: reads that day and its block, and replaces the block.

        The day's bits are replaced too, so repeating a day, or running it again
        on corrected orders, is safe.
        """
        block = block_of(day)
        bit = 1 << (day_number(day) - day_number(block))
        others = ~bit if bit < 1 << 63 else (1 << 63) - 1
        old = self.table.read(block).drop("dt").withColumn("bits", F.expr(f"bits & {others}L")).where("bits <> 0")
        new = self._bits(paid_orders(tables, day, day)).drop("dt")
        merged = old.unionByName(new).groupBy(USER, "order_route").agg(F.bit_or("bits").alias("bits"))
        # The block is read and replaced: it is written beside the table first.
        self.table.overwrite_partition(stored(merged, "history-block"), block)
        return self

    def expire(self, before: str) -> HistoryState:
        """Drop the blocks that end before a day (metadata and files, nothing is read)."""
        blocks = [r.partition.split("=")[1] for r in self.table.spark.sql(f"SHOW PARTITIONS {self.table.name}").collect()]
        for block in blocks:
            if shift(block, BLOCK - 1) < before:
                self.table.drop_partition(block)
        return self

    def _days(self, lo: str, hi: str) -> DataFrame:
        """Rows of the blocks that meet [lo, hi] (pruned at the scan), their bits cut to it."""
        blocks = sorted({block_of(d) for d in (*date_range(lo, hi)[::BLOCK], hi)})
        rows = self.table.read().where(F.col("dt").isin(blocks)).withColumn("start", F.expr(START))
        window = f"bits & {_from(f'({day_number(lo)} - start)')} & ~{_from(f'({day_number(hi)} + 1 - start)')}"
        return rows.withColumn("bits", F.expr(window)).where("bits <> 0")

    def routes(self, lo: str, hi: str) -> DataFrame:
        """Distinct (user, route) bought in [lo, hi]."""
        return self._days(lo, hi).select(USER, "order_route").distinct()

    def summary(self, anchors: list[str], window: Offsets) -> DataFrame:
        """What ``logs.history_summary`` gives for all users, from the bits."""
        lo, hi = window.span(anchors)
        if (parse(max(anchors)) - parse(min(anchors))).days > window.back - window.near:
            raise ValueError("anchors must lie within one history window (see DateWindows.anchor_groups)")
        after = _from(f"({day_number(shift(min(anchors), -window.near))} + 1 - start)")
        days = self._days(lo, hi).withColumns({"early": F.expr(f"bits & ~{after}"), "late": F.expr(f"bits & {after}")})
        number = "cast(date_format(date_from_unix_date(cast({} AS INT)), 'yyyyMMdd') AS INT)"
        return (days.groupBy(USER, "order_route")
                .agg(F.expr(f"max(start + {_highest('early')}) AS early"), F.expr(f"min(start + {_lowest('late')}) AS late"))
                .selectExpr(USER, "order_route", f"{number.format('early')} AS last_on_or_before_pivot",
                            f"{number.format('late')} AS first_after_pivot"))

