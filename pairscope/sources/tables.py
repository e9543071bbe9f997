"""Access to the four source tables, scoped to a dt range.

Operators never read a table directly: they ask a ``SourceTables`` for the
rows of one date range, so each implementation can make that range reach the
scan (partition pruning on a dt-partitioned table, a pushed timestamp range on
the event fixture).

Returned shapes (see ``pairscope.schemas``):
  list_log / ota_log  username, dep_city, arr_city, pre_days, search_date, search_time, dt
  orders              username, dep_city, arr_city, create_time, pay_ok, dt
  user_tags           key, tag
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_LOG_COLS = ["username", "dep_city", "arr_city", "pre_days", "search_date", "search_time", "dt"]
_ORDER_COLS = ["username", "dep_city", "arr_city", "create_time", "pay_ok", "dt"]


class SourceTables:
    """Interface: date-scoped scans of the source tables.

    ``lo`` / ``hi`` are closed yyyyMMdd bounds; None leaves that side open
    (whole-table scans)."""

    spark: SparkSession

    def list_log(self, lo: str, hi: str) -> DataFrame:
        raise NotImplementedError

    def ota_log(self, lo: str, hi: str) -> DataFrame:
        raise NotImplementedError

    def orders(self, lo: str, hi: str) -> DataFrame:
        raise NotImplementedError

    def user_tags(self) -> DataFrame:
        raise NotImplementedError


@dataclass
class CatalogTables(SourceTables):
    """Tables partitioned by a string ``dt`` (catalog names or parquet paths).

    The dt predicate is on the partition column, so Spark prunes partitions
    (``PartitionFilters`` in the scan) and lists only the files it needs.
    """
    spark: SparkSession
    list_table: str
    ota_table: str
    order_table: str
    tag_table: str

    def _read(self, name: str) -> DataFrame:
        """Resolve each table once per instance (catalog lookup / file listing)."""
        cache = self.__dict__.setdefault("_relations", {})
        if name not in cache:
            cache[name] = self.spark.read.parquet(name) if "/" in name else self.spark.table(name)
        return cache[name]

    def _scan(self, name: str, lo: str | None, hi: str | None, cols: list[str]) -> DataFrame:
        df = self._read(name)
        if lo is not None:
            df = df.where(F.col("dt") >= F.lit(lo))
        if hi is not None:
            df = df.where(F.col("dt") <= F.lit(hi))
        return df.select(*cols)

    def list_log(self, lo: str | None, hi: str | None) -> DataFrame:
        return self._scan(self.list_table, lo, hi, _LOG_COLS)

    def ota_log(self, lo: str | None, hi: str | None) -> DataFrame:
        return self._scan(self.ota_table, lo, hi, _LOG_COLS)

    def orders(self, lo: str | None, hi: str | None) -> DataFrame:
        return self._scan(self.order_table, lo, hi, _ORDER_COLS)

    def user_tags(self) -> DataFrame:
        return self._read(self.tag_table).select("key", "tag")



@dataclass
class FrameTables(SourceTables):
    """Source tables held as DataFrames (hand-written rows, or frames built upstream)."""
    spark: SparkSession
    list_df: DataFrame
    ota_df: DataFrame
    order_df: DataFrame
    tag_df: DataFrame

    @staticmethod
    def _range(df: DataFrame, lo: str | None, hi: str | None) -> DataFrame:
        if lo is not None:
            df = df.where(F.col("dt") >= F.lit(lo))
        if hi is not None:
            df = df.where(F.col("dt") <= F.lit(hi))
        return df

    def list_log(self, lo: str | None, hi: str | None) -> DataFrame:
        return self._range(self.list_df, lo, hi).select(*_LOG_COLS)

    def ota_log(self, lo: str | None, hi: str | None) -> DataFrame:
        return self._range(self.ota_df, lo, hi).select(*_LOG_COLS)

    def orders(self, lo: str | None, hi: str | None) -> DataFrame:
        return self._range(self.order_df, lo, hi).select(*_ORDER_COLS)

    def user_tags(self) -> DataFrame:
        return self.tag_df.select("key", "tag")
