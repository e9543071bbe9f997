"""The four source tables derived from the ``events`` table of the test data.

The test data has no search logs, orders or tags; they are derived from
``events`` by the fixed rules below (the same rules are repeated in the
DuckDB oracles).  With ``k = int(props.k)``:

  list log     event_type = 'view'
  ota log      event_type = 'click'
  orders       event_type = 'purchase'; pay_ok = 0 when event_id % 10 = 0 else 1
  user tags    event_type = 'signup'; tag = 'is_student' when k % 40 = 0,
               'is_trader' when k % 40 = 1, else 'other'
  username     by user_id % 50: 0 -> '', 1 -> 'NULL', 2 -> 'null', 3 -> NULL,
               else 'u' || user_id
  dep_city     'D' || (k % 4)
  arr_city     'A' || (k div 25), NULL when k >= 96
  pre_days     floor(value)
  dt           date_format(ts, 'yyyyMMdd') (UTC)

``dt`` is derived, so a dt range cannot prune files by itself; every scan
therefore also carries the equivalent ``ts`` range, which Parquet can use
(row-group statistics) together with the pushed ``event_type`` equality.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..windows import parse, shift
from .tables import SourceTables

# Fixed values of the mapping (see module docstring).
LIST_EVENT = "view"
OTA_EVENT = "click"
ORDER_EVENT = "purchase"
TAG_EVENT = "signup"
JUNK_BY_MOD = {0: "", 1: "NULL", 2: "null"}
NULL_USER_MOD = 3
USER_MOD = 50
UNPAID_EVERY = 10
TAG_MOD = 40
ARR_NULL_FROM_K = 96


_K = "CAST(get_json_object(props, '$.k') AS INT)"
_USERNAME = ("CASE user_id % {m} WHEN {n} THEN CAST(NULL AS STRING) "
             + " ".join(f"WHEN {mod} THEN '{name}'" for mod, name in JUNK_BY_MOD.items())
             + " ELSE concat('u', CAST(user_id AS STRING)) END").format(m=USER_MOD, n=NULL_USER_MOD)
_DEP = f"concat('D', CAST({_K} % 4 AS STRING))"
_ARR = (f"CASE WHEN {_K} >= {ARR_NULL_FROM_K} THEN CAST(NULL AS STRING) "
        f"ELSE concat('A', CAST({_K} DIV 25 AS STRING)) END")
_DT = "date_format(ts, 'yyyyMMdd')"


@dataclass
class EventTables(SourceTables):
    spark: SparkSession
    sf_dir: str

    @cached_property
    def _relation(self) -> DataFrame:
        """The events relation, resolved once (file listing and schema) per instance."""
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet")

    @cached_property
    def days(self) -> tuple[str, str]:
        """First and last day (yyyyMMdd) of the events."""
        r = self._relation.selectExpr("date_format(min(ts), 'yyyyMMdd') AS lo",
                                      "date_format(max(ts), 'yyyyMMdd') AS hi").first()
        return r.lo, r.hi

    def _events(self, event_type: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
        """Rows of one event type with dt in [lo, hi] (None: open bound)."""
        cond = [f"event_type = '{event_type}'"]
        if lo is not None:
            cond.append(f"ts >= TIMESTAMP_NTZ '{parse(lo).isoformat()} 00:00:00'")
        if hi is not None:
            cond.append(f"ts < TIMESTAMP_NTZ '{parse(shift(hi, 1)).isoformat()} 00:00:00'")
        return self._relation.where(" AND ".join(cond))

    def _log(self, event_type: str, lo: str, hi: str) -> DataFrame:
        return self._events(event_type, lo, hi).selectExpr(
            f"{_USERNAME} AS username",
            f"{_DEP} AS dep_city",
            f"{_ARR} AS arr_city",
            "CAST(floor(value) AS INT) AS pre_days",
            "date_format(ts, 'yyyy-MM-dd') AS search_date",
            "date_format(ts, 'HH:mm:ss') AS search_time",
            f"{_DT} AS dt",
        )

    def list_log(self, lo: str, hi: str) -> DataFrame:
        return self._log(LIST_EVENT, lo, hi)

    def ota_log(self, lo: str, hi: str) -> DataFrame:
        return self._log(OTA_EVENT, lo, hi)

    def orders(self, lo: str, hi: str) -> DataFrame:
        return self._events(ORDER_EVENT, lo, hi).selectExpr(
            f"{_USERNAME} AS username",
            f"{_DEP} AS dep_city",
            f"{_ARR} AS arr_city",
            "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS create_time",
            f"CASE WHEN event_id % {UNPAID_EVERY} = 0 THEN 0 ELSE 1 END AS pay_ok",
            f"{_DT} AS dt",
        )

    def user_tags(self) -> DataFrame:
        return self._events(TAG_EVENT).selectExpr(
            f"{_USERNAME} AS key",
            f"CASE {_K} % {TAG_MOD} WHEN 0 THEN 'is_student' WHEN 1 THEN 'is_trader' ELSE 'other' END AS tag",
        )
