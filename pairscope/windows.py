"""Date windows of the daily serving run and of the training label day.

All dates are ``yyyyMMdd`` strings at the table edge (partition values compare
lexicographically = chronologically).  Windows are closed ``[lo, hi]``
offsets in days *before* an anchor date: the run date R for serving, the
label date L for training.

Fixed values (they must equal the reference's for the same results):
  serving:  searches R-2 .. R-1, recent buyers R-2 .. R-1,
            order history R-731 <= dt < R-2 (closed: R-731 .. R-3),
            output partition dt = R-1
  training: searches L-2 .. L-1, recent buyers L-2 .. L-1, label orders L,
            order history L-732 .. L-1
  label-day orders per (user, route) are kept while count < 20
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FMT = "%Y%m%d"
SPARK_DATE_FMT = "yyyyMMdd"

MAX_ORDERS_PER_ROUTE = 20  # HAVING count(1) < 20


def parse(d: str | _dt.date) -> _dt.date:
    if isinstance(d, _dt.date):
        return d
    d = d.replace("-", "")
    return _dt.datetime.strptime(d, DATE_FMT).date()


def fmt(d: _dt.date) -> str:
    return d.strftime(DATE_FMT)


def shift(d: str | _dt.date, days: int) -> str:
    """``shift('20240130', -2) == '20240128'`` (the $QDATE(n) macro)."""
    return fmt(parse(d) + _dt.timedelta(days=days))


def date_range(first: str, last: str) -> list[str]:
    """Closed list of yyyyMMdd dates from ``first`` to ``last``."""
    a, b = parse(first), parse(last)
    return [fmt(a + _dt.timedelta(days=i)) for i in range((b - a).days + 1)]


def shift_sql(dt: str, days: int) -> str:
    """SQL form of ``shift`` on a yyyyMMdd string column ``dt``."""
    return f"date_format(date_add(to_date(`{dt}`, '{SPARK_DATE_FMT}'), {days}), '{SPARK_DATE_FMT}')"


def shift_col(dt: Column | str, days: int | Column) -> Column:
    """Column form of ``shift`` on a yyyyMMdd string column."""
    c = F.col(dt) if isinstance(dt, str) else dt
    return F.date_format(F.date_add(F.to_date(c, SPARK_DATE_FMT), days), SPARK_DATE_FMT)


@dataclass(frozen=True)
class Offsets:
    """Closed window ``[anchor - back, anchor - near]`` in days."""
    back: int
    near: int

    def bounds(self, anchor: str) -> tuple[str, str]:
        return shift(anchor, -self.back), shift(anchor, -self.near)

    def span(self, anchors: list[str]) -> tuple[str, str]:
        """Smallest closed range covering the windows of all anchors."""
        return shift(min(anchors), -self.back), shift(max(anchors), -self.near)


@dataclass(frozen=True)
class DateWindows:
    searches: Offsets
    recent_buyers: Offsets
    history: Offsets
    output_offset: int | None  # serving: partition dt = anchor + offset

    def check_anchors(self, anchors: list[str] | str) -> list[str]:
        """Distinct anchors in order."""
        anchors = sorted({fmt(parse(a)) for a in ([anchors] if isinstance(anchors, str) else anchors)})
        if not anchors:
            raise ValueError("at least one anchor date is required")
        return anchors

    def anchor_groups(self, anchors: list[str] | str) -> list[list[str]]:
        """The anchors in groups that each lie within one history window.

        One pass over the order history serves all anchors of a group (see
        ``history_summary``); a backfill of many years takes one pass per group."""
        width, groups = self.history.back - self.history.near, []
        for a in self.check_anchors(anchors):
            if not groups or (parse(a) - parse(groups[-1][0])).days > width:
                groups.append([])
            groups[-1].append(a)
        return groups


SERVING = DateWindows(searches=Offsets(2, 1), recent_buyers=Offsets(2, 1),
                      history=Offsets(731, 3), output_offset=-1)
TRAINING = DateWindows(searches=Offsets(2, 1), recent_buyers=Offsets(2, 1),
                       history=Offsets(732, 1), output_offset=None)


def window_bounds(anchor: Column, windows: DateWindows) -> dict[str, Column]:
    """Bounds of every window as yyyyMMdd columns, for a column of anchors."""
    out = {
        "search_lo": shift_col(anchor, -windows.searches.back),
        "search_hi": shift_col(anchor, -windows.searches.near),
        "recent_lo": shift_col(anchor, -windows.recent_buyers.back),
        "recent_hi": shift_col(anchor, -windows.recent_buyers.near),
        "history_lo": shift_col(anchor, -windows.history.back),
        "history_hi": shift_col(anchor, -windows.history.near),
    }
    if windows.output_offset is not None:
        out["output_dt"] = shift_col(anchor, windows.output_offset)
    return {k: v.alias(k) for k, v in out.items()}
