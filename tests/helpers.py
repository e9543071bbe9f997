"""Builders of hand-written source rows for the unit tests."""

from pairscope.schemas import ORDERS, SEARCH_LOG, USER_TAGS
from pairscope.sources.tables import FrameTables


def search(user, dep, arr, pre_days, day, time="10:00:00"):
    """A search row on day yyyyMMdd at time HH:mm:ss."""
    return (user, dep, arr, pre_days, f"{day[:4]}-{day[4:6]}-{day[6:]}", time, day)


def order(user, dep, arr, day, time="12:00:00", pay_ok=1):
    return (user, dep, arr, f"{day[:4]}-{day[4:6]}-{day[6:]} {time}", pay_ok, day)


def tables(spark, lists=(), otas=(), orders=(), tags=()):
    return FrameTables(spark,
                       spark.createDataFrame(list(lists), SEARCH_LOG),
                       spark.createDataFrame(list(otas), SEARCH_LOG),
                       spark.createDataFrame(list(orders), ORDERS),
                       spark.createDataFrame(list(tags), USER_TAGS))


def rows_by(df, *key):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


def sorted_rows(df):
    """All rows as tuples in a null-safe order (for order-insensitive equality)."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
