"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# User names that count as missing, besides SQL NULL.
JUNK_USER_NAMES = ("", "NULL", "null")

# The tags that become flags, and the search-log sources.
TAG_TRADER = "is_trader"
TAG_STUDENT = "is_student"
PROCESS_LIST = "list"
PROCESS_OTA = "ota"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_user_sql(name: str) -> str:
    """``x is not null and x not in ('', 'NULL', 'null')`` on column ``name``."""
    junk = ", ".join(f"'{v}'" for v in JUNK_USER_NAMES)
    return f"`{name}` IS NOT NULL AND `{name}` NOT IN ({junk})"


def valid_user(name: str) -> Column:
    return F.expr(valid_user_sql(name))


def route_sql(dep: str = "dep_city", arr: str = "arr_city") -> str:
    """``concat(dep, '-', arr)``; null when either city is null."""
    return f"concat(`{dep}`, '-', `{arr}`)"


def hash_key(*cols: Column | str, seed: int | str = 0) -> Column:
    """Deterministic md5 hex of the key columns and a seed.

    Nulls are rendered as an empty marker so that a null route still hashes;
    the separator keeps ('ab','c') apart from ('a','bc').
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("\\N")) for c in cols]
    parts.append(F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts))
