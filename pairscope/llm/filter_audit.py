"""Filter interaction audit: what five filters remove in each of their 120 orders.

A document's mask says which filters it fails.  Orders are ranked
lexicographically (Lehmer rank), so all orders with one prefix are an interval
of ranks, and the step that removes a document with a given mask covers a few
such intervals.  Per part of the corpus only the counts of the 32 masks are
needed: they are added at the ends of each mask's intervals, a prefix sum over
the 120 ranks gives every order's totals, and these are emitted.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

FILTERS = "ABCDE"
STEPS = len(FILTERS)
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]     # by Lehmer rank
MASKS = 1 << STEPS
# Thresholds of the filters (fixed values).
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
SYMBOLS = b"#$%&*|"
UPPER = bytes(range(65, 91))
#: Bytes that continue a UTF-8 character.
CONTINUATION = bytes(range(0x80, 0xC0))
#: What is counted per mask, and what an order's step reports of it.
COUNTS = ("documents", "good", "toxic")
STATES = ("kept", "removed", "redundant", "unique")


def lehmer_rank(prefix: tuple[int, ...]) -> int:
    """Rank of the first order that starts with ``prefix`` (filter numbers)."""
    rank = 0
    for i, f in enumerate(prefix):
        smaller = f - sum(g < f for g in prefix[:i])
        rank += smaller * math.factorial(STEPS - 1 - i)
    return rank


def differences() -> np.ndarray:
    """D[mask, state, step, rank]: what one document of a mask adds at the ends of its intervals of ranks.

    A prefix of s filters covers (5 - s)! ranks in a row.  With the last of them
    as the step's filter, a document is removed there if it fails that filter
    and none before, redundant if it fails it and one before, and kept after it
    if it fails none of the prefix.
    """
    out = np.zeros((MASKS, len(STATES), STEPS, len(ORDERS) + 1), np.int64)
    for step in range(STEPS):
        for prefix in itertools.permutations(range(STEPS), step + 1):
            lo = lehmer_rank(prefix)
            hi = lo + math.factorial(STEPS - 1 - step)
            before = sum(1 << f for f in prefix[:-1])
            own = 1 << prefix[-1]
            for mask in range(MASKS):
                earlier, fails = bool(mask & before), bool(mask & own)
                for state, holds in enumerate((not earlier and not fails, fails and not earlier, fails and earlier, mask == own)):
                    if holds:
                        out[mask, state, step, lo] += 1
                        out[mask, state, step, hi] -= 1
    return out


def totals(counts: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Columns of one part's 600 rows, by rank and step, from ``counts`` (3 x 32 masks)."""
    sums = np.tensordot(counts, ends, axes=(1, 0))[..., :-1].cumsum(axis=-1)     # count x state x step x rank
    kept, removed, redundant, unique = (sums[0, s].T for s in range(len(STATES)))
    letters = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])  # rank x step
    shapley = np.bincount(letters.ravel(), removed.ravel(), STEPS).astype(np.int64) if removed.sum() < 1 << 53 else \
        np.array([removed[letters == f].sum() for f in range(STEPS)])
    return {"kept": kept, "removed": removed, "redundant": redundant, "unique_fails": unique,
            "good_lost": sums[1, 1].T, "toxic_lost": sums[2, 1].T, "shapley": shapley[letters]}


def text_mask(raw: bytes) -> int:
    """Bits of the filters A to D that a text's UTF-8 bytes fail."""
    words = raw.split()
    upper = len(raw) - len(raw.translate(None, UPPER))
    points = len(raw.translate(None, CONTINUATION))
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
            | (100 * upper > MAX_UPPER_PERCENT * points) << 2
            | (len(raw) != len(raw.translate(None, SYMBOLS))) << 3)


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask) of every row.

    Filter E needs the smallest id of equal texts: texts meet by SHA-256 as
    partial minima, never whole, and rows find that minimum by digest.  The
    minima are stored first, so that the join shuffles both sides right below
    it and adaptive execution can split a hot text.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))

    @F.pandas_udf("int")
    def failed(texts: pd.Series) -> pd.Series:
        return pd.Series([text_mask(t) for t in texts], dtype="int32")

    rows = rows.select("id", "part", F.unhex(F.sha2("raw", 256)).alias("digest"), failed("raw").alias("own"))
    first = materialise(rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
                        .select(F.col("digest").alias("shared"), "least"), "first-ids")
    return (rows.join(first, F.expr("digest = shared"), "left")
            .select("id", "part", F.expr(f"own + if(coalesce(id > least, false), {1 << FILTERS.index('E')}, 0)").alias("mask")))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
          good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """Per part, filter order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A null text is empty, a null part the empty string.  A row without an id is
    identical to no smaller one, has no label, and is no smaller one itself; rows
    that repeat an id and a text are all counted and not copies of each other.
    A document with several label rows is good or toxic if one of them says so.
    Every part of ``docs`` gives 600 rows, zeros included; an empty table gives
    none.  Other columns are ignored.
    """
    marks = materialise(labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("of"))
                        .agg(F.max((F.col(good_col) == 1).cast("int")).alias("good"),
                             F.max((F.col(toxic_col) == 1).cast("int")).alias("toxic")), "marks")
    counted = (masks(docs, id_col, text_col, part_col).join(marks, F.expr("id = of"), "left").groupBy("part", "mask")
               .agg(F.count("*").alias("documents"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                    F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))
    # At most 32 rows a part, whatever its size.
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("masks"))
    ends = differences()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, held in zip(batch["part"], batch["masks"]):
                counts = np.zeros((len(COUNTS), MASKS), np.int64)
                for m in held:
                    counts[:, m["mask"]] = [m[c] for c in COUNTS]
                found = totals(counts, ends)
                yield pd.DataFrame({"part": part, "filter_order": np.repeat(ORDERS, STEPS),
                                    "step": np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS)),
                                    **{c: found[c].ravel() for c in names}})

    return parts.mapInPandas(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names))
