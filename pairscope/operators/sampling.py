"""Seeded, reproducible sampling and splitting of the training set.

Every random choice is a function of the row key, a purpose and a seed:
``h = md5(user | route | label_dt | purpose:seed)`` (hex).  The purpose keeps
draws independent of each other even where their seeds are equal: the rows a
sample drew are spread evenly over a later split.  Results do not depend on
partitioning, task retries or executor loss, unlike ``rand()``.

A sample of n rows is "h at or below the n-th smallest h", and that threshold
is found exactly by counting rows per hash prefix (at most 16^4 counts at a
time) and listing only the one prefix in which it lies.  The sample and its
complement are then two filters: nothing is sorted, ranked or joined.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_key

# Row key of a training row (unique: one row per user, route and label day).
KEY = ["username", "search_route", "label_dt"]
PREFIX = 4            # hex digits counted at a time: at most 65,536 counts
LISTED = 10_000       # rows of one prefix that are listed instead of counted again

# The reference's seeds for the positive sample, the negative
# sample, the train/test split and the holdout sample.
SEED_POS, SEED_NEG, SEED_SPLIT, SEED_HOLDOUT = 1, 43, 43, 90


def hash_col(purpose: str, seed: int, key: list[str] = KEY) -> Column:
    return hash_key(*key, seed=f"{purpose}:{seed}")


def nth_smallest(df: DataFrame, h: Column, n: int) -> str | None:
    """The ``n``-th smallest value of the hash ``h``; None if ``df`` has fewer rows, '' for n = 0."""
    if n <= 0:
        return ""
    rows, prefix, rank = df.select(h.alias("h")), "", n
    while True:
        inside = rows.where(F.col("h").startswith(prefix)) if prefix else rows
        counts = (inside.groupBy(F.substring("h", len(prefix) + 1, PREFIX).alias("p"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())
        for r in sorted(counts, key=lambda r: r.p):
            if rank <= r.n:
                break
            rank -= r.n
        else:
            return None
        prefix += r.p
        if len(prefix) == 32:                       # one hash value, repeated
            return prefix
        if r.n <= LISTED:
            return sorted(x.h for x in rows.where(F.col("h").startswith(prefix)).collect())[rank - 1]


def _cut(df: DataFrame, h: Column, n: int, what: str) -> str:
    cut = nth_smallest(df, h, n)
    if cut is None:
        raise ValueError(f"{what}: fewer than {n} rows to draw from")
    return cut


def sample_condition(df: DataFrame, n: int, seed_pos: int = SEED_POS, seed_neg: int = SEED_NEG,
                     label: str = "label", key: list[str] = KEY) -> Column:
    """Whether a row of ``df`` is drawn: n positives and n negatives, each seeded.

    ``df`` is read a few times (key and label only): pass a stored frame.
    A class with fewer than ``n`` rows is an error, as in the reference."""
    drawn = F.lit(False)
    for value, purpose, seed in ((1, "sample-pos", seed_pos), (0, "sample-neg", seed_neg)):
        h, of_class = hash_col(purpose, seed, key), F.col(label) == value
        drawn = drawn | (of_class & (h <= _cut(df.where(of_class), h, n, f"label {value}")))
    return F.coalesce(drawn, F.lit(False))


def balanced_sample(df: DataFrame, n: int, seed_pos: int = SEED_POS, seed_neg: int = SEED_NEG,
                    label: str = "label", key: list[str] = KEY) -> DataFrame:
    """M1 + F7 + U2: n positives and n negatives."""
    return df.where(sample_condition(df, n, seed_pos, seed_neg, label, key))


def holdout_complement(df: DataFrame, drawn: Column) -> DataFrame:
    """The rows that ``drawn`` (see ``sample_condition``) leaves out: the evaluation set."""
    return df.where(~drawn)


def balanced_slices(df: DataFrame, size: int, pred_size: int, seed: int = 0,
                    label: str = "label", key: list[str] = KEY) -> DataFrame:
    """M2: per class, ranks 1..size -> 'train', size+1..size+pred_size -> 'predict'.

    One seed for both classes (the reference shuffles once, then slices); a
    class may be too small for its slices, which are then short."""
    h, end = hash_col("slices", seed, key), "g"       # 'g' lies above every hex digit
    name = F.lit(None).cast("string")
    for value in (1, 0):
        of_class = F.col(label) == value
        first, last = (nth_smallest(df.where(of_class), h, n) for n in (size, size + pred_size))
        name = (F.when(of_class & (h <= (end if first is None else first)), F.lit("train"))
                .when(of_class & (h <= (end if last is None else last)), F.lit("predict")).otherwise(name))
    return df.withColumn("slice", name).where("slice IS NOT NULL")


def hash_sample(df: DataFrame, n: int, seed: int = SEED_HOLDOUT, key: list[str] = KEY) -> DataFrame:
    """M3: n rows, seeded (the reference samples 100,000 holdout rows); fewer than n are an error."""
    h = hash_col("holdout", seed, key)
    return df.where(h <= _cut(df, h, n, "holdout sample"))


def train_test_split(df: DataFrame, test_size: float, seed: int = SEED_SPLIT,
                     key: list[str] = KEY) -> DataFrame:
    """M4: ``split`` = 'test' for exactly ceil(test_size * rows) rows, else 'train'."""
    h, rows = hash_col("split", seed, key), df.count()
    n_train = rows - math.ceil(test_size * rows)
    return df.withColumn("split", F.when(h <= nth_smallest(df, h, n_train), F.lit("train")).otherwise(F.lit("test")))
