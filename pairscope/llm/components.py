"""Connected components of a distributed set of links.

Links are first contracted inside each partition.  If few enough are left
(their number is checked) one task contracts these; else alternating large-star
and small-star rounds run until every node points at the smallest node of its
component.  Each round is group-by-minimum (combined map-side) and a join on
the node, and ends in a table in the shared folder; nothing but one flag per
round reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, remove_table

LINKS = "a long, b long"
#: Contracted links (16 bytes each) that one task finishes.
ONE_TASK = 1 << 20


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of arrays, contracted: every node but the smallest of its component, with that smallest."""
    nodes, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = codes[: len(a)], codes[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(before, root):
            break
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def contract(batches: Iterator[pd.DataFrame], most: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """Spanning forest of the links of a partition, in bounded memory: a full buffer is contracted and passed on."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size > most:
            all_ = pd.concat(held)
            a, b = forest(all_["a"].to_numpy(), all_["b"].to_numpy())
            held, size = [pd.DataFrame({"a": a, "b": b})], len(a)
            if size > most // 2:
                yield held.pop()
                size = 0
    if size:
        all_ = pd.concat(held)
        a, b = forest(all_["a"].to_numpy(), all_["b"].to_numpy())
        yield pd.DataFrame({"a": a, "b": b})


def _to_minimum(links: DataFrame, node: str, other: str) -> DataFrame:
    """``links`` with ``m``, the smallest of a node and its neighbours."""
    smallest = links.groupBy(F.col(node).alias("n")).agg(F.min(other).alias("m"))
    return links.join(smallest, F.col(node) == F.col("n")).withColumn("m", F.least("m", node)).drop("n")


def components(links: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """``links`` (a long, b long) to (node, root): each node of a link that is not the smallest
    of its component, with that smallest node.  Repeated links, loops and either direction are
    fine; links with a null end are ignored; no links give an empty result.
    """
    links = links.where("a <> b").select("a", "b").mapInPandas(contract, LINKS)
    current = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                          .distinct(), "links")
    if current.count() <= one_task:
        done = materialise(current.repartition(1).mapInPandas(contract, LINKS), "links")
        remove_table(current)
        return done.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        tangled = (current.select(F.col("a").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root"))
                   .unionAll(current.select("b", F.lit(0), F.lit(1)))
                   .groupBy("n").agg(F.sum("child").alias("c"), F.max("root").alias("r"))
                   .where("c > 1 or (c = 1 and r = 1)").limit(1).count())
        if not tangled:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = current.unionAll(current.select("b", "a"))
        large = _to_minimum(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _to_minimum(large, "a", "b")
        nxt = (small.select("a", F.col("m").alias("b")).unionAll(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
               .where("a <> b").distinct())
        nxt = materialise(nxt, "links")
        remove_table(current)
        current = nxt
