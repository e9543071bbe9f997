"""Exact deduplication by skew-safe combining.

Three stages, each a group-by that combines map-side and each keyed by the
full content besides its digest, so two texts with one digest never merge:

1. local: every task merges the copies it reads (the partial aggregate);
2. salted: the partial groups meet by (digest, salt, text), so the copies of a
   very frequent text spread over ``salts`` tasks;
3. global: one winner per salt is combined by (digest, text).

The winners are written without their texts.  Documents then find their winner
by digest, which stage 3 has proven to belong to a single text; digests that
several texts share (none, for SHA-256) are joined by content.  That join is
shuffled on both sides directly, so adaptive execution splits a hot digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                salts: int = 16, digest: str = "sha2({text}, 256)") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; a null text counts as empty.  Of equal
    texts the row with the largest id stays.  A null id is smaller than any
    other; a group with null ids only keeps one of its rows under a null
    ``keep_id``.  Rows that repeat an id and its text are counted in
    ``group_size`` and just one of them is kept.  Columns of ``docs`` besides
    the two named are ignored.  An empty table gives an empty result.
    """
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("digest", F.expr(digest.format(text="text"))))
    salted = (rows.groupBy("digest", F.expr(f"pmod(xxhash64(id), {salts})").alias("salt"), "text")
              .agg(F.max("id").alias("id"), F.count("*").alias("n")))
    texts = salted.groupBy("digest", "text").agg(F.max("id").alias("id"), F.sum("n").alias("n"))
    winners = materialise(
        texts.groupBy("digest").agg(F.count("*").alias("texts"), F.max("id").alias("keep_id"),
                                    F.sum("n").alias("group_size")), "exact-winners")

    # Copies of one row (same id, same text) are one entry with a count, so
    # that exactly one of them can be marked as kept.
    entries = rows.groupBy("digest", "id").agg(F.count("*").alias("copies"))
    found = entries.join(winners.where("texts = 1").drop("texts"), "digest")
    if winners.where("texts > 1").limit(1).count():
        shared = winners.where("texts > 1").select("digest")
        content = rows.join(shared, "digest", "left_semi")
        best = content.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        found = found.unionByName(
            content.groupBy("digest", "text", "id").agg(F.count("*").alias("copies"))
            .join(best, ["digest", "text"]).select(*found.columns))
    return (found.select("*", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    F.expr("copy = 1 and id <=> keep_id").alias("kept"),
                    F.col("digest").alias("text_sha256")))
