"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are short, documents long, so the sketch is one-sided.  Items are put
into classes of similar size (number of distinct five-word shingles); within a
class an item's signature holds the k smallest hashes of its shingles (a
bottom-k MinHash).  k is the number for the largest item of the class, with
which no document can hold a share ``threshold`` of the item's shingles and
none of the signature: floor((1 - threshold) * n) + 1.  A document that meets a
signature, and has shingles enough for that class, is a candidate, and its
shared shingles are then counted exactly, by text.

Executors get two Bloom filters of bounded size (signatures, all item
shingles) and pass on only the shingles of a candidate that the items may have;
the exact joins run on those.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import fresh, materialise, small_batches

WORDS = re.compile(r"\w+")
BITS_PER_SHINGLE = 2048
CODES_KEPT = 1 << 17       # words whose code a task remembers


class Codes(dict):
    """64-bit code of each word, remembered."""

    def __missing__(self, word: str) -> int:
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores: punctuation and spacing do not count."""
    return WORDS.findall((text or "").lower())


def shingle_hashes(words: list[str], codes: Codes, width: int) -> np.ndarray:
    """Hash of the shingle at each position; fewer words than ``width`` make one shingle, no words none."""
    if not words:
        return np.empty(0, np.uint64)
    if len(codes) > CODES_KEPT:
        codes.clear()
    code = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - width + 1, 1)
    h = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for i in range(min(width, len(words))):
        h = (h ^ code[i: i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def shingle_text(words: list[str], at: int, width: int) -> str:
    return " ".join(words[at: at + width])


def item_shingles(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(item_key, shingle, hash, width) of the distinct shingles; equal word sequences are one item_key.

    An item of fewer words than ``width`` is one shingle, as wide as the item.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Codes()
        for batch in batches:
            for text in batch["text"]:
                words = words_of(text)
                h = shingle_hashes(words, codes, width)
                _, first = np.unique(h, return_index=True)
                if len(first):
                    yield pd.DataFrame({"item_key": xxhash.xxh128_hexdigest(" ".join(words)),
                                        "shingle": [shingle_text(words, int(i), width) for i in first],
                                        "hash": h[first].view(np.int64), "width": min(width, len(words))})
    return (items.select(F.col(text_col).alias("text")).mapInPandas(run, "item_key string, shingle string, hash long, width int")
            .distinct())


def signatures(shingles: DataFrame, threshold: float) -> DataFrame:
    """``shingles`` with n (the item's size) and signed (in the item's signature)."""
    sizes = shingles.groupBy("item_key").agg(F.count("*").alias("n"))
    classes = sizes.withColumn("size_class", F.floor(F.log2("n")))
    largest = classes.groupBy("size_class").agg(F.max("n").alias("n_hi"))  # one row per power of two
    k = classes.join(F.broadcast(largest), "size_class").select(
        "item_key", "n", F.expr(f"cast(floor((1 - {threshold}D) * n_hi + 1e-9) as int) + 1").alias("k"))
    rank = F.expr("row_number() over (partition by item_key order by hash, shingle)")
    return (shingles.withColumn("rank", rank).join(k, "item_key")
            .withColumn("signed", F.expr("rank <= k")).drop("rank", "k"))


def containment(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                item_id: str = "item_id", item_text: str = "text", width: int = 5,
                threshold: float = 0.8) -> DataFrame:
    """(doc_id, digest, item_id, n_shared, n_item, containment): the documents that hold an item.

    A document holds an item if it has at least ``threshold`` of the item's
    distinct word shingles.  Words are lower-case runs of letters, digits and
    underscores; an item of fewer than ``width`` words is one shingle as wide
    as it, and documents are searched for shingles of each such width too;
    items and documents without words (null or empty) match nothing.  ``digest`` is the MD5 of the document's
    text.  Rows that repeat an id and text give one row; ids may be null.
    Other columns are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pieces = materialise(signatures(item_shingles(items, item_id, item_text, width), threshold), "item-shingles")
    stats = pieces.agg(F.count("*").alias("n"), F.min("n").alias("least"), F.collect_set("width").alias("widths")).first()
    short = sorted(w for w in stats.widths if w < width)        # widths of items below the width, each searched on its own
    signed = spark.sparkContext.broadcast(bloom.build(pieces.where("signed"), "hash", stats.n, BITS_PER_SHINGLE))
    every = spark.sparkContext.broadcast(bloom.build(pieces, "hash", stats.n, BITS_PER_SHINGLE))
    need = math.ceil(threshold * (stats.least or 1) - 1e-9)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Codes()
        for batch in batches:
            rows: list[tuple] = []
            for key, digest, text in zip(batch["id"], batch["digest"], batch["text"]):
                words = words_of(text)
                searched = [(width, shingle_hashes(words, codes, width))]
                searched += [(w, shingle_hashes(words, codes, w)) for w in short if len(words) >= w]
                if not any(signed.value.holds(h).any() for _, h in searched):
                    continue
                size = len(np.unique(searched[0][1]))
                if size < need:
                    continue
                rows += [(key, digest, size, t) for t in {shingle_text(words, int(i), w) for w, h in searched
                                                          for i in np.flatnonzero(every.value.holds(h))}]
            yield pd.DataFrame(rows, columns=["id", "digest", "size", "shingle"])

    source = docs.select(F.col(doc_id).alias("id"), F.md5(F.coalesce(F.col(doc_text), F.lit(""))).alias("digest"),
                         F.col(doc_text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    hits = materialise(source.withColumn("id", F.col("id").cast("string"))
                       .mapInPandas(run, "id string, digest string, size long, shingle string")
                       .withColumn("id", F.col("id").cast(kind)), "shingle-hits")
    # Copies of a text are searched once and expanded at the end.
    texts = materialise(hits.select("digest", "size", "shingle").distinct(), "texts")
    candidates = (texts.join(pieces.where("signed"), "shingle")
                  .where(f"size >= ceil({threshold}D * n - 1e-9)").select("digest", "item_key").distinct())
    # Shingles meet the items of candidate pairs only: one that very many items and documents share does not multiply out.
    found = (candidates.join(texts.select("digest", "shingle"), "digest")
             .join(pieces.select("item_key", "shingle", "n"), ["item_key", "shingle"])
             .groupBy("digest", "item_key", "n").agg(F.count("*").alias("n_shared"))
             .where(f"n_shared >= ceil({threshold}D * n - 1e-9)"))
    keyed = materialise(_item_keys(items, item_id, item_text), "item-keys")
    return (hits.select("id", "digest").distinct().join(found, "digest").join(keyed, "item_key")
            .select(F.col("id").alias(doc_id), "digest", item_id, "n_shared", F.col("n").alias("n_item"),
                    F.expr("n_shared / n").alias("containment")))


def _item_keys(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [xxhash.xxh128_hexdigest(" ".join(words_of(t))) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "item_key": keys})
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.withColumn("id", F.col("id").cast("string")).mapInPandas(run, "id string, item_key string")
            .select(F.col("id").cast(kind).alias(id_col), "item_key").distinct())


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold an item (see ``containment``); clean rows stay as they are, repeats too."""
    digest = fresh(docs.columns, "digest")
    dirty = materialise(containment(docs, items, doc_id, doc_text, **options)
                        .select(F.col("digest").alias(digest)).distinct(), "contaminated")
    return (docs.withColumn(digest, F.md5(F.coalesce(F.col(doc_text), F.lit(""))))
            .join(dirty, digest, "left_anti").select(*docs.columns))
