"""Corpus pipeline: five stages from raw documents to shards.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.  Between stages the
rows are written as Parquet to the shared folder and read again, so a lost
executor repeats work of the current stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairscope.llm.common import materialise, read_table
from pairscope.llm.decontaminate import decontaminate
from pairscope.llm.langid import keep_identified
from pairscope.llm.mixing import mix_sources, shuffled
from pairscope.llm.sharding import shard_rows
from pairscope.llm.simhash import drop_near_duplicates

MIN_LANGUAGE_LIFT = 1 / 15    # of the way from an even guess to certainty, however many languages are known
MIN_KNOWN_GRAMS = 0.5         # share of a text's character n-grams that the training documents have
SIMHASH_WIDTH, SIMHASH_BITS = 3, 3
BENCHMARK_WIDTH, BENCHMARK_CONTAINMENT = 5, 0.8
MIX_SEED, SHARD_SEED, N_SHARDS = 11, 7, 16


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language."""
    return keep_identified(docs, MIN_LANGUAGE_LIFT, MIN_KNOWN_GRAMS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return drop_near_duplicates(docs, width=SIMHASH_WIDTH, max_bits=SIMHASH_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"), width=BENCHMARK_WIDTH, threshold=BENCHMARK_CONTAINMENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources weigh the same, in a random order."""
    return shuffled(mix_sources(docs, seed=MIX_SEED)).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return shard_rows(docs, N_SHARDS, ["doc_id"], SHARD_SEED)


STAGES = [("language ID", language_id), ("SimHash near-dedup", simhash_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]
#: The language model is fitted and SimHash components are iterative: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents`` one after another."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
