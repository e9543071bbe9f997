"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, materialise, read_table
from .decontaminate import containment
from .exact_dedup import exact_dedup
from .filter_audit import audit
from .html_extract import extract
from .langid import identify
from .line_dedup import dedup_lines
from .mixing import mix_sources, shuffled
from .quality import score_quality
from .quality_rules import judge
from .sharding import shard_rows
from .simhash import simhash_groups
from .token_counts import section_tokens
from .vector_codes import compress

N_SHARDS = 16
MIX_SEED = 11
SHARD_SEED = 7
SIMHASH_WIDTH, SIMHASH_BITS = 3, 3
WORD_SHINGLE, SIMILARITY = 5, 0.8
QUALITY_THRESHOLD = 0.3


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                       width=WORD_SHINGLE, threshold=SIMILARITY).drop("digest")


def op3_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                         threshold=QUALITY_THRESHOLD)


def op4_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(read_table(spark, sf_dir, "documents"), rule="most")


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "*", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    keys = ["doc_id", "text_crc32", "size"]
    # The sharded rows are written with all their columns; their digest is returned.
    sharded = materialise(shard_rows(docs, N_SHARDS, keys, SHARD_SEED, bucket_by=keys), "sharded")
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The mixed corpus is written with all its columns; the list of it is returned.
    mixed = materialise(shuffled(mix_sources(read_table(spark, sf_dir, "documents"), seed=MIX_SEED)), "mixed")
    return mixed.select("doc_id", "source", "copy", "shuffle_key")


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(read_table(spark, sf_dir, "documents"), width=SIMHASH_WIDTH, max_bits=SIMHASH_BITS)
    return groups.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read_table(spark, sf_dir, "embeddings"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extract, op2_decontamination, op3_quality_trees, op4_section_tokens,
                            op5_feistel_shards, op6_poisson_mix, op7_simhash_groups, op8_line_dedup, op9_language_id,
                            op10_exact_dedup, op11_vector_codes, op12_quality_rules, op13_filter_audit)
}
