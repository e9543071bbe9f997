import inspect
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from pairscope.llm import langid, oracles, queries

from .data import SCHEMA, messy, messy_rows

SF = "/root/testdata/sf0.001"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(oracles.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(names, want.fetchall()) == rows_of(got.columns, got.collect())


CONTRACT = {
    "op1_html_extract": ["page_id bigint", "url string", "text string", "n_chars bigint"],
    "op3_quality_trees": ["doc_id bigint", "held_out boolean", "score double", "predicted int"],
    "op5_feistel_shards": ["doc_id bigint", "size bigint", "text_crc32 bigint", "law string", "shard int", "slot bigint", "grown_shard int"],
    "op7_simhash_groups": ["doc_id bigint", "fingerprint string", "component_id bigint"],
    "op9_language_id": ["doc_id bigint", "held_out boolean", "lang_pred string", "score double"],
    "op11_vector_codes": ["vec_id bigint", "code string", "error bigint", "label_error bigint", "codebooks_sha256 string"],
    "op12_quality_rules": ["doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint", "n_repeat_words bigint",
                           "base_failed boolean", "kept boolean"],
    "op13_filter_audit": ["part string", "filter_order string", "step int", "kept bigint", "removed bigint", "redundant bigint",
                          "unique_fails bigint", "good_lost bigint", "toxic_lost bigint", "shapley bigint"],
    "op10_exact_dedup": ["doc_id bigint", "keep_id bigint", "group_size bigint", "kept boolean", "text_sha256 string"],
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns_come_first(spark, name):
    assert [f"{a} {b}" for a, b in queries.QUERIES[name](spark, SF).dtypes][: len(CONTRACT[name])] == CONTRACT[name]


def test_mix_and_shards_move_whole_rows(spark, monkeypatch):
    whole, moved = set(spark.read.parquet(f"{SF}/documents.parquet").columns), {}

    def watch(name):
        f = getattr(queries, name)

        def run(df, *args, **kwargs):
            out = f(df, *args, **kwargs)
            moved.setdefault(name, out.columns)
            return out
        monkeypatch.setattr(queries, name, run)
    for name in ("shuffled", "shard_rows"):
        watch(name)
    assert queries.op6_poisson_mix(spark, SF).columns == ["doc_id", "source", "copy", "shuffle_key"]
    queries.op5_feistel_shards(spark, SF)
    assert whole < set(moved["shuffled"]) and whole < set(moved["shard_rows"])


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("kind", ["messy", "empty"])
def test_pipeline_stages(spark, kind):
    docs = spark.createDataFrame(messy_rows(spark), SCHEMA)
    docs = docs.limit(0) if kind == "empty" else docs
    for name, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        out = corpus_pipeline.materialise(stage(spark, docs, SF), "test-stage")
        if stage is not corpus_pipeline.sharding:
            assert out.columns == docs.columns
            known = {tuple(r) for r in docs.collect()}
            assert {tuple(r) for r in out.collect()} <= known
        if stage in (corpus_pipeline.simhash_dedup, corpus_pipeline.decontamination):
            assert out.count() <= docs.count()
        docs = out
    if kind == "messy":
        assert docs.count() > 20 and {"shard", "slot"} <= set(docs.columns)
    else:
        assert docs.count() == 0


def test_language_stage_keeps_what_it_identifies(spark):
    docs = messy(spark)
    kept = corpus_pipeline.language_id(spark, docs, SF)
    k = len(langid.fit(messy(spark, clashes=False)).classes)
    scored = langid.identify(messy(spark, clashes=False)).where(f"lang_pred <> 'und' and score >= {1 / k + (1 - 1 / k) / 15} and known >= 0.5")
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((r.doc_id, r.text) for r in scored.collect())
