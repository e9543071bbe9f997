"""Every registered query against its DuckDB oracle (the driver's check, at sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001, SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
ORACLES = E.oracle_sql()
#: Their samples need more positives than the smallest tables hold.
SAMPLED = {"balanced_sample", "balanced_slices", "holdout_complement", "holdout_sample", "train_test_split", "split_counts",
           "gbt_score_ranges", "gbt_split_gains", "gbt_first_trees", "model_roundtrip", "gbt_holdout_counts", "publish_model_scores"}
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _sorted_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    def connect(sf):
        c = duckdb.connect()
        for t in TABLES:
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        return c
    return {sf: connect(sf) for sf in (SF0001, SF001)}


def test_every_query_is_registered_with_an_oracle_or_rows_only():
    rows_only = set(QUERIES) - set(ORACLES)
    rows_only -= {"op1_html_extract", "op3_quality_trees", "op4_section_tokens", "op7_simhash_groups", "op8_line_dedup",
                  "op9_language_id", "op12_quality_rules", "pipeline"}           # the training-data operators have tests of their own
    assert rows_only == {"peek_results", "gbt_train_score", "gbt_evaluate", "watch_auc_by_round"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sf = SF001 if name in SAMPLED else SF0001
    df = QUERIES[name](spark, sf)
    res = con[sf].execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == _sorted_rows(ocols, res.fetchall())


def test_oracles_import_nothing_of_the_package():
    import oracles
    with open(oracles.__file__) as f:
        assert "pairscope" not in f.read()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "dt"
