"""Sampling and splitting: exactness, independence of the draws, invariance."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import sorted_rows
from pairscope.operators import sampling
from pairscope.plans import pipelines, registry


def _frame(spark, n=400, pos_every=7):
    rows = [(f"u{i % 37}", None if i % 11 == 0 else f"D{i % 4}-A{i % 5}", f"202401{10 + i % 3}",
             1 if i % pos_every == 0 else 0) for i in range(n)]
    df = spark.createDataFrame(rows, "username string, search_route string, label_dt string, label int")
    return df.dropDuplicates(sampling.KEY)


def _keys(df):
    return sorted_rows(df.select(*sampling.KEY))


@pytest.mark.parametrize("listed", [10_000, 5, 0])
@pytest.mark.parametrize("n", [1, 2, 25, 399])
def test_nth_smallest_equals_full_sort(spark, monkeypatch, listed, n):
    monkeypatch.setattr(sampling, "LISTED", listed)
    monkeypatch.setattr(sampling, "PREFIX", 1)
    hashes = spark.range(400).select(F.md5(F.col("id").cast("string")).alias("h"))
    full = sorted(r.h for r in hashes.collect())
    assert sampling.nth_smallest(hashes, F.col("h"), n) == full[n - 1]
    assert sampling.nth_smallest(hashes, F.col("h"), 401) is None


def test_nth_smallest_of_equal_hashes(spark):
    same = spark.range(20).select(F.md5(F.lit("x")).alias("h"))
    assert sampling.nth_smallest(same, F.col("h"), 7) == same.first().h
    assert sampling.nth_smallest(same.limit(0), F.col("h"), 1) is None


def test_sample_equals_full_sort_per_class(spark):
    df = _frame(spark)
    got = _keys(sampling.balanced_sample(df, 10))
    want = []
    for label, purpose, seed in ((1, "sample-pos", 1), (0, "sample-neg", 43)):
        h = sampling.hash_col(purpose, seed)
        want += _keys(df.where(F.col("label") == label).orderBy(h).limit(10))
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 20


def test_hash_sample_equals_full_sort(spark):
    df = _frame(spark)
    assert _keys(sampling.hash_sample(df, 25)) == _keys(df.orderBy(sampling.hash_col("holdout", 90)).limit(25))


def test_sample_invariant_under_repartitioning(spark):
    df = _frame(spark)
    a = _keys(sampling.balanced_sample(df, 10))
    b = _keys(sampling.balanced_sample(df.repartition(7), 10))
    assert a == b and len(a) == 20


def test_sample_and_holdout_partition_the_input(spark):
    df = _frame(spark)
    drawn = sampling.sample_condition(df, 10)
    ks, kh = set(_keys(df.where(drawn))), set(_keys(sampling.holdout_complement(df, drawn)))
    assert not ks & kh and len(ks) == 20
    assert ks | kh == set(_keys(df))


def test_class_smaller_than_n_is_an_error(spark):
    df = _frame(spark, pos_every=1000)   # a single positive
    with pytest.raises(ValueError, match="label 1"):
        sampling.balanced_sample(df, 10)
    with pytest.raises(ValueError, match="holdout"):
        sampling.hash_sample(df, 10_000)


def test_slices(spark):
    df = _frame(spark)
    sl = sampling.balanced_slices(df, 8, 3)
    counts = {(r.label, r.slice): r["count"] for r in sl.groupBy("label", "slice").count().collect()}
    assert counts == {(1, "train"): 8, (1, "predict"): 3, (0, "train"): 8, (0, "predict"): 3}
    few = sampling.balanced_slices(_frame(spark, pos_every=1000), 8, 3)   # slices may be short
    assert few.where("label = 1").count() == 1 and few.where("label = 0").count() == 11


@pytest.mark.parametrize("share", [0.25, 0.5, 0.0, 1.0])
def test_split_sizes_are_exact(spark, share):
    import math
    df = _frame(spark)
    split = sampling.train_test_split(df, share)
    n = df.count()
    assert split.where("split = 'test'").count() == math.ceil(share * n)
    assert _keys(split.where("split = 'train'")) == _keys(
        sampling.train_test_split(df.repartition(5), share).where("split = 'train'"))


def test_split_is_independent_of_the_sample(spark):
    """The negative sample and the split have one seed; their draws must not be the same."""
    rows = [(f"u{i}", "r", "20240101", i % 2) for i in range(4000)]
    df = spark.createDataFrame(rows, "username string, search_route string, label_dt string, label int")
    split = sampling.train_test_split(pipelines.materialize(sampling.balanced_sample(df, 400)), 0.5)
    counts = {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert all(150 < counts[(label, s)] < 250 for label in (0, 1) for s in ("train", "test"))


def test_both_classes_are_watched_on_the_data(spark):
    counts = {(r.label, r.split): r["count"] for r in registry.split_counts(spark, SF001).collect()}
    assert all(counts[(label, s)] >= 15 for label in (0, 1) for s in ("train", "test"))
    assert sum(n for (_, s), n in counts.items() if s == "train") == 50


def test_plans_hold_no_sort_and_no_join(spark):
    df = _frame(spark)
    drawn = sampling.sample_condition(df, 10)
    for out in (df.where(drawn), sampling.holdout_complement(df, drawn), sampling.balanced_slices(df, 8, 3),
                sampling.hash_sample(df, 20), sampling.train_test_split(df, 0.5)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert not any(op in plan for op in ("Join", "Sort", "Limit", "Window"))
