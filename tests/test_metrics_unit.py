"""Evaluation tables against hand-computed values."""

import pytest

from pairscope.operators import metrics
from pairscope.plans.pipelines import evaluate, with_predictions


def _scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def test_threshold_rules_at_exactly_half(spark):
    df = _scored(spark, [(1, 0.5), (0, 0.49), (1, 0.51)])
    out = df.select(metrics.threshold_class("score").alias("gt"),
                    metrics.threshold_class("score", inclusive=True).alias("ge")).collect()
    assert [(r.gt, r.ge) for r in out] == [(0, 1), (0, 0), (1, 1)]


def test_confusion_and_metrics_by_hand(spark):
    # tp=2 fp=1 fn=1 tn=3
    rows = [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.2), (0, 0.1), (0, 0.3), (0, 0.5)]
    ev = evaluate(_scored(spark, rows))
    cm = {r.prediction: (r.true_0, r.true_1) for r in ev["confusion_matrix"].collect()}
    assert cm == {1: (1, 2), 0: (3, 1)}
    m = ev["binary_metrics"].first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 1, 3)
    assert m.accuracy == pytest.approx(5 / 7)
    assert (m.precision, m.recall) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    assert m.f1 == pytest.approx(2 / 3)
    assert ev["auc_hard_label"].first().auc == pytest.approx((2 / 3 + 3 / 4) / 2)
    rep = {r["class"]: r for r in ev["classification_report"].collect()}
    assert rep["0"].precision == pytest.approx(3 / 4) and rep["0"].support == 4
    assert rep["weighted avg"].recall == pytest.approx(5 / 7)
    assert rep["accuracy"].f1_score == pytest.approx(5 / 7)


def test_class_without_predictions_and_empty_cell(spark):
    # nothing predicted positive: precision 0/0 -> 0; the crosstab has one row
    ev = evaluate(_scored(spark, [(1, 0.1), (0, 0.2), (0, 0.4)]))
    cm = [(r.prediction, r.true_0, r.true_1) for r in ev["confusion_matrix"].collect()]
    assert cm == [(0, 2, 1)]
    m = ev["binary_metrics"].first()
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0)


def test_auc_of_scores_counts_ties_half(spark):
    df = _scored(spark, [(1, 0.8), (0, 0.8), (1, 0.6), (0, 0.2)])
    # pairs: (0.8 vs 0.8) tie 0.5, (0.8 vs 0.2) 1, (0.6 vs 0.8) 0, (0.6 vs 0.2) 1 -> 2.5 / 4
    assert metrics.auc_score(df).first().auc == pytest.approx(0.625)


def test_hard_label_auc_undefined_with_one_class(spark):
    pred = with_predictions(_scored(spark, [(0, 0.1), (0, 0.9)]))
    assert metrics.auc_hard_label(pred).first().auc is None


def test_histogram_caps_top_bin(spark):
    h = metrics.score_histogram(_scored(spark, [(1, 1.0), (1, 0.96), (0, 0.0)]))
    assert sorted((r.label, r.bin, r["count"]) for r in h.collect()) == [(0, 0, 1), (1, 19, 2)]


def test_score_auc_is_null_for_one_class_and_lazy(spark):
    for label in (0, 1):
        df = spark.createDataFrame([(label, 0.2), (label, 0.7)], "label int, score double")
        assert metrics.auc_score(df).first().auc is None
    assert metrics.auc_score(spark.createDataFrame([], "label int, score double")).first().auc is None


def test_score_auc_against_all_pairs(spark):
    import random
    rng = random.Random(4)
    rows = [(rng.randrange(2), rng.choice([0.0, 1.0, 0.5, round(rng.random(), 2), rng.random() * 1e-5])) for _ in range(300)]
    rows += [(1, -0.5), (0, 1.5)]
    won = [(p > n) + 0.5 * (p == n) for y, p in rows if y == 1 for z, n in rows if z == 0]
    got = metrics.auc_score(spark.createDataFrame(rows, "label int, score double").repartition(3)).first().auc
    assert got == pytest.approx(sum(won) / len(won), abs=1e-9)
