"""Evaluation tables over a (label, score) frame.

All counting metrics come from one aggregate of the four confusion counts
(partial aggregation on every task, a single small merge); the ratios are
computed on that one row.  Conventions follow the reference's metric library:
a 0/0 precision or recall is 0, and the "AUC" the reference prints is taken on
hard 0/1 predictions, which equals (TPR + TNR) / 2.  The score AUC is the
usual area under the ROC curve of the raw score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THRESHOLD = 0.5
HIST_BINS = 20


def threshold_class(score: Column | str, threshold: float = THRESHOLD, inclusive: bool = False) -> Column:
    """1 when score > threshold (``inclusive``: >=), else 0."""
    s = F.col(score) if isinstance(score, str) else score
    hit = s >= F.lit(threshold) if inclusive else s > F.lit(threshold)
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))


def _zero_div(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return _zero_div(2 * p * r, p + r)


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label, most frequent first."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), label)


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """TP/FP/FN/TN in one aggregate row."""
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count(F.when((p == 1) & (y == 1), 1)).alias("tp"),
        F.count(F.when((p == 1) & (y == 0), 1)).alias("fp"),
        F.count(F.when((p == 0) & (y == 1), 1)).alias("fn"),
        F.count(F.when((p == 0) & (y == 0), 1)).alias("tn"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Predicted class x true class (crosstab: only predicted classes that occur)."""
    y = F.col(label)
    return (df.groupBy(F.col(pred).alias("prediction"))
              .agg(F.count(F.when(y == 0, 1)).alias("true_0"),
                   F.count(F.when(y == 1, 1)).alias("true_1")))


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, F1 of the positive class."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    precision = _zero_div(tp, tp + fp)
    recall = _zero_div(tp, tp + fn)
    return c.select(
        "tp", "fp", "fn", "tn",
        _zero_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
    )


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    p1, r1 = _zero_div(tp, tp + fp), _zero_div(tp, tp + fn)
    p0, r0 = _zero_div(tn, tn + fn), _zero_div(tn, tn + fp)
    f1_1, f1_0 = _f1(p1, r1), _f1(p0, r0)
    s1, s0 = tp + fn, tn + fp

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        s.cast("long").alias("support"))

    rows = F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", F.lit(None), F.lit(None), _zero_div(tp + tn, total), total),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, total),
        row("weighted avg", _zero_div(p0 * s0 + p1 * s1, total), _zero_div(r0 * s0 + r1 * s1, total),
            _zero_div(f1_0 * s0 + f1_1 * s1, total), total),
    )
    # One aggregate row fans out into the five report rows (no union of re-computed branches).
    return c.select(F.inline(rows))


def auc_hard_label(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """A15 as printed by the reference: ROC AUC of 0/1 predictions = (TPR + TNR) / 2.
    Null when one class is absent (undefined)."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    tpr = F.try_divide(tp.cast("double"), (tp + fn).cast("double"))
    tnr = F.try_divide(tn.cast("double"), (tn + fp).cast("double"))
    return c.select(((tpr + tnr) / 2).alias("auc"))


def auc_score(df: DataFrame, label: str = "label", score: str = "score", digits: int = 10,
              buckets: int = 4096, by: Sequence[str] = ()) -> DataFrame:
    """A15, score form: area under the ROC curve of the raw score, as one lazy row, or one per value of ``by``.

    The rank formula: every positive counts the negatives scored below it, and
    half of those scored alike.  Equal scores are merged first; running counts
    are kept per score bucket, and only one row per bucket (a fixed number per
    group) meets in a single task.  Null when one class is absent (undefined)."""
    s = F.col(score).cast("double")
    keys = list(by)
    ties = (df.where(s.isNotNull()).groupBy(*keys, s.alias("s"))
            .agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) == 0).cast("long")).alias("neg"))
            .withColumn("b", F.least(F.greatest(F.floor(F.col("s") * buckets), F.lit(0)), F.lit(buckets - 1))))
    within = Window.partitionBy(*keys, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = (ties.withColumn("below", F.coalesce(F.sum("neg").over(within), F.lit(0))).groupBy(*keys, "b")
                  .agg(F.sum(F.expr("pos * (below + 0.5D * neg)")).alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    over = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    return (per_bucket.withColumn("before", F.coalesce(F.sum("neg").over(over), F.lit(0))).groupBy(*keys)
            .agg(F.sum(F.expr("won + pos * before")).alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
            .select(*keys, F.expr(f"round(try_divide(won, cast(pos as double) * neg), {digits})").alias("auc")))


def score_histogram(df: DataFrame, label: str = "label", score: str = "score", bins: int = HIST_BINS) -> DataFrame:
    """Score distribution per true class (the data of the reference's plot)."""
    b = F.least(F.floor(F.col(score) * bins).cast("int"), F.lit(bins - 1))
    return (df.groupBy(F.col(label).alias("label"), b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))


def class_ratio(df: DataFrame, label: str = "label") -> DataFrame:
    """Negatives per positive (the ``scale_pos_weight`` of the booster)."""
    y = F.col(label)
    return (df.agg(F.count(F.when(y == 1, 1)).alias("n_pos"), F.count(F.when(y == 0, 1)).alias("n_neg"))
              .withColumn("scale_pos_weight", F.try_divide(F.col("n_neg").cast("double"),
                                                           F.col("n_pos").cast("double"))))


def split_counts(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Rows per (split, label)."""
    return df.groupBy(split, label).agg(F.count(F.lit(1)).alias("count"))
