"""User-level compositions of the operators (the reference's daily jobs).

C1 serving features and C2 the training set live in ``operators``; here:

C3 ``build_training_split``  impute -> balanced sample -> holdout -> split
C4 ``evaluate``              threshold -> confusion matrix / metrics / AUC
C5 ``score_and_publish``     feature partition -> impute -> score -> result partition -> counts
C6 ``extract_partition``     feature partition -> TSV with header

Frames used more than once (the training set feeds the sample, its
complement and several counts; the sample feeds the fit and the watch metrics)
are written once as Parquet to the cluster's shared checkpoint folder, which
also cuts their lineage, instead of being recomputed from the logs; readers
then scan just the columns they need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import metrics, model, sampling
from ..schemas import SCORES
from ..session import remove_path, stored
from ..sources.delimited import write_tsv
from ..sources.partitioned import PartitionedTable


materialize = stored    # a frame used several times, as a table of the shared folder


def heuristic_score(df: DataFrame) -> Column:
    """A model-free score in [0, 1]: half the route's search share, half the
    history flag.  Used where a deterministic score is needed (metric tables
    with SQL oracles); scores of exactly 0.5 exercise the > / >= rules."""
    return (0.5 * F.coalesce(F.col("search_rate"), F.lit(0.0))
            + 0.5 * F.coalesce(F.col("has_history_route"), F.lit(0)).cast("double"))


@dataclass
class TrainingSplit:
    sample: DataFrame    # balanced sample with split = train | test
    holdout: DataFrame   # every row not in the sample


def build_training_split(training: DataFrame, n_sample: int, test_size: float = 0.5,
                         fill_value: float = model.FILL_VALUE) -> TrainingSplit:
    """P10 -> M1 (+F7, U2) -> J6 -> M4."""
    data = materialize(model.impute(training, fill_value))
    drawn = sampling.sample_condition(data, n_sample)
    sample = materialize(sampling.train_test_split(data.where(drawn), test_size))
    return TrainingSplit(sample=sample, holdout=sampling.holdout_complement(data, drawn))


def split_table(split: TrainingSplit) -> DataFrame:
    """Sample rows tagged train/test and holdout rows tagged holdout, for A18."""
    return split.sample.unionByName(split.holdout.withColumn("split", F.lit("holdout")))


def with_predictions(scored: DataFrame, score_col: str = "score", threshold: float = metrics.THRESHOLD,
                     inclusive: bool = False) -> DataFrame:
    return scored.withColumn("prediction", metrics.threshold_class(score_col, threshold, inclusive))


def evaluate(scored: DataFrame, score_col: str = "score", threshold: float = metrics.THRESHOLD,
             inclusive: bool = False) -> dict[str, DataFrame]:
    """C4: every evaluation table of a scored, labelled frame."""
    pred = with_predictions(scored, score_col, threshold, inclusive)
    return {
        "confusion_matrix": metrics.confusion_matrix(pred),
        "binary_metrics": metrics.binary_metrics(pred),
        "classification_report": metrics.classification_report(pred),
        "auc_hard_label": metrics.auc_hard_label(pred),
        "score_histogram": metrics.score_histogram(scored, score=score_col),
    }


def score_features(features: DataFrame, fitted: model.Booster | None = None,
                   fill_value: float = model.FILL_VALUE) -> DataFrame:
    """M8: (username, search_route, q_ratio, dt) for every feature row, by the trees that are scored with."""
    if fitted is None:
        scored = model.impute(features, fill_value).withColumn("q_ratio", heuristic_score(features))
    else:
        scored = model.score(model.scoring_model(fitted), features, fill_value)
    return scored.select(*[f.name for f in SCORES.fields])


def score_and_publish(features: DataFrame, result: PartitionedTable, dt: str,
                      fitted: model.Booster | None = None, latest: int = 5) -> DataFrame:
    """S5 -> P10 -> M8 -> K4 -> K8; returns the rows per newest partitions."""
    part = features.where(F.col("dt") == F.lit(dt))
    result.create().overwrite_partition(score_features(part, fitted).drop("dt"), dt)
    return result.partition_counts(latest)


class PublishError(RuntimeError):
    """A staged partition failed its check; the table is as it was."""


def check_scores(staged: DataFrame, expected_rows: int) -> list[str]:
    """K8 as a gate: what is wrong with staged scores (nothing, as a rule), in one pass over them."""
    key = F.struct(F.coalesce("username", F.lit("")), F.coalesce("search_route", F.lit("\\N")))
    r = staged.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("pairs"),
                   F.count(F.when(F.expr("q_ratio BETWEEN 0 AND 1 AND NOT isnan(q_ratio)"), 1)).alias("probabilities")).first()
    found = []
    if r.rows != expected_rows:
        found.append(f"{r.rows} rows instead of {expected_rows}")
    if r.pairs != r.rows:
        found.append(f"{r.rows - r.pairs} repeated pairs")
    if r.probabilities != r.rows:
        found.append(f"{r.rows - r.probabilities} scores that are no probability")
    return found


def publish_checked(scores: DataFrame, result: PartitionedTable, dt: str, expected_rows: int, latest: int = 5) -> DataFrame:
    """C5 with a gate: stage the day, check it, swap it in; returns the rows per newest partitions.

    Readers see the old day until the swap and the new one after it.  If the
    check fails the staged files go, the old day stays, and ``PublishError``
    says why.  The files of the replaced version are deleted.
    """
    path = result.create().stage(scores, dt)
    wrong = check_scores(result.staged(path, dt), expected_rows)
    if wrong:
        remove_path(result.spark, path)
        raise PublishError(f"{result.name} dt={dt}: {'; '.join(wrong)}")
    before = result.swap(dt, path)
    if before is not None:
        remove_path(result.spark, before)
    return result.partition_counts(latest)


def score_and_publish_checked(features: DataFrame, result: PartitionedTable, dt: str, fitted: model.Booster, latest: int = 5) -> DataFrame:
    """Score the feature partition ``dt`` with the model and publish it behind the check."""
    part = features.where(F.col("dt") == F.lit(dt))
    return publish_checked(score_features(part, fitted), result, dt, part.count(), latest)


def extract_partition(features: PartitionedTable, dt: str, path: str) -> str:
    """One feature partition to tab-separated text with a header."""
    return write_tsv(features.read(dt), path)
