"""Feature matrix, imputation and the boosted-tree model of the jobs.

The booster itself is ``operators.booster``; its parameters are the fixed
values of the reference's configuration, penalties and child weight included.
Draws of rows and columns and the bin edges are its own, so scores rank like
the reference's but are not equal to them digit by digit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MODEL_INPUTS
from . import booster
from .booster import Booster, BoosterParams
from .metrics import auc_score

FILL_VALUE = 0  # scoring-time imputation of the reference
#: Trees that the reference scores with, of those it trains.
SCORE_TREES = 1500
#: What identifies a training row (its draw per tree depends on it).
ROW_KEY = ["username", "search_route", "label_dt"]


def impute(df: DataFrame, value: float = FILL_VALUE, columns: list[str] = MODEL_INPUTS) -> DataFrame:
    """P10: constant fill of the numeric feature columns; id strings stay null."""
    return df.na.fill(value, subset=[c for c in columns if c in df.columns])


def feature_matrix(df: DataFrame, value: float = FILL_VALUE) -> DataFrame:
    """P9 + M5 (tabular form): the 18 model inputs and the label, ids dropped."""
    cols = MODEL_INPUTS + (["label"] if "label" in df.columns else [])
    return impute(df, value).select(*cols)


def _part(df: DataFrame, name: str, split_col: str | None) -> DataFrame:
    return df.where(F.col(split_col) == F.lit(name)) if split_col and split_col in df.columns else df


def train(df: DataFrame, params: BoosterParams = BoosterParams(), split_col: str | None = "split",
          value: float = FILL_VALUE, path: str | None = None, stop_after: int | None = None) -> Booster:
    """M6: boost the imputed rows with split='train' (all rows without a split column).

    ``path`` names the folder of the boosting state: a run that stopped is
    continued from there.  The reference's watch set only reports a metric (its
    early stopping has no effect), so it is not used to stop: see ``watch_table``."""
    data = _part(impute(df, value), "train", split_col)
    return booster.train(data, MODEL_INPUTS, "label", [c for c in ROW_KEY if c in df.columns], params, path, stop_after)


def first_trees(model: Booster, k: int) -> Booster:
    """M7: the model of the first ``k`` trees (the reference scores with 1,500 of 2,000)."""
    return model.first(k)


def scoring_model(model: Booster) -> Booster:
    """The trees that are scored with: the first SCORE_TREES, or all of a shorter model."""
    return model.first(SCORE_TREES) if len(model.trees) > SCORE_TREES else model


def watch_table(model: Booster, df: DataFrame, every: int = 100, split_col: str = "split", value: float = FILL_VALUE) -> DataFrame:
    """(split, rounds, rows, auc, logloss) after every ``every`` trees, as the reference prints while it trains.

    Staged margins give one row per row and checkpoint in one walk over all
    trees; one grouped rank aggregate gives every AUC.
    """
    rows = impute(df, value).withColumn("label", F.col("label").cast("int"))
    if split_col not in rows.columns:
        rows = rows.withColumn(split_col, F.lit("train"))
    staged = booster.staged_scores(rows, model, every, [split_col, "label"])
    loss = staged.groupBy(split_col, "rounds").agg(
        F.count("*").alias("rows"),
        F.round(F.avg(F.expr("-ln(if(label = 1, score, 1 - score))")), 10).alias("logloss"))
    keys = [split_col, "rounds"]
    return loss.join(auc_score(staged, by=keys), keys).select(split_col, "rounds", "rows", "auc", "logloss")


def watch_auc(model: Booster, df: DataFrame, split_col: str = "split", value: float = FILL_VALUE) -> float | None:
    """Score AUC on the watch rows (split='test'); None if one class is absent."""
    scored = score(model, _part(df, "test", split_col), value)
    return auc_score(scored.select("label", F.col("q_ratio").alias("score"))).first()["auc"]


def score(model: Booster, df: DataFrame, value: float = FILL_VALUE, trees: int | None = None) -> DataFrame:
    """M8: probability of the positive class as ``q_ratio`` next to the ids, by the first ``trees`` trees or all."""
    return impute(df, value).withColumn("q_ratio", booster.score_column(model if trees is None else model.first(trees)))


def save(model: Booster, path: str) -> str:
    """M9."""
    return booster.save(model, SparkSession.active(), path)


def load(path: str) -> Booster:
    """M9."""
    return booster.load(SparkSession.active(), path)
