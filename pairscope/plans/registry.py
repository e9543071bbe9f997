"""Every operator as a named query ``(spark, sf_dir) -> DataFrame``.

The test data's tables are read through ``EventTables``; the dates come from
the data: serving for every run date whose search window touches it (a daily
backfill), training pooled over every label day with a full two-day search
window before it.  Queries that publish write to a fresh database under the
shared checkpoint folder on each call, dropped when the driver process ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import valid_user
from ..operators import features as feat
from ..operators import booster, labels, logs, metrics, model, sampling
from ..operators.history_state import HistoryState
from ..schemas import FEATURES, MODEL_INPUTS, SCORES, TAG_FLAGS
from ..session import drop_at_exit, scratch_path
from ..sources.delimited import read_scores_csv, read_tsv, write_scores_csv
from ..sources.events import EventTables
from ..sources.partitioned import PartitionedTable, create_database
from ..windows import SERVING, TRAINING, date_range, shift, window_bounds
from . import pipelines

# Parameters of the registered queries.
RUN_DATE = "20240130"   # the single-day queries: searches of 28th-29th, dt=20240129
LABEL_DATE = "20240120"
N_SAMPLE = 50           # per class: the bound of the labelled rows that the classifier is fitted on
SLICE_SIZE, SLICE_PRED_SIZE = 40, 10
HOLDOUT_N = 200
TEST_SIZE = 0.5
PUBLISH_DT = shift(RUN_DATE, SERVING.output_offset)
BUCKETS = 8             # of the tables that are bucketed by user
WATCH_EVERY = 100       # trees between two reported metrics

Query = Callable[[SparkSession, str], DataFrame]
KEY = sampling.KEY


def _t(spark: SparkSession, sf: str) -> EventTables:
    return EventTables(spark, sf)


def _run_dates(t: EventTables) -> list[str]:
    """Run dates whose search window (R-2 .. R-1) holds a day of data."""
    first, last = t.days
    return date_range(shift(first, SERVING.searches.near), shift(last, SERVING.searches.back))


def _label_dates(t: EventTables) -> list[str]:
    """Label days of the data with all days of their search window in it."""
    first, last = t.days
    return date_range(shift(first, TRAINING.searches.back), last)


# ---------------------------------------------------------------- sources
def unified_search_log(spark, sf):
    return logs.unified_search_log(_t(spark, sf), None, None)


def valid_user_filter(spark, sf):
    t = _t(spark, sf)
    users = (t.list_log(None, None).select(F.lit("list").alias("source"), F.col("username").alias("u"))
             .unionByName(t.ota_log(None, None).select(F.lit("ota").alias("source"), F.col("username").alias("u")))
             .unionByName(t.orders(None, None).select(F.lit("orders").alias("source"),
                                                      F.col("username").alias("u"))))
    return (users.where(valid_user("u")).groupBy("source", F.col("u").alias("username"))
                 .agg(F.count(F.lit(1)).alias("row_cnt")))


def paid_orders_window(spark, sf):
    return logs.paid_orders(_t(spark, sf), *SERVING.history.bounds(RUN_DATE))


def recent_buyers(spark, sf):
    t = _t(spark, sf)
    return (logs.recent_buyers(t, _label_dates(t), TRAINING.recent_buyers)
                .withColumnRenamed(logs.ANCHOR, "label_dt"))


def order_history_routes(spark, sf):
    return logs.order_history_routes(_t(spark, sf), *SERVING.history.bounds(RUN_DATE))


def user_tag_flags(spark, sf):
    return logs.user_tag_flags(_t(spark, sf))


def date_window_bounds(spark, sf):
    days = logs.unified_search_log(_t(spark, sf), None, None).select(F.col("dt").alias("anchor_dt")).distinct()
    s = window_bounds(F.col("anchor_dt"), SERVING)
    tr = window_bounds(F.col("anchor_dt"), TRAINING)
    return days.select("anchor_dt", s["search_lo"], s["search_hi"], s["recent_lo"], s["recent_hi"],
                       s["history_lo"].alias("serving_history_lo"), s["history_hi"].alias("serving_history_hi"),
                       s["output_dt"], tr["history_lo"].alias("training_history_lo"),
                       tr["history_hi"].alias("training_history_hi"))


# ---------------------------------------------------------------- serving parts
def _serving_pairs(spark, sf):
    t = _t(spark, sf)
    return feat.pair_aggregates(feat.serving_log(t, _run_dates(t)))


def exclude_recent_buyers_log(spark, sf):
    t = _t(spark, sf)
    runs = _run_dates(t)
    kept = feat.exclude_recent_buyers(feat.serving_log(t, runs), logs.recent_buyers(t, runs, SERVING.recent_buyers))
    return kept.withColumnRenamed(logs.ANCHOR, "run_dt")


def exclude_recent_buyers_pairs(spark, sf):
    """J3 as serving runs it: on aggregated pairs."""
    t = _t(spark, sf)
    runs = _run_dates(t)
    pairs = feat.pair_aggregates(feat.serving_log(t, runs))
    kept = feat.exclude_recent_buyers(pairs, logs.recent_buyers(t, runs, SERVING.recent_buyers))
    return kept.select(logs.USER, F.col(logs.ANCHOR).alias("run_dt"), logs.ROUTE, "search_route_single_cnt",
                       "ota_route_single_cnt")


def pair_counts(spark, sf):
    return _serving_pairs(spark, sf).select(
        logs.USER, F.col(logs.ANCHOR).alias("run_dt"), logs.ROUTE,
        "search_route_single_cnt", "ota_route_single_cnt")


def lead_days_stats(spark, sf):
    return _serving_pairs(spark, sf).select(
        logs.USER, F.col(logs.ANCHOR).alias("run_dt"), logs.ROUTE,
        "search_pre_days_max", "search_pre_days_min", "search_pre_days_avg",
        F.col("ota_pre_days_max_raw").alias("ota_pre_days_max"),
        F.col("ota_pre_days_min_raw").alias("ota_pre_days_min"),
        F.col("ota_pre_days_avg_raw").alias("ota_pre_days_avg"))


def _users(spark, sf):
    return feat.user_aggregates(_serving_pairs(spark, sf)).withColumnRenamed(logs.ANCHOR, "run_dt")


def user_totals(spark, sf):
    return _users(spark, sf).select(logs.USER, "run_dt", "search_route_cnt", "ota_route_cnt")


def user_city_counts(spark, sf):
    return _users(spark, sf).select(logs.USER, "run_dt", "dep_city_cnt", "arr_city_cnt")


def user_route_cnt(spark, sf):
    return _users(spark, sf).select(logs.USER, "run_dt", "route_cnt")


def _serving(spark, sf, cols):
    return serving_features(spark, sf).select(logs.USER, logs.ROUTE, "dt", *cols)


def pair_rates(spark, sf):
    return _serving(spark, sf, ["search_rate", "ota_rate"])


def lead_days_fallback(spark, sf):
    return _serving(spark, sf, ["ota_pre_days_max", "ota_pre_days_min", "ota_pre_days_avg"])


def history_route_flag(spark, sf):
    return _serving(spark, sf, ["has_history_route"])


def attach_user_tags(spark, sf):
    return _serving(spark, sf, ["is_student", "is_trader"])


def serving_features(spark, sf):
    t = _t(spark, sf)
    return feat.serving_features(t, _run_dates(t))


def serving_features_day(spark, sf):
    return feat.serving_features(_t(spark, sf), RUN_DATE)


def impute_constant(spark, sf):
    return model.impute(serving_features(spark, sf))


# ---------------------------------------------------------------- training parts
def label_day_orders(spark, sf):
    t = _t(spark, sf)
    return (labels.with_route_set_size(labels.label_day_orders(t, _label_dates(t)))
                  .withColumnRenamed(logs.ANCHOR, "label_dt"))


def exclude_recent_buyers_orders(spark, sf):
    t = _t(spark, sf)
    return (labels.label_orders_without_recent_buyers(t, _label_dates(t))
                  .withColumnRenamed(logs.ANCHOR, "label_dt"))


def pre_order_searches(spark, sf):
    t = _t(spark, sf)
    rows = labels.pre_order_searches(t, _label_dates(t))
    return (rows.groupBy(logs.USER, F.col(logs.ANCHOR).alias("label_dt"), "log_time", logs.ROUTE,
                         "dep_city", "arr_city", "pre_days", "process")
                .agg(F.sum("fanout").cast("int").alias("fanout"),
                     F.max(F.col("in_label").cast("int")).alias("in_label")))


def _training(spark, sf):
    t = _t(spark, sf)
    return labels.training_set(t, _label_dates(t))


def pair_label(spark, sf):
    return _training(spark, sf).select(*KEY, "label")


def training_set(spark, sf):
    return _training(spark, sf)


def training_set_day(spark, sf):
    return labels.training_set(_t(spark, sf), LABEL_DATE)


def feature_matrix(spark, sf):
    return model.feature_matrix(_training(spark, sf))


# ---------------------------------------------------------------- sampling
def _labelled_keys(spark, sf):
    return pair_label(spark, sf)


def balanced_sample(spark, sf):
    return sampling.balanced_sample(pipelines.materialize(_labelled_keys(spark, sf)), N_SAMPLE)


def balanced_slices(spark, sf):
    return sampling.balanced_slices(pipelines.materialize(_labelled_keys(spark, sf)), SLICE_SIZE, SLICE_PRED_SIZE)


def _split(spark, sf):
    """Sample, split and holdout of the keys (all that these queries return)."""
    return pipelines.build_training_split(_labelled_keys(spark, sf), N_SAMPLE, TEST_SIZE)


def holdout_complement(spark, sf):
    return _split(spark, sf).holdout.select(*KEY, "label")


def holdout_sample(spark, sf):
    holdout = _split(spark, sf).holdout
    return sampling.hash_sample(holdout, HOLDOUT_N).select(*KEY, "label")


def train_test_split(spark, sf):
    return _split(spark, sf).sample.select(*KEY, "label", "split")


def split_counts(spark, sf):
    return metrics.split_counts(pipelines.split_table(_split(spark, sf)))


# ---------------------------------------------------------------- metrics
def _scored(spark, sf):
    tr = _training(spark, sf)
    return tr.withColumn("score", pipelines.heuristic_score(tr))


def label_distribution(spark, sf):
    return metrics.label_distribution(_training(spark, sf))


def class_ratio(spark, sf):
    return metrics.class_ratio(_training(spark, sf))


def threshold_class(spark, sf):
    s = _scored(spark, sf)
    return s.select(*KEY, "label", "score",
                    metrics.threshold_class("score").alias("pred_gt"),
                    metrics.threshold_class("score", inclusive=True).alias("pred_ge"))


def _evaluation(spark, sf, name):
    return pipelines.evaluate(_scored(spark, sf))[name]


def confusion_matrix(spark, sf):
    return _evaluation(spark, sf, "confusion_matrix")


def binary_metrics(spark, sf):
    return _evaluation(spark, sf, "binary_metrics")


def classification_report(spark, sf):
    return _evaluation(spark, sf, "classification_report")


def auc_hard_label(spark, sf):
    return _evaluation(spark, sf, "auc_hard_label")


def score_histogram(spark, sf):
    return _evaluation(spark, sf, "score_histogram")


def auc_score(spark, sf):
    return metrics.auc_score(_scored(spark, sf))


# ---------------------------------------------------------------- publishing
def _database(spark) -> str:
    name = f"pairscope_{uuid.uuid4().hex[:12]}"
    return drop_at_exit(spark, create_database(spark, name, scratch_path(spark, name)))


def _published_features(spark, sf) -> PartitionedTable:
    table = PartitionedTable(spark, f"{_database(spark)}.route_features", FEATURES).create()
    return table.overwrite_partitions(serving_features(spark, sf))


def publish_features(spark, sf):
    table = _published_features(spark, sf)
    # A re-run of one day replaces that day only (idempotent, others intact).
    table.overwrite_partitions(feat.serving_features(_t(spark, sf), RUN_DATE))
    return table.read()


def feature_partition_extract(spark, sf):
    return _published_features(spark, sf).read(PUBLISH_DT)


def drop_partition(spark, sf):
    return _published_features(spark, sf).drop_partition(PUBLISH_DT).read()


def overwrite_partition_empty(spark, sf):
    """K4 with an empty frame: that partition is emptied, its neighbours stay."""
    table = _published_features(spark, sf)
    return table.overwrite_partition(spark.createDataFrame([], FEATURES), PUBLISH_DT).partition_counts(1000)


def drop_table(spark, sf):
    """K7: the tables of a database after one of two is dropped, with the rows of the one that stays."""
    kept = _published_features(spark, sf)
    db = kept.name.split(".")[0]
    gone = PartitionedTable(spark, f"{db}.route_scores", SCORES).create()
    gone.overwrite_partition(pipelines.score_features(kept.read(PUBLISH_DT)), PUBLISH_DT)
    gone.drop()
    names = [t.name for t in spark.catalog.listTables(db)]
    return kept.read().groupBy(F.lit(",".join(sorted(names))).alias("tables")).agg(F.count(F.lit(1)).alias("rows"))


def partition_counts_latest(spark, sf):
    return _published_features(spark, sf).partition_counts(5)


def tsv_roundtrip(spark, sf):
    path = pipelines.extract_partition(_published_features(spark, sf), PUBLISH_DT,
                                       scratch_path(spark, "extract"))
    return read_tsv(spark, path, FEATURES)


def _published_scores(spark, sf) -> PartitionedTable:
    db = _database(spark)
    feats = _published_features(spark, sf)
    # The reference's hand-off: scores to a CSV file, file loaded into the partition.
    scored = pipelines.score_features(feats.read(PUBLISH_DT))
    csv = write_scores_csv(scored, scratch_path(spark, "scores-csv"))
    result = PartitionedTable(spark, f"{db}.route_scores", SCORES).create()
    return result.overwrite_partition(read_scores_csv(spark, csv), PUBLISH_DT)


def publish_scores(spark, sf):
    return _published_scores(spark, sf).read()


def publish_model_scores(spark, sf):
    """C5 as run: the model's scores staged, checked and swapped in; a day that fails the check leaves the old one."""
    feats = _published_features(spark, sf)
    result = PartitionedTable(spark, f"{_database(spark)}.route_scores", SCORES)
    _, fitted = _fitted(spark, sf)
    pipelines.score_and_publish_checked(feats.read(), result, PUBLISH_DT, fitted)
    part = feats.read(PUBLISH_DT)
    refused = []
    for bad in (part.where("false"), part.unionByName(part)):
        try:
            pipelines.publish_checked(pipelines.score_features(bad, fitted), result, PUBLISH_DT, part.count())
        except pipelines.PublishError:
            refused.append(1)
    return result.read().select("username", "search_route", "dt", F.expr("q_ratio BETWEEN 0 AND 1").alias("is_probability"),
                                F.lit(len(refused)).alias("refused"))


def _bucketed(spark, name, schema) -> PartitionedTable:
    return PartitionedTable(spark, f"{_database(spark)}.{name}", schema, "orc", BUCKETS, [logs.USER]).create()


def publish_features_orc(spark, sf):
    """K5 + K1: the feature table as ORC, bucketed and sorted by user."""
    table = _bucketed(spark, "route_features", FEATURES).overwrite_partitions(serving_features(spark, sf))
    table.overwrite_partitions(feat.serving_features(_t(spark, sf), RUN_DATE))
    return table.read()


def _history_state(spark, sf) -> HistoryState:
    """Two years of orders loaded at once, up to four days before the run date, then advanced day by day."""
    t = _t(spark, sf)
    lo, hi = SERVING.history.bounds(RUN_DATE)
    state = HistoryState(spark, f"{_database(spark)}.order_history", BUCKETS).create()
    state.load(t, lo, shift(hi, -3))
    for day in date_range(shift(hi, -2), hi):
        state.advance(t, day)
    return state


def history_state_routes(spark, sf):
    """A6 from the daily state."""
    return _history_state(spark, sf).routes(*SERVING.history.bounds(RUN_DATE))


def _kept(spark, sf) -> feat.StoredTables:
    tags = _bucketed(spark, "tag_flags", TAG_FLAGS)
    flags = logs.user_tag_flags(_t(spark, sf)).withColumnRenamed("key", logs.USER)
    return feat.StoredTables(_history_state(spark, sf), tags.overwrite_partition(flags, PUBLISH_DT), PUBLISH_DT)


def serving_features_stored(spark, sf):
    """C1 for one run date from the daily state: reads that day's searches and the stored tables."""
    return feat.serving_features(_t(spark, sf), RUN_DATE, kept=_kept(spark, sf))


def colocated_flags(spark, sf):
    """K5 + J4 + J5 on tables bucketed by user: tag and history flags of a published day, joined without an exchange."""
    kept = _kept(spark, sf)
    table = _bucketed(spark, "route_features", FEATURES).overwrite_partitions(feat.serving_features(_t(spark, sf), RUN_DATE))
    return feat.colocated_flags(table.read(PUBLISH_DT), kept, RUN_DATE)


def peek_results(spark, sf):
    return _published_scores(spark, sf).read().limit(5)


def peek_counts(spark, sf):
    """O2: how many rows a LIMIT 5 peek shows, and how many of them the table holds."""
    rows = _published_scores(spark, sf).read()
    keys = ["username", "search_route", "dt"]
    held = rows.select(*[F.col(k).alias(f"t_{k}") for k in keys], F.lit(1).alias("held")).distinct()
    shown = pipelines.materialize(rows.limit(5).select(*keys))
    found = shown.join(held, F.expr(" AND ".join(f"{k} <=> t_{k}" for k in keys)), "left")
    return found.agg(F.count(F.lit(1)).alias("n_shown"), F.count("held").alias("n_held"))


# ---------------------------------------------------------------- model
def _model_split(spark, sf):
    return pipelines.build_training_split(_training(spark, sf), N_SAMPLE, TEST_SIZE)


def _fitted(spark, sf):
    """The reference's 2,000 rounds on the sample's training half."""
    split = _model_split(spark, sf)
    return split, model.train(split.sample)


def gbt_train_score(spark, sf):
    """M6-M8: every pair scored by the first 1,500 trees."""
    _, fitted = _fitted(spark, sf)
    return pipelines.score_features(feat.serving_features(_t(spark, sf), RUN_DATE), fitted)


def gbt_score_ranges(spark, sf):
    """M8: every pair is scored once, with a probability."""
    return gbt_train_score(spark, sf).select("username", "search_route", "dt",
                                             F.expr("coalesce(q_ratio BETWEEN 0 AND 1, false)").alias("is_probability"))


def gbt_split_gains(spark, sf):
    """M6: gradient and Hessian sums and penalised gain of every cut that the first split is chosen from."""
    data = _model_split(spark, sf).sample.where("split = 'train'")
    table = booster.split_table(model.impute(data), MODEL_INPUTS, "label", model.ROW_KEY)
    return table.withColumn("gain", F.round("gain", 9))


def _same_scores(a, b):
    keys = ["username", "search_route", "dt"]
    other = b.select(*[F.col(k).alias(f"o_{k}") for k in keys], F.col("q_ratio").alias("o_ratio"))
    return (a.join(other, F.expr(" AND ".join(f"{k} <=> o_{k}" for k in keys)), "left")
            .select(*keys, F.expr("coalesce(q_ratio = o_ratio, false)").alias("same")))


def gbt_first_trees(spark, sf):
    """M7: a run stopped after 1,500 rounds and then continued to 2,000: its first trees score like the shorter run."""
    split, path = _model_split(spark, sf), scratch_path(spark, "boosting")
    short = model.train(split.sample, path=path, stop_after=model.SCORE_TREES)
    longer = model.train(split.sample, path=path)
    rows = pipelines.materialize(feat.serving_features(_t(spark, sf), RUN_DATE))
    return _same_scores(model.score(longer, rows, trees=model.SCORE_TREES), model.score(short, rows))


def model_roundtrip(spark, sf):
    """M9: a saved and loaded model scores every pair like the one in memory."""
    _, fitted = _fitted(spark, sf)
    loaded = model.load(model.save(fitted, scratch_path(spark, "model")))
    rows = pipelines.materialize(feat.serving_features(_t(spark, sf), RUN_DATE))
    return _same_scores(model.score(fitted, rows), model.score(loaded, rows))


def watch_auc_by_round(spark, sf):
    """M6: AUC and log-loss of the training and the watch rows after every 100 of the 2,000 rounds."""
    split, fitted = _fitted(spark, sf)
    return model.watch_table(fitted, split.sample, WATCH_EVERY)


def _evaluated(spark, sf):
    split, fitted = _fitted(spark, sf)
    scored = model.score(model.scoring_model(fitted), split.holdout).withColumnRenamed("q_ratio", "score")
    return split, fitted, pipelines.evaluate(scored)["binary_metrics"]


def gbt_evaluate(spark, sf):
    """C3 -> M6 -> C4 with the model: metrics on the whole holdout, plus watch-set AUC."""
    split, fitted, metric = _evaluated(spark, sf)
    return metric.withColumn("watch_auc", F.lit(model.watch_auc(model.scoring_model(fitted), split.sample)).cast("double"))


def gbt_holdout_counts(spark, sf):
    """Rows of each class that the model is evaluated on."""
    return _evaluated(spark, sf)[2].select(F.expr("tp + fn").alias("n_pos"), F.expr("tn + fp").alias("n_neg"))


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    # flagship first
    serving_features, serving_features_day,
    unified_search_log, valid_user_filter, paid_orders_window, recent_buyers, order_history_routes,
    user_tag_flags, date_window_bounds,
    exclude_recent_buyers_log, exclude_recent_buyers_pairs, pair_counts, lead_days_stats, user_totals, user_city_counts,
    user_route_cnt, pair_rates, lead_days_fallback, history_route_flag, attach_user_tags,
    impute_constant,
    label_day_orders, exclude_recent_buyers_orders, pre_order_searches, pair_label,
    training_set, training_set_day, feature_matrix,
    balanced_sample, balanced_slices, holdout_complement, holdout_sample, train_test_split, split_counts,
    label_distribution, class_ratio, threshold_class, confusion_matrix, binary_metrics,
    classification_report, auc_hard_label, score_histogram, auc_score,
    publish_features, feature_partition_extract, overwrite_partition_empty, drop_partition, drop_table,
    partition_counts_latest, tsv_roundtrip, publish_scores, publish_model_scores, publish_features_orc, history_state_routes,
    serving_features_stored, colocated_flags, peek_results, peek_counts,
    gbt_train_score, gbt_score_ranges, gbt_split_gains, gbt_first_trees, model_roundtrip, watch_auc_by_round, gbt_evaluate,
    gbt_holdout_counts,
]}
