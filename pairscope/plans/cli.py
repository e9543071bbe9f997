"""Command line for the daily jobs (``python -m pairscope.plans.cli <job> ...``).

  features      C1 + K1  build the feature partition of each run date, publish it
  training-set  C2       build the labelled training rows of label dates, write them
  train         C3 + M6 + C4 + M9  sample, split, train, evaluate, save the model
  score         C5       score one feature partition into the result table, show counts
  extract       C6       one feature partition to TSV with header

Source tables are catalog tables (or parquet paths) partitioned by a string
``dt``; ``--events-dir`` derives them from the test data's ``events`` table
instead.  Run dates and label dates are explicit parameters (ranges allowed),
so re-running any day is safe: partitions are replaced, never appended.
"""

from __future__ import annotations

import argparse
import json

from ..operators import model, sampling
from ..operators.features import serving_features
from ..operators.labels import training_set
from ..schemas import FEATURES, SCORES
from ..session import get_session
from ..sources.delimited import read_tsv
from ..sources.events import EventTables
from ..sources.partitioned import PartitionedTable
from ..sources.tables import CatalogTables
from ..windows import date_range
from . import pipelines


def _tables(spark, a):
    if a.events_dir:
        return EventTables(spark, a.events_dir)
    return CatalogTables(spark, a.list_table, a.ota_table, a.order_table, a.tag_table)


def _dates(first: str, last: str | None) -> list[str]:
    return date_range(first, last or first)


def _show(df, n=20):
    for r in df.limit(n).collect():
        print(json.dumps(r.asDict(), default=str))


def cmd_features(spark, a):
    feats = serving_features(_tables(spark, a), _dates(a.run_date, a.run_date_to))
    table = PartitionedTable(spark, a.out_table, FEATURES).create().overwrite_partitions(feats)
    _show(table.partition_counts(5))


def cmd_training_set(spark, a):
    rows = training_set(_tables(spark, a), _dates(a.label_date, a.label_date_to))
    # Rows of a day meet before the write (a large day is split), else every task would write a file per day.
    (rows.hint("rebalance", "label_dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("label_dt").parquet(a.out))


def cmd_train(spark, a):
    data = spark.read.parquet(a.training)
    split = pipelines.build_training_split(data, a.n_sample, a.test_size, a.fill_value)
    fitted = model.train(split.sample, model.BoosterParams().with_iterations(a.iterations), value=a.fill_value, path=a.state)
    for r in model.watch_table(fitted, split.sample, a.report_every, value=a.fill_value).orderBy("split", "rounds").collect():
        print(json.dumps(r.asDict()))
    holdout = split.holdout
    if a.holdout_rows:  # only when asked for: the default evaluates every row
        holdout = sampling.hash_sample(holdout, a.holdout_rows)
    scored = model.score(model.scoring_model(fitted), holdout, a.fill_value).withColumnRenamed("q_ratio", "score")
    for name, table in pipelines.evaluate(scored, threshold=a.threshold).items():
        print(f"-- {name}")
        _show(table)
    model.save(fitted, a.model)


def cmd_score(spark, a):
    feats = PartitionedTable(spark, a.features_table, FEATURES)
    result = PartitionedTable(spark, a.result_table, SCORES)
    fitted = model.load(a.model)
    if a.trees:
        fitted = model.first_trees(fitted, a.trees)
    _show(pipelines.score_and_publish_checked(feats.read(a.dt), result, a.dt, fitted))


def cmd_extract(spark, a):
    path = pipelines.extract_partition(PartitionedTable(spark, a.features_table, FEATURES), a.dt, a.out)
    print(json.dumps({"path": path, "rows": read_tsv(spark, path, FEATURES).count()}))


def main(argv=None):
    p = argparse.ArgumentParser(prog="pairscope")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="job", required=True)

    def sources(sp):
        sp.add_argument("--events-dir", help="derive the sources from <dir>/events.parquet")
        for t in ("list", "ota", "order", "tag"):
            sp.add_argument(f"--{t}-table")

    sp = sub.add_parser("features")
    sources(sp)
    sp.add_argument("--run-date", required=True)
    sp.add_argument("--run-date-to")
    sp.add_argument("--out-table", required=True)
    sp.set_defaults(fn=cmd_features)

    sp = sub.add_parser("training-set")
    sources(sp)
    sp.add_argument("--label-date", required=True)
    sp.add_argument("--label-date-to")
    sp.add_argument("--out", required=True)
    sp.set_defaults(fn=cmd_training_set)

    sp = sub.add_parser("train")
    sp.add_argument("--training", required=True)
    sp.add_argument("--model", required=True)
    sp.add_argument("--n-sample", type=int, default=50_000)
    sp.add_argument("--test-size", type=float, default=0.5)
    sp.add_argument("--iterations", type=int, default=2000)
    sp.add_argument("--state", help="folder of the boosting state: a run that stopped is continued from there")
    sp.add_argument("--fill-value", type=float, default=model.FILL_VALUE)
    sp.add_argument("--threshold", type=float, default=0.5)
    sp.add_argument("--holdout-rows", type=int, default=None, help="evaluate a seeded sample of this size only")
    sp.add_argument("--report-every", type=int, default=100, help="trees between two reported metrics")
    sp.set_defaults(fn=cmd_train)

    sp = sub.add_parser("score")
    sp.add_argument("--features-table", required=True)
    sp.add_argument("--result-table", required=True)
    sp.add_argument("--dt", required=True)
    sp.add_argument("--model", required=True, help="folder of the saved model")
    sp.add_argument("--trees", type=int, help="score with the first trees of the model only")
    sp.set_defaults(fn=cmd_score)

    sp = sub.add_parser("extract")
    sp.add_argument("--features-table", required=True)
    sp.add_argument("--dt", required=True)
    sp.add_argument("--out", required=True)
    sp.set_defaults(fn=cmd_extract)

    a = p.parse_args(argv)
    spark = get_session(a.master)
    a.fn(spark, a)


if __name__ == "__main__":
    main()
