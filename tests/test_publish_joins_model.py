"""Sinks, delimited exchange and the model round trip."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from helpers import sorted_rows
from pairscope.operators import model
from pairscope.operators.labels import training_set
from pairscope.operators.features import serving_features
from pairscope.plans import pipelines
from pairscope.schemas import FEATURES
from pairscope.session import scratch_path
from pairscope.sources.delimited import read_tsv, write_tsv
from pairscope.sources.events import EventTables
from pairscope.sources.partitioned import PartitionedTable, create_database
from pairscope.windows import date_range


def _table(spark):
    db = f"t_{uuid.uuid4().hex[:8]}"
    create_database(spark, db, scratch_path(spark, db))
    return PartitionedTable(spark, f"{db}.features", FEATURES).create()


_rows = sorted_rows


def test_dynamic_overwrite_is_idempotent_and_drop_removes_files(spark):
    t = EventTables(spark, SF0001)
    runs = date_range("20240120", "20240123")
    feats = serving_features(t, runs)
    table = _table(spark).overwrite_partitions(feats)
    before = _rows(table.read())
    table.overwrite_partitions(serving_features(t, "20240122"))     # re-run one day
    assert _rows(table.read()) == before
    counts = {r.dt: r["count"] for r in table.partition_counts(5).collect()}
    assert counts == {r.dt: r["count"] for r in feats.groupBy("dt").count().collect()}
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table.name}").where("col_name = 'Location'").first()[1]
    table.drop_partition("20240120")
    assert "20240120" not in {r.dt for r in table.read().select("dt").distinct().collect()}
    assert not os.path.exists(location.replace("file:", "") + "/dt=20240120")


def test_tsv_roundtrip_keeps_nulls_and_values(spark):
    feats = serving_features(EventTables(spark, SF0001), "20240125")
    path = write_tsv(feats, scratch_path(spark, "tsv"))
    back = read_tsv(spark, path, FEATURES)
    assert _rows(back) == _rows(feats)
    assert back.where(F.col("is_student").isNull()).count() > 0


def test_static_overwrite_with_nothing_empties_that_partition_only(spark):
    feats = serving_features(EventTables(spark, SF0001), date_range("20240120", "20240123"))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", None)
    table = _table(spark).overwrite_partitions(feats)
    before = {r.dt: r["count"] for r in table.partition_counts(9).collect()}
    table.overwrite_partition(spark.createDataFrame([], FEATURES), "20240121")
    assert {r.dt: r["count"] for r in table.partition_counts(9).collect()} == {k: v for k, v in before.items() if k != "20240121"}
    table.overwrite_partition(feats.where("dt = '20240121'"), "20240121")
    assert _rows(table.read()) == _rows(feats)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", None) == mode


def test_dynamic_overwrite_refuses_a_table_it_would_wipe(spark):
    db = f"t_{uuid.uuid4().hex[:8]}"
    create_database(spark, db, scratch_path(spark, db))
    spark.sql(f"CREATE TABLE {db}.plain (username STRING, dt STRING) USING parquet PARTITIONED BY (dt)")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("username", T.StringType()), T.StructField("dt", T.StringType())])
    with pytest.raises(ValueError, match="create"):
        PartitionedTable(spark, f"{db}.plain", schema).overwrite_partitions(spark.createDataFrame([("u", "20240101")], schema))


def _sample(spark, n=5):
    t = EventTables(spark, SF0001)
    return t, pipelines.build_training_split(training_set(t, date_range("20240103", "20240130")), n, 0.5)


def test_first_trees_equal_a_shorter_run(spark):
    t, split = _sample(spark)
    params = model.BoosterParams(min_child_weight=0.1)
    long, short = (model.train(split.sample, params.with_iterations(n)) for n in (5, 2))
    feats = serving_features(t, "20240130")
    assert _rows(model.score(long, feats, trees=2)) == _rows(model.score(short, feats))
    assert _rows(model.score(long, feats, trees=5)) == _rows(model.score(long, feats))
    with pytest.raises(ValueError):
        model.first_trees(long, 6)


def test_model_train_score_save_load(spark):
    t, split = _sample(spark)
    fitted = model.train(split.sample, model.BoosterParams().with_iterations(3))
    feats = serving_features(t, "20240130")
    scored = pipelines.score_features(feats, fitted)
    path = model.save(fitted, scratch_path(spark, "model"))
    again = pipelines.score_features(feats, model.load(path))
    a, b = _rows(scored), _rows(again)
    assert a == b and len(a) == feats.count()
    assert all(0.0 <= r[2] <= 1.0 for r in a)


def test_drop_table(spark):
    table = _table(spark)
    row = ("u1", 1, "D0-A0", 1, 1, 1.0, 0, 0, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 1, 0, None, None, "x")
    table.overwrite_partition(spark.createDataFrame([row], FEATURES).drop("dt"), "20240101")
    assert table.read().count() == 1
    table.drop()
    assert not spark.catalog.tableExists(table.name)
