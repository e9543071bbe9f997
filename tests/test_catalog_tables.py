"""The production source path: dt-partitioned catalog tables."""

import uuid

from conftest import SF0001
from helpers import sorted_rows
from pairscope.operators.features import serving_features
from pairscope.operators.labels import training_set
from pairscope.session import scratch_path
from pairscope.sources.events import EventTables
from pairscope.sources.partitioned import create_database
from pairscope.sources.tables import CatalogTables
from pairscope.windows import date_range


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_catalog_tables_equal_event_tables_and_prune_partitions(spark):
    ev = EventTables(spark, SF0001)
    db = f"src_{uuid.uuid4().hex[:8]}"
    create_database(spark, db, scratch_path(spark, db))
    for name, df in (("list_log", ev.list_log(None, None)), ("ota_log", ev.ota_log(None, None)),
                     ("orders", ev.orders(None, None))):
        df.write.partitionBy("dt").saveAsTable(f"{db}.{name}")
    ev.user_tags().write.saveAsTable(f"{db}.user_tags")
    cat = CatalogTables(spark, f"{db}.list_log", f"{db}.ota_log", f"{db}.orders", f"{db}.user_tags")

    runs = date_range("20240110", "20240131")
    served = serving_features(cat, runs)
    assert sorted_rows(served) == sorted_rows(serving_features(ev, runs))
    labels = date_range("20240103", "20240130")
    assert sorted_rows(training_set(cat, labels)) == sorted_rows(training_set(ev, labels))

    plan = _plan(serving_features(cat, "20240130"))
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "dt#" in plan and "20240128" in plan
