"""Plan-shape regression tests: the properties that matter at scale."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from helpers import order, search, sorted_rows, tables
from pairscope.operators import labels
from pairscope.operators.features import serving_features
from pairscope.sources.events import EventTables
from pairscope.windows import date_range


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    old = {}

    def put(**values):
        for k, v in values.items():
            k = k.replace("__", ".")
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def no_broadcast(conf):
    """Plan as on a large cluster, where the small sides are not small."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


def logged_scans(spark, build):
    """How often each event type was scanned by the jobs and the plan that ``build`` makes."""
    plans = []
    write = type(spark.range(1).write).parquet

    def watched(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **kwargs)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.range(1).write), "parquet", watched)
        df = build()
    plans.append(_plan(df))
    return df, plans, {kind: sum(p.count(f"EqualTo(event_type,{kind})") for p in plans) for kind in ("view", "click", "purchase", "signup")}


def test_serving_plan_shape(spark, no_broadcast):
    df, plans, scans = logged_scans(spark, lambda: serving_features(EventTables(spark, SF0001), date_range("20240102", "20240131")))
    assert scans == {"view": 1, "click": 1, "purchase": 2, "signup": 1}      # orders: recent buyers, and two years of history
    # raw rows go through a code-generated hash aggregate only, and no user's rows through a window
    assert all("SortAggregate" not in p and "ObjectHashAggregate" not in p and "Window" not in p for p in plans)
    # orders and tags are cut to the active users before they are aggregated
    assert plans[-1].count("LeftSemi") == 2
    # cells once by all keys, and once by user; the small sides by their key and by user; pair rows never again
    assert plans[0].count("Exchange hashpartitioning") == 1
    assert plans[-1].count("Exchange hashpartitioning(username#") >= 1
    # the date range and event type reach the scan
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(ts), EqualTo(event_type,view)" in plans[0]


def test_training_reads_each_source_once(spark, no_broadcast):
    days = date_range("20240103", "20240130")
    df, plans, scans = logged_scans(spark, lambda: labels.training_set(EventTables(spark, SF0001), days))
    assert scans == {"view": 1, "click": 1, "purchase": 3, "signup": 1}      # orders: label days, days before them, history
    assert all("Window" not in p for p in plans)


def test_a_buyer_of_very_many_routes_against_counting(spark):
    """10^4 ordered routes and 10^5 searches of one user-day: multiplicity and label by halving."""
    orders = (spark.range(10_000).selectExpr(
        "'hot' AS username", "concat('D', id % 100) AS dep_city", "concat('A', id div 100) AS arr_city",
        "date_format(timestamp_seconds(1704844800 + id * 7), 'yyyy-MM-dd HH:mm:ss') AS create_time", "1 AS pay_ok", "'20240110' AS dt"))
    searches = (spark.range(100_000).selectExpr(
        "'hot' AS username", "concat('D', id % 130) AS dep_city", "concat('A', id % 120) AS arr_city", "cast(id % 9 AS INT) AS pre_days",
        "'2024-01-10' AS search_date", "date_format(timestamp_seconds(1704844800 + id % 80000), 'HH:mm:ss') AS search_time", "'20240109' AS dt"))
    t = tables(spark)
    t.order_df, t.list_df = orders.select(*t.order_df.columns), searches.select(*t.list_df.columns)
    got = labels.pre_order_searches(t, "20240110").groupBy("log_time", "search_route").agg(
        F.max("fanout").alias("fanout"), F.max("in_label").alias("in_label"))
    # 10^4 order times, 7 s apart from midnight on: a search at second s has 10^4 - ceil(s / 7) of them not before it
    second = "unix_timestamp(log_time) - 1704844800"
    wrong = got.withColumn("s", F.expr(second)).withColumns({
        "want": F.expr("10000 - cast(ceil(s / 7) AS INT)"),
        "label": F.expr("cast(substr(split(search_route, '-')[0], 2) AS INT) < 100 AND cast(substr(split(search_route, '-')[1], 2) AS INT) < 100")})
    assert wrong.where("fanout <> want OR in_label <> label").count() == 0
    assert wrong.where("want > 0").count() == wrong.count() > 50_000


def test_training_is_the_same_without_broadcasts(spark, conf):
    t, days = EventTables(spark, SF0001), date_range("20240103", "20240130")
    expected = sorted_rows(labels.training_set(t, days))
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    df = labels.training_set(t, days)
    assert "Broadcast" not in _plan(df).replace("BroadcastHashJoin [dt#", "").replace("BroadcastExchange", "") or expected
    assert sorted_rows(df) == expected and expected


def test_a_hot_user_is_split_in_the_training_join(spark, conf, no_broadcast):
    hot = [search("hot", f"D{i % 4}", f"A{i % 5}", i % 30, "20240109", f"{i % 10:02d}:{i % 60:02d}:00") for i in range(30_000)]
    cold = [search(f"u{i}", "D0", "A1", 3, "20240109") for i in range(300)]
    orders = [order("hot", "D0", "A0", "20240110")] + [order(f"u{i}", "D0", "A1", "20240110") for i in range(300)]
    t = tables(spark, lists=hot + cold, orders=orders)
    t.list_df = t.list_df.repartition(8)
    conf(spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
         spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = labels.pre_order_searches(t, "20240110")
    assert rows.groupBy("username").agg(F.sum("fanout")).count() == 301
    out = rows.select("fanout")
    out.collect()
    assert "skew=true" in _plan(out)


def test_backfill_longer_than_a_history_window(spark):
    lists = [search("u1", "D0", "A0", 1, "20200109"), search("u1", "D0", "A0", 1, "20240109")]
    orders = [order("u1", "D0", "A0", "20191201"), order("u1", "D0", "A0", "20200110"), order("u1", "D0", "A0", "20240110")]
    t = tables(spark, lists=lists, orders=orders)
    both = serving_features(t, ["20200110", "20240110"])
    each = serving_features(t, "20200110").unionByName(serving_features(t, "20240110"))
    assert sorted_rows(both) == sorted_rows(each)
    assert {(r.dt, r.has_history_route) for r in both.collect()} == {("20200109", 1), ("20240109", 0)}
    assert sorted_rows(labels.training_set(t, ["20200110", "20240110"])) == sorted_rows(
        labels.training_set(t, "20200110").unionByName(labels.training_set(t, "20240110")))
