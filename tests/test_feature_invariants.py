
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pairscope.operators.features import serving_features
from pairscope.operators.labels import training_set
from pairscope.sources.events import EventTables
from pairscope.windows import date_range


@pytest.fixture(scope="module", params=["serving", "training"])
def feats(request, spark):
    t = EventTables(spark, SF001)
    if request.param == "serving":
        return serving_features(t, date_range("20240102", "20240131")).withColumnRenamed("dt", "part")
    return training_set(t, date_range("20240103", "20240130")).withColumnRenamed("label_dt", "part")


def test_per_user_sums_and_counts(feats):
    per_user = feats.groupBy("username", "part").agg(
        F.sum("search_route_single_cnt").alias("list_sum"), F.max("search_route_cnt").alias("list_total"),
        F.min("search_route_cnt").alias("list_total_min"),
        F.sum("ota_route_single_cnt").alias("ota_sum"), F.max("ota_route_cnt").alias("ota_total"),
        F.sum("search_rate").alias("rate_sum"), F.sum("ota_rate").alias("ota_rate_sum"),
        F.count(F.lit(1)).alias("rows"), F.max("route_cnt").alias("route_cnt"),
        F.min("route_cnt").alias("route_cnt_min"))
    bad = per_user.where(
        (F.col("list_sum") != F.col("list_total")) | (F.col("list_total") != F.col("list_total_min"))
        | (F.col("ota_sum") != F.col("ota_total"))
        | ((F.col("list_total") > 0) & (F.abs(F.col("rate_sum") - 1) > 1e-9))
        | ((F.col("ota_total") > 0) & (F.abs(F.col("ota_rate_sum") - 1) > 1e-9))
        | (F.col("rows") != F.col("route_cnt")) | (F.col("route_cnt") != F.col("route_cnt_min")))
    assert per_user.count() > 0
    assert bad.count() == 0


def test_one_row_per_user_route_and_partition(feats):
    assert feats.count() == feats.select("username", "search_route", "part").distinct().count()
