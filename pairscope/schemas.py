"""Schemas of the source, feature, training and result tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()

SEARCH_LOG = T.StructType([
    T.StructField("username", S),
    T.StructField("dep_city", S),
    T.StructField("arr_city", S),
    T.StructField("pre_days", I),
    T.StructField("search_date", S),   # yyyy-MM-dd
    T.StructField("search_time", S),   # HH:mm:ss
    T.StructField("dt", S),            # partition, yyyyMMdd
])

ORDERS = T.StructType([
    T.StructField("username", S),
    T.StructField("dep_city", S),
    T.StructField("arr_city", S),
    T.StructField("create_time", S),   # yyyy-MM-dd HH:mm:ss
    T.StructField("pay_ok", I),
    T.StructField("dt", S),
])

USER_TAGS = T.StructType([
    T.StructField("key", S),
    T.StructField("tag", S),
])

# Tag flags per user, a snapshot per day.
TAG_FLAGS = T.StructType([
    T.StructField("username", S),
    T.StructField("is_trader", I),
    T.StructField("is_student", I),
    T.StructField("dt", S),
])

# Feature row, in table order (partition column last).
FEATURES = T.StructType([
    T.StructField("username", S),
    T.StructField("route_cnt", I),
    T.StructField("search_route", S),
    T.StructField("search_route_cnt", I),
    T.StructField("search_route_single_cnt", I),
    T.StructField("search_rate", D),
    T.StructField("ota_route_cnt", I),
    T.StructField("ota_route_single_cnt", I),
    T.StructField("ota_rate", D),
    T.StructField("search_pre_days_max", D),
    T.StructField("search_pre_days_min", D),
    T.StructField("search_pre_days_avg", D),
    T.StructField("ota_pre_days_max", D),
    T.StructField("ota_pre_days_min", D),
    T.StructField("ota_pre_days_avg", D),
    T.StructField("dep_city_cnt", I),
    T.StructField("arr_city_cnt", I),
    T.StructField("has_history_route", I),
    T.StructField("is_student", I),
    T.StructField("is_trader", I),
    T.StructField("dt", S),
])

FEATURE_COLUMNS = [f.name for f in FEATURES.fields]
ID_COLUMNS = ["username", "search_route"]
# The 18 model inputs: everything but ids and the partition.
MODEL_INPUTS = [c for c in FEATURE_COLUMNS if c not in ID_COLUMNS + ["dt"]]

# Training row: features without dt, plus label; label_dt names the label day
# (one training set may pool several label days).
TRAINING_COLUMNS = [c for c in FEATURE_COLUMNS if c != "dt"] + ["label", "label_dt"]

# Scored pairs / published result table.
SCORES = T.StructType([
    T.StructField("username", S),
    T.StructField("search_route", S),
    T.StructField("q_ratio", D),
    T.StructField("dt", S),
])
