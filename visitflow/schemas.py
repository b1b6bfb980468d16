"""Schemas of the inputs and of the result tables (names are the library's, types are Spark's)."""

from __future__ import annotations

from pyspark.sql import types as T

# One page visit / action.  Ids use 0 for "none"; 0 is also a legal category id.
VISIT_SCHEMA = T.StructType([
    T.StructField("visit_date", T.DateType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("action_time", T.TimestampNTZType()),
    T.StructField("action", T.StringType()),
    T.StructField("pay_category_id", T.LongType()),
    T.StructField("pay_product_id", T.LongType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_id", T.LongType()),
    T.StructField("order_product_id", T.LongType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("page_id", T.LongType()),
])

USER_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("user_sex", T.StringType()),
    T.StructField("user_city", T.LongType()),
    T.StructField("professional", T.StringType()),
    T.StructField("user_age", T.LongType()),
])

BLACKLIST_SCHEMA = T.StructType([T.StructField("user_id", T.LongType())])

# A typed ad click, as parsed from ``province,city,userId,adId,epochMillis``.
CLICK_SCHEMA = T.StructType([
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("click_date", T.DateType()),
])

CLICK_COLUMNS = ["province", "city", "user_id", "ad_id", "ts_ms", "click_date"]

# Result tables and their keys (the key decides what an upsert replaces).  Fixed values: the names
# must equal those of the existing database tables.
TABLE_KEYS = {
    "ad_stat": ["click_date", "province", "city", "ad_id"],
    "ad_user_click_count": ["click_date", "user_id", "ad_id"],
    "ad_province_top3": ["click_date", "province", "ad_id"],
    "ad_province_groups": ["click_date", "province"],
    "ad_daily_count": ["click_date", "province", "ad_id"],
    "ad_click_trend": ["click_date", "ad_id", "window_end"],
    "ad_minute_count": ["click_date", "ad_id", "minute"],
    "ad_blacklist": ["user_id"],
}

# The columns of the detail table, in order.
DETAIL_COLUMNS = [
    "task_id", "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
    "pay_category_ids", "pay_product_ids",
]

# The driver's tables read by the adapters (TESTDATA.md), declared so that a read does not infer
# the schema from parquet footers (about 50 ms per read, per query); scans still read only the
# columns a query uses.
DRIVER_SCHEMAS = {
    "events": T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()),
        T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ]),
    "region": T.StructType([
        T.StructField("r_regionkey", T.IntegerType()),
        T.StructField("r_name", T.StringType()),
    ]),
}
