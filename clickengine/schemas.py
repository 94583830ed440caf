"""Fixed record schemas of the click data model (all explicit, no inference)."""

from pyspark.sql import types as T

# Click event: user, url, epoch milliseconds.
EVENT = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# Click table of the SQL examples.
CLICK_TABLE = T.StructType([
    T.StructField("user_name", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("ts", T.LongType()),
])

URL_VIEW_COUNT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("cnt", T.LongType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
])

LOGIN_EVENT = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

ORDER_EVENT = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

ACTION = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("seq", T.LongType()),
])

PATTERN = T.StructType([
    T.StructField("action1", T.StringType()),
    T.StructField("action2", T.StringType()),
    T.StructField("seq", T.LongType()),
])

APP_PAYMENT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts", T.LongType()),
])

THIRD_PARTY_PAYMENT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# Driver tables used by the registered queries (as stored in parquet).
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
