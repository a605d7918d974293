"""Record schemas of the reference jobs (data model §1.1), as Spark DDL."""

from pyspark.sql import types as T

# UserBehavior: userId, itemId, categoryId, behavior, timestamp (epoch s)
BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

# MarketUserBehavior: userId, behavior, channel, timestamp (epoch ms)
MARKETING = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])

# AdClickEvent: userId, adId, province, city, timestamp (epoch s)
AD_CLICK = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

# LoginEvent: userId, ip, eventType, eventTime (epoch s)
LOGIN = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

# ApacheLogEvent after parsing: ip, userId, eventTime, method, url
ACCESS_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])
