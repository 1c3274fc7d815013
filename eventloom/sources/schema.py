"""Declared schemas; `event_date` must be declared, partition inference would make it an int."""

from pyspark.sql import types as T

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
    T.StructField("double_value", T.DoubleType()),
])

EVENT_PARAMS = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", PARAM_VALUE),
]))

EVENTS = T.StructType([
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_params", EVENT_PARAMS),
    T.StructField("event_date", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("gen_product_id", T.LongType()),
    T.StructField("target_text", T.StringType()),
    T.StructField("is_downloaded", T.BooleanType()),
    T.StructField("deleted_at", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
])
