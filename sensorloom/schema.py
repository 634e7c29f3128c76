"""The telemetry row and the shapes derived from it."""

from pyspark.sql import types as T

# The column order and names of a telemetry row.
TELEMETRY_COLUMNS = [
    "timestamp", "device_id", "state", "rpm", "temp_c",
    "vibration_g", "current_a", "voltage_v", "error_code", "anomaly_tag",
]

# The numeric readings that become features.
SIGNALS = ["rpm", "temp_c", "vibration_g", "current_a", "voltage_v"]

# Columns a stored row must have.
REQUIRED_KEYS = ["timestamp", "device_id", "state"]

ROW_KEY = ["device_id", "timestamp"]

TELEMETRY = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("rpm", T.IntegerType()),
    T.StructField("temp_c", T.DoubleType()),
    T.StructField("vibration_g", T.DoubleType()),
    T.StructField("current_a", T.DoubleType()),
    T.StructField("voltage_v", T.DoubleType()),
    T.StructField("error_code", T.IntegerType()),
    T.StructField("anomaly_tag", T.StringType()),
])

FAMILY_SHARE = T.StructType([
    T.StructField("family", T.StringType()),
    T.StructField("pct", T.DoubleType()),
])

FEATURE_SHARE = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("pct", T.DoubleType()),
])

# One stored alert, with the context block that repeats tag, route and shares.
ALERT = T.StructType([
    T.StructField("alert_id", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("route", T.StringType()),
    T.StructField("queue", T.StringType()),
    T.StructField("rule_id", T.StringType()),
    T.StructField("rule_name", T.StringType()),
    T.StructField("cause", T.StringType()),
    T.StructField("root_cause", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("families", T.ArrayType(FAMILY_SHARE)),
    T.StructField("top_features", T.ArrayType(FEATURE_SHARE)),
    T.StructField("context", T.StructType([
        T.StructField("tag", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("families", T.ArrayType(FAMILY_SHARE)),
        T.StructField("top_features", T.ArrayType(FEATURE_SHARE)),
    ])),
])

AGGREGATE = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("group_key", T.StringType()),
    T.StructField("n_flagged", T.LongType()),
    T.StructField("avg_score", T.DoubleType()),
    T.StructField("p95_score", T.DoubleType()),
    T.StructField("top_families", T.ArrayType(FAMILY_SHARE)),
])
