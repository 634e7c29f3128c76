"""The provided ``events`` table seen as telemetry, as one SQL text for both engines."""

from pyspark.sql import DataFrame, SparkSession

TELEMETRY_SQL = """
SELECT event_id, ts AS timestamp, concat('DEV-', lpad(cast(user_id AS string), 4, '0')) AS device_id,
  CASE WHEN event_type IN ('view','click','error') THEN 'RUN' WHEN event_type='purchase' THEN 'IDLE' ELSE 'MAINT' END AS state,
  CASE WHEN event_id % 211 = 0 THEN -5 WHEN event_type IN ('view','click','error') THEN 1700 + 2*k WHEN event_type='purchase' THEN 170 + k ELSE 0 END AS rpm,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 223 = 0 THEN 130.0E0 ELSE 50.0E0 + value/10.0E0 END AS temp_c,
  CASE WHEN event_id % 43 = 0 THEN NULL ELSE 0.15E0 + k*0.004E0 END AS vibration_g,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE 4.0E0 + value/40.0E0 END AS current_a,
  CASE WHEN event_id % 227 = 0 THEN 31.0E0 ELSE 23.5E0 + (event_id % 11)*0.1E0 END AS voltage_v,
  CASE WHEN event_type='error' THEN CAST(1 + event_id % 5 AS int) ELSE 0 END AS error_code,
  CASE WHEN value > 120 AND event_id % 4 = 0 THEN 'bearing_wear' WHEN value > 120 AND event_id % 4 = 1 THEN ' overheat_drift '
       WHEN value > 120 AND event_id % 4 = 2 THEN 'power_spike' WHEN value > 120 THEN 'sensor_dropout'
       WHEN event_id % 997 = 0 THEN 'mystery_fault' WHEN event_id % 89 = 0 THEN 'nan' WHEN event_id % 97 = 0 THEN NULL ELSE ' ' END AS anomaly_tag,
  round(value/1000.0E0, 6) AS score
FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM {events}) e
"""


def telemetry_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry rows with a stand-in ``score``; ``event_id`` breaks ties of equal times."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return as_telemetry(events)


def as_telemetry(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(TELEMETRY_SQL.replace("{events}", "{src}"), src=events)
