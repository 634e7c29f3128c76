"""Continuous append of telemetry files, each (device, time) once."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.schema import TELEMETRY_COLUMNS
from sensorloom.sources.events_view import TELEMETRY_SQL
from sensorloom.sources.telemetry import ingest_telemetry, read_store
from sensorloom.workspace import fresh_path


def stream_ingest(rows: DataFrame, target: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Append the rows of a stream to the telemetry store, however late they come.

    Every micro-batch takes the way of a batch ingest: keys already stored are left out, so the
    stream keeps no state, a repeated batch adds nothing, and batch and stream share one store.
    """
    return (rows.writeStream.foreachBatch(lambda batch, _: ingest_telemetry(batch, target))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provided ``events`` file as a stream of telemetry rows with a score."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    view = spark.sql(TELEMETRY_SQL.replace("{events}", "{src}"), src=events)
    return view.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def ingest_stream_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the stream over the available files and return what was stored."""
    target = fresh_path(spark, "stream-store")
    rows = events_stream(spark, sf_dir).select(*TELEMETRY_COLUMNS)
    stream_ingest(rows, target, fresh_path(spark, "stream-check")).awaitTermination()
    return read_store(spark, target).select(*TELEMETRY_COLUMNS)
