"""Telemetry tables: CSV scan, stored table, and append without duplicates."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sensorloom.functions.scalars import nan_to_null, parse_time
from sensorloom.schema import REQUIRED_KEYS, ROW_KEY, TELEMETRY, TELEMETRY_COLUMNS
from sensorloom.workspace import materialize

DATE = "event_date"


def conform(df: DataFrame) -> DataFrame:
    """Cast to the telemetry schema; NaN readings become null, bad times become null."""
    def column(field):
        source = F.col(field.name)
        if field.name == "timestamp" and isinstance(df.schema["timestamp"].dataType, T.StringType):
            return parse_time(source).alias("timestamp")
        cast = source.try_cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            cast = nan_to_null(cast)
        return cast.alias(field.name)

    return df.select(*[column(f) for f in TELEMETRY])


def read_telemetry_csv(spark: SparkSession, path) -> DataFrame:
    """CSV files with a header; the schema is given, never inferred."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in TELEMETRY_COLUMNS])
    raw = (spark.read.schema(text).option("header", True).option("enforceSchema", False)
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
           .csv(path))
    # An integer column that holds missing values is written as "1700.0".
    whole = [f.name for f in TELEMETRY if isinstance(f.dataType, T.IntegerType)]
    return conform(raw.withColumns({c: nan_to_null(F.col(c).try_cast("double")) for c in whole}))


def load_telemetry(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The ten telemetry columns; with a limit, the earliest rows in time order.

    Without a limit no global sort is run: every consumer orders within its own groups.
    """
    rows = df.select(*TELEMETRY_COLUMNS)
    if limit is None:
        return rows
    return rows.orderBy("timestamp", *[c for c in TELEMETRY_COLUMNS if c != "timestamp"]).limit(limit)


def first_per_key(df: DataFrame) -> DataFrame:
    """One row per (device, time): the smallest; combined before the shuffle, so copies are cheap."""
    rest = [c for c in df.columns if c not in ROW_KEY]
    return (df.groupBy(*ROW_KEY).agg(F.min(F.struct(*rest)).alias("_row"))
              .select(*[F.col(c) if c in ROW_KEY else F.col(f"_row.{c}") for c in df.columns]))


def rows_to_insert(new: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of ``new`` whose key is complete, unique in the batch and absent from ``target``."""
    keyed = new.where(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_KEYS)))
    return first_per_key(keyed).join(target.select(*ROW_KEY), ROW_KEY, "left_anti")


def read_store(spark: SparkSession, target: str) -> DataFrame:
    """The stored table, or an empty one before the first ingest."""
    stored = T.StructType([*TELEMETRY.fields, T.StructField(DATE, T.DateType())])
    try:
        return spark.read.schema(stored).parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stored)


def ingest_telemetry(new: DataFrame, target: str, **parquet: str) -> int:
    """Append the rows not yet stored, by date; returns how many. A second run inserts none.

    Only partitions between the first and last date of the batch are compared. Files of a date are sorted by device and time and carry
    Bloom filters of their devices, so a window of one device reads few row groups.
    """
    spark = new.sparkSession
    batch = conform(new).withColumn(DATE, F.to_date("timestamp"))
    span = batch.agg(F.min(DATE).alias("lo"), F.max(DATE).alias("hi")).first()
    if span.lo is None:
        return 0
    current = read_store(spark, target).where(F.col(DATE).between(F.lit(span.lo), F.lit(span.hi)))
    # Stored first: counting and appending then read the same rows, whatever is retried.
    fresh = materialize(rows_to_insert(batch, current), "ingest")
    inserted = fresh.count()
    if inserted:
        (fresh.hint("rebalance", DATE).sortWithinPartitions(DATE, "device_id", "timestamp").write.mode("append")
         .option("parquet.bloom.filter.enabled#device_id", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
         .options(**parquet).partitionBy(DATE).parquet(target))
    return inserted
