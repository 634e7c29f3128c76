"""Filters and top-k reads over telemetry and scored rows."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.functions.scalars import label

# Operating states used for training.
PRODUCTION_STATES = ["RUN", "IDLE"]

# Fixed value: how far back the newest device is inspected.
RECENT_MINUTES = 10


def device_window(df: DataFrame, device: str, start, end, limit: int | None = None,
                  ties=()) -> DataFrame:
    """Rows of one device in the half-open span [start, end), oldest first."""
    rows = df.where((F.col("device_id") == device)
                    & (F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
    rows = rows.orderBy("timestamp", *ties)
    return rows if limit is None else rows.limit(limit)


def latest_rows(df: DataFrame, n: int = 10, ties=()) -> DataFrame:
    """The newest rows over the whole fleet."""
    return df.orderBy(F.desc("timestamp"), *ties).limit(n)


def latest_per_device(df: DataFrame, n: int = 10, ties=()) -> DataFrame:
    """The newest rows of every device; ranks above n are dropped before the shuffle."""
    newest = Window.partitionBy("device_id").orderBy(F.desc("timestamp"), *ties)
    return df.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n)


def recent_device_window(df: DataFrame, minutes: int = RECENT_MINUTES, ties=()) -> DataFrame:
    """Rows of the device with the newest row, over the span before that row."""
    newest = (latest_rows(df, 1, ties)
              .select("device_id", F.col("timestamp").alias("_end")))
    span = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    # ``newest`` is one row by construction, so it is always small enough to broadcast.
    return (df.join(F.broadcast(newest), "device_id")
              .where((F.col("timestamp") >= F.col("_end") - span) & (F.col("timestamp") < F.col("_end")))
              .drop("_end"))


def production_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("state").isin(PRODUCTION_STATES))


def normal_rows(df: DataFrame) -> DataFrame:
    """Rows without a fault label; uses ``y`` where the features already carry it."""
    y = F.col("y") if "y" in df.columns else label(F.col("anomaly_tag"))
    return df.where(y == 0)


def flag(df: DataFrame, threshold: float | Column, score: str = "score") -> DataFrame:
    """``pred`` = 1 where the score reaches the threshold; a missing score is not flagged."""
    hit = F.coalesce(F.col(score) >= threshold, F.lit(False))
    return df.withColumn("pred", hit.cast("int"))


def top_anomalies(df: DataFrame, n: int = 20, ties=("device_id", "timestamp"),
                  score: str = "score") -> DataFrame:
    return df.orderBy(F.desc_nulls_last(score), *ties).limit(n)
