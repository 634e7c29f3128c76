"""Burst detection on a stream: the batch result, emitted once a burst is over."""

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from sensorloom.functions.scalars import epoch_micros
from sensorloom.operators.bursts import MINUTE_US, _check
from sensorloom.streaming.ingest import events_stream
from sensorloom.workspace import fresh_path

OUTPUT = "device_id string, burst_start_us bigint, burst_end_us bigint, n_events bigint"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class BurstTracker(StatefulProcessor):
    """Per device: readings not yet covered by the watermark, the last window, the open burst.

    Readings are taken in time order as the watermark passes them, so arrival order within the
    watermark delay does not matter, and state older than one window is dropped.
    """

    def __init__(self, span_us: int, min_anomalies: int, cooldown_us: int):
        self.span, self.least, self.cooldown = span_us, min_anomalies, cooldown_us

    def init(self, handle):
        self.handle = handle
        self.pending = handle.getListState("pending", "us bigint")
        self.window = handle.getListState("window", "us bigint")
        # start, last hit, readings so far, readings since the hit, end of the last alert
        self.open = handle.getValueState(
            "open", "start bigint, hit bigint, n bigint, after bigint, alerted bigint")

    def _wake(self, us: int):
        self.handle.registerTimer(-(-us // 1000))

    def handleInputRows(self, key, rows, timerValues):
        arrived = [(int(us),) for part in rows for us in part["us"]]
        if arrived:
            self.pending.appendList(arrived)
            self._wake(min(arrived)[0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        until = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(us for (us,) in self.pending.get())
        ready = [us for us in waiting if us <= until]
        later = waiting[len(ready):]
        recent = [us for (us,) in self.window.get()]
        start, hit, n, after, alerted = self.open.get() or (None, None, 0, 0, None)
        found = []

        def close():
            nonlocal start, alerted
            if start is not None and (alerted is None or start - alerted >= self.cooldown):
                found.append((key[0], start, hit, n))
                alerted = hit
            start = None

        head = 0
        for i, us in enumerate(ready):
            recent.append(us)
            after += 1
            if i + 1 < len(ready) and ready[i + 1] == us:
                continue
            while recent[head] < us - self.span:
                head += 1
            count = len(recent) - head
            if count < self.least:
                continue
            if start is not None and us - hit <= self.span:
                n += after
            else:
                close()
                start, n = recent[head], count
            hit, after = us, 0
        if start is not None and hit + self.span <= until:
            close()

        self._store(self.pending, later)
        self._store(self.window, [us for us in recent[head:] if us > until - self.span])
        self.open.update((start, hit, n, after, alerted))
        if later:
            self._wake(later[0])
        elif start is not None:
            self._wake(hit + self.span)
        if found:
            yield pd.DataFrame(found, columns=["device_id", "burst_start_us", "burst_end_us", "n_events"])

    @staticmethod
    def _store(state, values):
        state.clear()
        if values:
            state.put([(v,) for v in values])

    def close(self):
        pass


def stream_bursts(rows: DataFrame, window_minutes: float = 10, min_anomalies: int = 3,
                  min_score: float | None = None, cooldown_minutes: float = 0,
                  delay: str = "10 minutes") -> DataFrame:
    """One row per finished burst of a stream of scored rows (``pred`` set, TIMESTAMP time).

    The session must use the RocksDB state store.
    """
    tracker = BurstTracker(_check(window_minutes, min_anomalies), min_anomalies,
                           round(cooldown_minutes * MINUTE_US))
    timed = rows.withWatermark("timestamp", delay)
    flagged = timed.where((F.col("pred") == 1) & F.col("device_id").isNotNull())
    flagged = flagged if min_score is None else flagged.where(F.col("score") >= F.lit(min_score))
    found = (flagged.select("device_id", "timestamp", epoch_micros(F.col("timestamp")).alias("us"))
             .groupBy("device_id")
             .transformWithStateInPandas(tracker, OUTPUT, outputMode="append", timeMode="eventtime"))
    return found.select("device_id", F.timestamp_micros("burst_start_us").alias("burst_start"),
                        F.timestamp_micros("burst_end_us").alias("burst_end"), "n_events")


def write_bursts(bursts: DataFrame, target: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    return (bursts.writeStream.format("parquet").outputMode("append")
            .option("path", target).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def burst_stream_table(spark: SparkSession, sf_dir: str, cooldown_minutes: float = 0) -> DataFrame:
    """All bursts of the ``events`` stream: a closing marker moves the watermark past the last of them.

    The marker is one reading of a device of its own, ten years after the last one, from a second stream. It must be
    flagged, since Spark filters before it takes the watermark, and is too few for a burst.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = events_stream(spark, sf_dir).withColumn("pred", (F.col("score") >= 0.11).cast("int")).select(
        "device_id", "timestamp", "score", "pred")
    marker = fresh_path(spark, "marker")
    last = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("ts").cast("timestamp").alias("last"))
    end = last.select(F.lit("(end of stream)").alias("device_id"), (F.col("last") + F.expr("INTERVAL 10 YEARS")).alias("timestamp"),
                      F.lit(1.0).alias("score"), F.lit(1).alias("pred"))
    end.write.parquet(marker)
    closed = rows.unionByName(spark.readStream.schema(end.schema).parquet(marker))
    bursts = stream_bursts(closed, window_minutes=72 * 60, min_anomalies=3, cooldown_minutes=cooldown_minutes)
    target = fresh_path(spark, "stream-bursts")
    write_bursts(bursts, target, fresh_path(spark, "stream-check")).awaitTermination()
    return spark.read.schema(bursts.schema).parquet(target)
