"""Bursts: at least N flagged readings of one device within M minutes, both ends included.

A device's time line is cut into slices of eight windows.  Each slice also sees the two
windows before it, which is all a reading needs to know its own count and the hit before
it, so slices of the hottest device run in parallel.  Flagged readings with equal device and
time are combined before the shuffle.  Only one row per slice and island travels on to
join islands across slices: at most about one per window of elapsed time, however dense
the readings are.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sensorloom.functions.scalars import epoch_micros
from sensorloom.operators.sequence import hot_devices
from sensorloom.workspace import materialize

LONGEST_CHAIN = 100_000  # bursts of a device that one task may walk
SLICE_WINDOWS = 8
HALO_WINDOWS = 2
MINUTE_US = 60_000_000


def _check(window_minutes: float, min_anomalies: int) -> int:
    if window_minutes <= 0:
        raise ValueError("the window must be longer than zero minutes")
    if min_anomalies < 1:
        raise ValueError("a burst needs at least one anomaly")
    return round(window_minutes * MINUTE_US)


@dataclass(frozen=True)
class BurstRule:
    """When readings are a burst, how it is reported, and for how long its device is quiet afterwards."""
    window_minutes: float = 10
    min_anomalies: int = 3
    min_score: float | None = None
    cooldown_minutes: float = 0
    severity: str = "CRITICAL"
    name: str = "burst"
    message: str = ""


RULE = ["rule", "device_id"]  # a device is searched for each rule


def _anomalies(df: DataFrame, rules: list[BurstRule]) -> DataFrame:
    """Flagged readings of each rule: rule (its place), device, time, how many rows, and the rule's window and least count."""
    rows = df.where("device_id IS NOT NULL AND timestamp IS NOT NULL")
    rows = rows.where(F.col("pred") == 1) if "pred" in rows.columns else rows

    def entry(place: int, rule: BurstRule) -> Column:
        span = _check(rule.window_minutes, rule.min_anomalies)
        one = F.struct(F.lit(place).alias("rule"), F.lit(span).cast("long").alias("span"), F.lit(rule.min_anomalies).alias("least"))
        return one if rule.min_score is None else F.when(F.col("score") >= F.lit(rule.min_score), one)

    # An outer explode: a plain one lets the optimizer test every rule twice.
    entries = F.array_compact(F.array(*[entry(i, r) for i, r in enumerate(rules)]))
    each = rows.select("device_id", "timestamp", F.explode_outer(entries).alias("r")).where("r IS NOT NULL")
    return (each.groupBy(F.col("r.rule").alias("rule"), "device_id", "timestamp", F.col("r.span").alias("span"), F.col("r.least").alias("least"))
            .agg(F.count(F.lit(1)).alias("n")).withColumn("us", epoch_micros(F.col("timestamp"))))


def _hits(df: DataFrame, rules: list[BurstRule]) -> DataFrame:
    """Hits of each rule and slice with count, window start, island start mark and newly covered rows."""
    span = F.col("span")
    length = span * SLICE_WINDOWS
    own = F.floor(F.col("us") / length)
    near_end = F.pmod(F.col("us"), length) >= length - span * HALO_WINDOWS
    rows = (_anomalies(df, rules).withColumn("own", own)
            .withColumn("slice", F.explode(
                F.when(near_end, F.array("own", F.col("own") + 1)).otherwise(F.array("own")))))
    by = Window.partitionBy(*RULE, "slice")
    order = by.orderBy("us")
    # A reading enters its window at its time and leaves it one microsecond after the window's end. Running
    # totals over both kinds of moments cost the same for any length of window.
    moments = rows.withColumn("following", F.lead("timestamp").over(order)).withColumn("moment", F.explode(F.array(
        F.struct(F.col("us").alias("at"), F.col("n").alias("change"), F.lit(True).alias("enters")),
        F.struct((F.col("us") + span + 1).alias("at"), (-F.col("n")).alias("change"), F.lit(False).alias("enters")))))
    so_far = by.orderBy("moment.at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # What follows the last reading that has left is the first one inside.
    left = F.last(F.when(~F.col("moment.enters"), F.col("following")), True).over(so_far)
    rows = moments.select("*", F.sum("moment.change").over(so_far).alias("n_events"),
                          F.coalesce(left, F.min("timestamp").over(so_far)).alias("window_start"))
    rows = rows.where("moment.enters").drop("moment", "following")
    upto, before = (order.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    rows = rows.select("*", F.sum("n").over(upto).alias("seen"))
    hit = F.col("n_events") >= F.col("least")
    rows = rows.select("*", F.last(F.when(hit, F.col("us")), True).over(before).alias("prev_hit"),
                       F.last(F.when(hit, F.col("seen")), True).over(before).alias("prev_seen"))
    starts = F.coalesce(F.col("us") - F.col("prev_hit") > span, F.lit(True))
    covered = F.when(starts, F.col("n_events")).otherwise(F.col("seen") - F.col("prev_seen"))
    return (rows.where(hit & (F.col("slice") == F.col("own")))
            .select(*RULE, "timestamp", "us", "n", "slice", "n_events", "window_start",
                    starts.cast("int").alias("starts"), covered.alias("covered")))


def burst_alerts(df: DataFrame, window_minutes: float = 10, min_anomalies: int = 3,
                 min_score: float | None = None) -> DataFrame:
    """Each time at which the last M minutes of a device hold at least N flagged readings."""
    hits = _hits(df, [BurstRule(window_minutes, min_anomalies, min_score)])
    return hits.select("device_id", "timestamp", F.col("n").alias("n_rows"), "n_events", "window_start")


def burst_dedupe(df: DataFrame, window_minutes: float = 10, min_anomalies: int = 3,
                 min_score: float | None = None, severity: str = "CRITICAL",
                 rule_name: str = "burst") -> DataFrame:
    """One alert per burst: hits no more than a window apart belong together."""
    return burst_sweep(df, [BurstRule(window_minutes, min_anomalies, min_score, severity=severity, name=rule_name)])


def burst_sweep(df: DataFrame, rules: list[BurstRule], longest: int = LONGEST_CHAIN) -> DataFrame:
    """The bursts of all rules, found together: the readings are read and dealt out once for any number of rules."""
    hits = _hits(df, rules)
    inside = (Window.partitionBy(*RULE, "slice").orderBy("us")
              .rowsBetween(Window.unboundedPreceding, 0))
    pieces = (hits.withColumn("piece", F.sum("starts").over(inside))
              .groupBy(*RULE, "slice", "piece")
              .agg(F.min("us").alias("first_us"), F.max("starts").alias("starts"),
                   F.min("window_start").alias("burst_start"), F.max("timestamp").alias("burst_end"),
                   F.sum("covered").alias("covered")))
    along = (Window.partitionBy(*RULE).orderBy("first_us")
             .rowsBetween(Window.unboundedPreceding, 0))
    islands = (pieces.withColumn("island", F.sum("starts").over(along))
               .groupBy(*RULE, "island")
               .agg(F.min("burst_start").alias("burst_start"), F.max("burst_end").alias("burst_end"),
                    F.sum("covered").alias("n_events"))).drop("island")
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule") + 1)
    if any(r.cooldown_minutes > 0 for r in rules):
        quiet = of([round(r.cooldown_minutes * MINUTE_US) for r in rules]).cast("long")
        # Stored: devices are counted before the choice reads them.
        islands = _cooled(materialize(islands.withColumn("_quiet", quiet), "bursts"), RULE, longest).drop("_quiet")
    message = F.format_string("%d anomalies within %s-minute windows", "n_events", of([f"{r.window_minutes:g}" for r in rules]))
    own = of([r.message for r in rules])
    return islands.select("device_id", "burst_start", "burst_end", "n_events", of([r.severity.upper() for r in rules]).alias("severity"),
                          of([r.name for r in rules]).alias("rule_name"), F.when(own != "", own).otherwise(message).alias("message"))


def _following_start(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """For each burst (keys, start, end, quiet) the first start of its device a cooldown after its end: keys, start, to (or null).

    Starts and wanted times are sorted together in ranges, so a device spreads over tasks. A wanted time finds the next start in its
    range; at the end of a range it is the first start of the next range that has one.
    """
    starts = nodes.select(*keys, F.col("start").alias("at"), F.lit(1).alias("kind"), "start")
    # Without a cooldown a burst of no length would find itself.
    wanted = nodes.select(*keys, F.greatest(F.col("end") + F.col("quiet"), F.col("start") + 1).alias("at"), F.lit(0).alias("kind"), "start")
    placed = materialize(starts.unionByName(wanted).repartitionByRange(*keys, "at", "kind").withColumn("part", F.spark_partition_id()), "ranges")
    # Backwards, since Spark reads a frame that ends with the group anew for every row.
    following = (Window.partitionBy("part", *keys).orderBy(F.desc("at"), F.desc("kind"))
                 .rowsBetween(Window.unboundedPreceding, -1))
    inside = placed.select("*", F.last(F.when(F.col("kind") == 1, F.col("at")), True).over(following).alias("next"))
    # One row per range: few enough for a single ordered pass.
    later = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("part").agg(F.min(F.when(F.col("kind") == 1, F.struct(*keys, "at"))).alias("head")).select(
        "part", F.last("head", True).over(later).alias("beyond"))
    same = reduce(and_, [F.col(f"beyond.{k}") == F.col(k) for k in keys])
    return inside.where("kind = 0").join(firsts, "part").select(*keys, "start", F.coalesce("next", F.when(same, F.col("beyond.at"))).alias("to"))


def _kept_by_doubling(bursts: DataFrame, keys: list[str]) -> DataFrame:
    """Kept bursts (keys, start, end) of `bursts` (keys, start, end, quiet): all that are reached from the first one of each device.

    Every round doubles how far pointers lead and how much of each chain is marked, so rounds grow with the logarithm
    of a chain; joins are on (device, start), which spreads a device.
    """
    nodes = materialize(bursts.groupBy(*keys, "start").agg(F.min(F.struct("end", "quiet")).alias("e")).select(*keys, "start", "e.*"), "cooldown")
    ahead = materialize(_following_start(nodes, keys), "cooldown")
    marked = materialize(nodes.groupBy(*keys).agg(F.min("start").alias("start")), "cooldown")
    while True:
        led = ahead.join(marked, [*keys, "start"]).where("to IS NOT NULL").select(*keys, F.col("to").alias("start"))
        more = materialize(led.distinct().join(marked, [*keys, "start"], "left_anti"), "cooldown")
        if more.isEmpty():
            return nodes.join(marked, [*keys, "start"])
        marked = materialize(marked.unionByName(more), "cooldown")
        second = ahead.select(*keys, F.col("start").alias("to"), F.col("to").alias("beyond"))
        ahead = materialize(ahead.where("to IS NOT NULL").join(second, [*keys, "to"], "left").select(
            *keys, "start", F.col("beyond").alias("to")), "cooldown")


def burst_cooldown(bursts: DataFrame, cooldown_minutes: float, longest: int = LONGEST_CHAIN) -> DataFrame:
    """Drop bursts that start within the cooldown of the last burst kept for the device.

    A burst at least a cooldown after its predecessor is always kept, so the sequential
    choice is confined to chains of closer bursts. A device of more than ``longest`` bursts is no task of its own: its
    choice is made by doubling pointers (:func:`_kept_by_doubling`). Of bursts that start together the shortest counts.
    """
    rows = bursts.withColumn("_quiet", F.lit(round(cooldown_minutes * MINUTE_US)).cast("long"))
    return _cooled(rows, ["device_id"], longest).select(*bursts.columns)


def _cooled(rows: DataFrame, keys: list[str], longest: int) -> DataFrame:
    """The bursts that stay, each with a cooldown ``_quiet`` in microseconds that all of its key share."""
    columns = rows.columns
    rows = rows.withColumns({"_start": epoch_micros(F.col("burst_start")), "_end": epoch_micros(F.col("burst_end"))})
    hot = hot_devices(rows, longest)
    if hot is None:
        return _kept_in_chains(rows, keys).select(*columns)
    few = _kept_in_chains(rows.join(hot, "device_id", "left_anti"), keys)
    many = rows.join(hot, "device_id", "left_semi")
    kept = _kept_by_doubling(many.select(*keys, F.col("_start").alias("start"), F.col("_end").alias("end"), F.col("_quiet").alias("quiet")), keys)
    kept = kept.select(*keys, F.col("start").alias("_start"), F.col("end").alias("_end"))
    return few.select(*columns).unionByName(many.join(kept, [*keys, "_start", "_end"], "left_semi").select(*columns))


def _kept_in_chains(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The choice for devices of few bursts, in one pass over rows in order.

    The first burst of a device or chain is always kept, so the pass only remembers the end of the last one kept.
    """
    order = Window.partitionBy(*keys).orderBy("_start", "_end")
    rows = rows.withColumn("_fresh", F.coalesce(F.col("_start") - F.lag("_end").over(order) >= F.col("_quiet"), F.lit(True)))
    rows = rows.withColumn("_fresh", F.col("_fresh") | F.lag(F.col("_start").isNull(), 1, False).over(order))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        until = 0
        for batch in batches:
            kept = []
            for fresh, start, end, quiet in zip(*[batch.column(c).to_pylist() for c in ("_fresh", "_start", "_end", "_quiet")], strict=True):
                take = fresh or start >= until
                if take and start is not None and end is not None:
                    until = end + quiet
                kept.append(take)
            yield batch.filter(pa.array(kept, pa.bool_()))

    # The same order the window left behind: planned as a requirement, removed as redundant.
    return rows.sortWithinPartitions(*keys, "_start", "_end").mapInArrow(keep, schema)
