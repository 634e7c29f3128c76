"""Row order within a device, cut into slices so that no device is one task.

Every feature of a reading looks back along its device: over a fixed number of rows
(rolling statistics) or to the last row where something held (forward fill, last error,
last state change).  A device with few rows is one slice.  A device with more than
``max_rows`` rows is numbered exactly and cut every ``max_rows`` rows; each slice gets

* a *halo*: the rows just before it, enough for the rolling frames, and
* a *carry*: the last known values before the halo, for the unbounded look-backs.

The numbering is two-level.  Row counts per (device, time bucket) are summed along the
device, and rows are ranked only inside their bucket, so the largest sort group is one
bucket, which the unique (device, timestamp) key bounds by the clock's resolution.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.functions.scalars import epoch_micros
from sensorloom.workspace import BROADCAST_ROWS, materialize

DEVICE = "device_id"
SLICE, HALO, POS, CHANGED = "_slice", "_halo", "_pos", "_changed"


@dataclass(frozen=True)
class Slicing:
    """How large a device may grow before it is cut, and the width of its time buckets."""
    max_rows: int = 2_000_000
    bucket_seconds: int = 60


def hot_devices(df: DataFrame, max_rows: int) -> DataFrame | None:
    """Devices above the limit, or None. At most total rows / max_rows of them exist."""
    counts = df.groupBy(DEVICE).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > max_rows).select(DEVICE)
    found = hot.limit(BROADCAST_ROWS + 1).collect()
    if not found:
        return None
    if len(found) <= BROADCAST_ROWS:
        return F.broadcast(df.sparkSession.createDataFrame(found, hot.schema))
    return materialize(hot, "hot-devices")


def numbered(rows: DataFrame, ties, bucket_seconds: int) -> DataFrame:
    """Exact 1-based position of each row in its device, and whether its state changed."""
    state = F.coalesce(F.col("state"), F.lit(""))
    rows = rows.withColumn(
        "_bucket", F.floor(epoch_micros(F.col("timestamp")) / F.lit(bucket_seconds * 1_000_000)))
    order = F.struct("timestamp", *ties)
    along = Window.partitionBy(DEVICE).orderBy("_bucket")
    buckets = (rows.groupBy(DEVICE, "_bucket")
               .agg(F.count(F.lit(1)).alias("_n"), F.max_by(state, order).alias("_last_state"))
               .select(DEVICE, "_bucket",
                       F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias("_before"),
                       F.lag("_last_state").over(along).alias("_prev_state")))
    inside = Window.partitionBy(DEVICE, "_bucket").orderBy("timestamp", *ties)
    previous = F.coalesce(F.lag(state).over(inside), F.col("_prev_state"))
    return (rows.join(buckets, [DEVICE, "_bucket"])
            .withColumn(POS, F.col("_before") + F.row_number().over(inside))
            .withColumn(CHANGED, F.coalesce(previous != state, F.lit(True)))
            .drop("_bucket", "_before", "_prev_state"))


def sliced(df: DataFrame, ties, halo: int, carries: dict[str, Column],
           slicing: Slicing = Slicing()) -> DataFrame:
    """``df`` with slice, halo mark, position, state change and carried values.

    ``carries`` names expressions over the numbered rows whose last non-null value
    before a slice is attached to it.  For devices below the limit, position, change
    and carries are null and are worked out by the caller's windows.
    """
    if slicing.max_rows < 2 * halo:
        raise ValueError("a slice must hold at least two halos")
    hot = hot_devices(df, slicing.max_rows)
    whole = (df if hot is None else df.join(hot, DEVICE, "left_anti"))
    ranked = None if hot is None else numbered(
        df.join(hot, DEVICE, "left_semi"), ties, slicing.bucket_seconds)
    types = {name: "double" for name in carries} if ranked is None else {
        f.name: f.dataType for f in ranked.select(*[c.alias(n) for n, c in carries.items()]).schema}
    empty = {SLICE: F.lit(0).cast("long"), HALO: F.lit(False), POS: F.lit(None).cast("long"),
             CHANGED: F.lit(None).cast("boolean"),
             **{n: F.lit(None).cast(t) for n, t in types.items()}}
    if ranked is None:
        # The planner drops null carries; keep their own types for the caller's coalesce.
        return whole.withColumns({k: v for k, v in empty.items() if k not in carries})
    size, index = slicing.max_rows, F.col(POS) - 1
    own = F.floor(index / F.lit(size))

    group = F.floor((index + halo) / F.lit(size))
    latest = {n: F.max_by(c, F.when(c.isNotNull(), F.col(POS))) for n, c in carries.items()}
    before = Window.partitionBy(DEVICE).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (ranked.groupBy(DEVICE, group.alias(SLICE))
               .agg(*[c.alias(n) for n, c in latest.items()])
               .select(DEVICE, SLICE, *[F.last(n, True).over(before).alias(n) for n in carries]))

    mine = F.struct(own.alias("slice"), F.lit(False).alias("halo"))
    ahead = F.struct((own + 1).alias("slice"), F.lit(True).alias("halo"))
    near_end = index % size >= size - halo
    copies = F.when(near_end, F.array(mine, ahead)).otherwise(F.array(mine))
    cut = (ranked.withColumn("_copy", F.explode(copies))
           .withColumns({SLICE: F.col("_copy.slice"), HALO: F.col("_copy.halo")}).drop("_copy")
           .join(carried, [DEVICE, SLICE], "left"))
    return whole.withColumns(empty).unionByName(cut)
