"""Rolling features of a reading: 62 columns from one exchange and one sort per device."""

from dataclasses import dataclass
from math import pi

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.functions.scalars import epoch_micros, label
from sensorloom.operators.quantiles import DIRECT_ROWS, exact_quantiles
from sensorloom.operators.sequence import CHANGED, HALO, POS, SLICE, Slicing, sliced
from sensorloom.operators.spectral import add_rolling
from sensorloom.schema import SIGNALS
from sensorloom.workspace import materialize

# Default window in rows, assumed cycle in seconds, guard against division
# by zero, and the duration that stands for "never".
WINDOW_ROWS = 30
SEASON_SECONDS = 600
EPSILON = 1e-6
NEVER_SECONDS = 1e9

# Order of the per-signal features.
SIGNAL_FEATURES = ["mean", "std", "min", "max", "trend", "resid", "delta", "zscore", "diff",
                   "fft_energy", "fft_dom_bin"]
EVENT_FEATURES = ["error_streak", "time_since_error_s", "state_change", "state_change_count",
                  "time_since_state_change_s"]


@dataclass(frozen=True)
class FeatureSpec:
    signals: tuple[str, ...] = tuple(SIGNALS)
    window: int = WINDOW_ROWS
    season_s: int = SEASON_SECONDS
    fft_window: int | None = None
    ties: tuple[str, ...] = ()
    slicing: Slicing = Slicing()
    dominant_bins: bool = True

    @property
    def spectral_window(self) -> int:
        return self.fft_window or self.window

    @property
    def min_rows(self) -> int:
        return max(5, self.window // 5)

    @property
    def spectral_min_rows(self) -> int:
        return max(8, self.spectral_window // 3)


def feature_names(spec: FeatureSpec = FeatureSpec()) -> list[str]:
    """Feature columns in matrix order."""
    kinds = [k for k in SIGNAL_FEATURES if spec.dominant_bins or k != "fft_dom_bin"]
    return (["phase_sin", "phase_cos"] + [f"{s}_{k}" for s in spec.signals for k in kinds]
            + EVENT_FEATURES)


def sample_step_seconds(df: DataFrame, per_device: bool = False) -> int:
    """Median gap between consecutive times of the whole table, in whole seconds, at least 1.

    Equal times are counted, not sorted: each repeat is a gap of zero.  Distinct times are sorted in ranges, and the first
    one of a range looks at the end of the range before it, so neither an hour nor a device is one task.
    Gaps are stored once, as counts.  Counts per whole second find the middle ones, which are then ranked exactly within
    that second, which holds at most a million different gaps.
    """
    counts = materialize(_gap_counts(df, ["device_id"] if per_device else []), "gaps")
    seconds = counts.groupBy(F.expr("gap div 1000000").alias("sec")).agg(F.sum("n").alias("n"))
    middle = seconds.selectExpr(
        "sec", "n", "sum(n) OVER (ORDER BY sec) - n AS before", "sum(n) OVER () AS total").where(
        "before <= total div 2 AND before + n > (total - 1) div 2").orderBy("sec").collect()
    if not middle:
        return 1
    total, before = middle[0].total, middle[0].before
    values = (counts.where(F.expr("gap div 1000000").isin([r.sec for r in middle]))
              .selectExpr("gap", f"sum(n) OVER (ORDER BY gap) + {before} AS upto"))
    low, high = values.agg(*[F.min(F.when(F.col("upto") > r, F.col("gap")))
                             for r in ((total - 1) // 2, total // 2)]).first()
    return int(max(1, round((low + high) / 2 / 1e6)))


def _gap_counts(df: DataFrame, who: list[str]) -> DataFrame:
    """Gaps between neighbouring times (of each device, if ``who`` names it) in microseconds, and how often they occur: gap, n."""
    times = (df.where("timestamp IS NOT NULL").groupBy(*who, epoch_micros(F.col("timestamp")).alias("us"))
             .agg(F.count(F.lit(1)).alias("n")))
    # Stored, since two readers must see the same ranges.
    ranges = materialize(times.repartitionByRange(*who, "us").withColumn("part", F.spark_partition_id()), "times")
    # One row per range: few enough for a single ordered pass.
    ends = ranges.groupBy("part").agg(F.max(F.struct(*who, "us")).alias("end"))
    before = ends.select("part", F.lag("end").over(Window.orderBy("part")).alias("end"))
    inside = Window.partitionBy("part", *who).orderBy("us")
    same = F.lit(True)
    for name in who:
        same = same & F.col(f"end.{name}").eqNullSafe(F.col(name))
    own = ranges.withColumn("own", F.lag("us").over(inside)).join(F.broadcast(before), "part")
    gaps = own.select("us", "n", F.coalesce("own", F.when(same, F.col("end.us"))).alias("prev")).selectExpr(
        "inline(array(struct(us - prev AS gap, 1L AS n), struct(0L AS gap, n - 1 AS n)))")
    return gaps.where("gap IS NOT NULL AND n > 0").groupBy("gap").agg(F.sum("n").alias("n"))


# A reading with a non-zero error code; a missing code is no error.
FAILED = "coalesce(error_code <> 0, false)"


def _known(signal: str) -> str:
    """A reading as a double; NaN and infinite readings are missing like null ones."""
    number = f"CAST({signal} AS DOUBLE)"
    return f"CASE WHEN abs({number}) < double('Infinity') THEN {number} END"


def _carries(signals) -> dict[str, Column]:
    return {
        **{f"_carry_{s}": F.expr(_known(s)) for s in signals},
        "_carry_ok_pos": F.expr(f"CASE WHEN NOT {FAILED} THEN {POS} END"),
        "_carry_error_ts": F.expr(f"CASE WHEN {FAILED} THEN timestamp END"),
        "_carry_change_ts": F.expr(f"CASE WHEN {CHANGED} THEN timestamp END"),
    }


def _in_order(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    halo = max(spec.window, spec.spectral_window)
    return sliced(df, spec.ties, halo, _carries(spec.signals), spec.slicing)


def _forward_filled(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    upto = f"OVER ({_window(spec)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    carried = lambda s: f", _carry_{s}" if f"_carry_{s}" in rows.columns else ""
    return rows.selectExpr("*", *[
        f"CAST(coalesce(last({_known(s)}, true) {upto}{carried(s)}, NULL) AS DOUBLE) AS _x_{s}" for s in spec.signals])


def ffill_signals(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Missing, NaN and infinite readings take the last known one of the device."""
    filled = _forward_filled(_in_order(df, spec), spec).where(~F.col(HALO))
    return filled.select(*[F.col(f"_x_{c}").alias(c) if c in spec.signals else F.col(c)
                           for c in df.columns])


def signal_medians(df: DataFrame, spec: FeatureSpec = FeatureSpec(),
                   limit: int = DIRECT_ROWS) -> dict[str, float | None]:
    """Median of each signal over the forward-filled table."""
    slim = df.select(*dict.fromkeys(["device_id", "timestamp", "state", "error_code",
                                     *spec.ties, *spec.signals]))
    quantiles = exact_quantiles(ffill_signals(slim, spec), list(spec.signals), [0.5], limit)
    return {s: q[0] for s, q in quantiles.items()}


def median_fill(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    return df.withColumns({s: F.coalesce(F.col(s).cast("double"), F.lit(m).cast("double"))
                           for s, m in medians.items()})


def _window(spec: FeatureSpec) -> str:
    """SQL text of the one window every device-local feature shares."""
    return f"PARTITION BY device_id, {SLICE} ORDER BY {', '.join(['timestamp', *spec.ties])}"


def _phase(step_s: int, season_s: int) -> list[str]:
    """Position within the season as a point on the circle."""
    bins = max(1, round(season_s / step_s))
    second = "floor(unix_micros(CAST(timestamp AS TIMESTAMP)) / 1000000)"
    at = f"least(floor(pmod({second}, {season_s}) / {step_s}), {bins - 1})"
    angle = f"{2.0 * pi!r}D * ({at} / {bins})"
    return [f"sin({angle}) AS phase_sin", f"cos({angle}) AS phase_cos"]


def _event_columns(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Positions and the last rows that matter, continued across slices."""
    w = _window(spec)
    upto = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    state = "coalesce(state, '')"
    rows = rows.selectExpr(
        f"* EXCEPT ({POS}, {CHANGED})",
        f"CAST(coalesce({POS}, row_number() OVER ({w})) AS BIGINT) AS {POS}",
        f"coalesce({CHANGED}, lag({state}) OVER ({w}) <> {state}, true) AS {CHANGED}",
        f"{FAILED} AS _failed")
    carried = lambda name: f", {name}" if name in rows.columns else ""
    last = lambda when, value, name: (
        f"coalesce(last(CASE WHEN {when} THEN {value} END, true) {upto}{carried('_carry' + name)}, NULL) AS {name}")
    return rows.selectExpr(
        "*", last("NOT _failed", POS, "_ok_pos"), last("_failed", "timestamp", "_error_ts"),
        last(CHANGED, "timestamp", "_change_ts"))


def _event_features(step_s: int, season_s: int) -> dict[str, str]:
    """The features that need no frame, from positions and the last rows that matter."""
    since = lambda mark: (f"greatest(coalesce((unix_micros(CAST(timestamp AS TIMESTAMP)) - "
                          f"unix_micros(CAST({mark} AS TIMESTAMP))) / 1e6D, {NEVER_SECONDS}D), 0D)")
    return dict(reversed(c.rsplit(" AS ", 1)) for c in _phase(step_s, season_s)) | {
        "error_streak": f"{POS} - coalesce(_ok_pos, 0)",
        "time_since_error_s": since("_error_ts"),
        "state_change": f"{CHANGED}",
        "time_since_state_change_s": since("_change_ts")}


def _finite(value: str, name: str) -> str:
    """Missing, NaN and infinite values become 0.0."""
    number = f"CAST({value} AS DOUBLE)"
    return f"CASE WHEN abs({number}) < double('Infinity') THEN {number} ELSE 0D END AS {name}"


def feature_matrix(df: DataFrame, spec: FeatureSpec = FeatureSpec(), keep=(),
                   step_s: int | None = None,
                   medians: dict[str, float | None] | None = None) -> DataFrame:
    """Key, tie-break, kept columns, label ``y`` and the features as doubles.

    The sampling step and the signal medians are statistics of the whole table; pass
    them in to reuse them (a stored table, a later increment) and save their passes.
    """
    step_s = sample_step_seconds(df) if step_s is None else step_s
    medians = signal_medians(df, spec) if medians is None else medians
    carried = list(dict.fromkeys(["device_id", "timestamp", *spec.ties, *keep]))
    used = list(dict.fromkeys([*carried, "state", "error_code", "anomaly_tag", *spec.signals]))

    rows = _forward_filled(_in_order(df.select(*used), spec), spec)
    rows = median_fill(rows, {f"_x_{s}": medians[s] for s in spec.signals})
    events = _event_features(step_s, spec.season_s)
    # Only what frames need goes through the pass over them, and comes back as finished features:
    # one projection of all features would be a method too long to be compiled.
    rows = _event_columns(rows, spec).select(
        *carried, label(F.col("anomaly_tag")).alias("y"), SLICE, HALO, POS, CHANGED,
        *[f"_x_{s}" for s in spec.signals], *[F.expr(_finite(e, n)) for n, e in events.items()])
    return add_rolling(rows, spec, {s: f"_x_{s}" for s in spec.signals}, [SLICE, "timestamp", *spec.ties],
                       [*carried, "y"], feature_names(spec), EPSILON)
