"""Features of a signal over rolling windows: moments, extremes, energy and dominant frequency bin.

A sliding frame of a Spark window is aggregated anew, row by row, for every row.  Here the frames of
a batch are rows of one array.  The pass runs on partitions that the feature
windows have already grouped and sorted, streams Arrow batches and remembers only the last
window of rows between batches, so its memory does not depend on the size of a device.
"""

import functools

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, types as T

from sensorloom.operators.sequence import CHANGED, DEVICE, HALO, POS

# Relative difference of power below which two bins count as equally strong.
TIE = 1e-9


@functools.cache
def _waves(n: int) -> np.ndarray:
    """Cosines and sines of bins 1 .. n // 2 over n rows, side by side."""
    angle = 2.0 * np.pi * np.outer(np.arange(n), np.arange(1, n // 2 + 1)) / n
    return np.hstack([np.cos(angle), np.sin(angle)])


def _dominant(frames: np.ndarray) -> np.ndarray:
    """Strongest bin above 0 for each row of equally long frames.

    Strengths equal up to rounding are ties and go to the lowest bin; so does a frame
    that does not vary at all.
    """
    n = frames.shape[1]
    parts = (frames - frames.mean(axis=1, keepdims=True)) @ _waves(n)
    power = parts[:, :n // 2] ** 2 + parts[:, n // 2:] ** 2
    flat = frames.max(axis=1) == frames.min(axis=1)
    best = np.argmax(power >= power.max(axis=1, keepdims=True) * (1.0 - TIE), axis=1) + 1.0
    return np.where(flat, 1.0, best)


def rolling_dominant_bin(values: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bin of the frame ending at each of ``ends`` with the given length; 0 where length is 0."""
    out = np.zeros(len(ends))
    for n in np.unique(lengths[lengths > 1]):
        rows = np.flatnonzero(lengths == n)
        frames = sliding_window_view(values, n)[ends[rows] - n + 1]
        known = ~np.isnan(frames).any(axis=1)
        out[rows[known]] = _dominant(frames[known])
    return out


def _spread(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Mean, population variance, minimum and maximum along the last axis.

    Each frame is centred on itself, so no reading outside it, however large, touches the result. Missing values are left out.
    """
    known = ~np.isnan(x)
    if known.all():
        mean, low, high = x.mean(axis=-1), x.min(axis=-1), x.max(axis=-1)
        var = ((x - mean[..., None]) ** 2).mean(axis=-1)
    else:
        n = known.sum(axis=-1)
        some = np.where(n > 0, n, np.nan)
        mean = np.where(known, x, 0.0).sum(axis=-1) / some
        var = (np.where(known, x - mean[..., None], 0.0) ** 2).sum(axis=-1) / some
        low, high = (np.where(n > 0, f(np.where(known, x, edge), axis=-1), np.nan) for f, edge in ((np.min, np.inf), (np.max, -np.inf)))
    flat = low == high
    return np.where(flat, low, mean), np.where(flat, 0.0, var), low, high


def rolling_frames(values: np.ndarray, first: int, pos: np.ndarray, spec) -> dict[str, np.ndarray]:
    """Statistics of the frames that end at each row from ``first`` on: kind -> array (signals, rows).

    values: (signals, rows), those before ``first`` being the tail of the rows before; pos: place of a row in its device, 0 to skip it.
    """
    wave, rows = spec.spectral_window, len(pos)
    kinds = ["avg", "var", "min", "max", "swing", *(["wave_var"] if wave != spec.window else [])]
    out = {k: np.full((len(values), rows), np.nan) for k in kinds}
    at = np.arange(rows) + first
    for window, kinds in ((spec.window, ("avg", "var", "min", "max")), (wave, ("swing", "wave_var"))):
        lengths = np.minimum(pos, window)
        for n in np.unique(lengths[lengths > 0]):
            here = np.flatnonzero(lengths == n)
            frames = sliding_window_view(values, n, axis=1)[:, at[here] - n + 1]
            if "avg" in kinds:
                for kind, found in zip(kinds, _spread(frames), strict=True):
                    out[kind][:, here] = found
                continue
            # Signs go by the place in the device: even places count up.
            signs = np.where(np.arange(n - 1, -1, -1) % 2 == 0, 1.0, -1.0)
            known = ~np.isnan(frames)
            swing = np.where(known, frames, 0.0) @ signs
            out["swing"][:, here] = np.where(known.any(axis=2), np.where(pos[here] % 2 == 0, swing, -swing), np.nan)
            if "wave_var" in out:
                out["wave_var"][:, here] = _spread(frames)[1]
    return out


def _signal_features(x: np.ndarray, prev: np.ndarray, found: dict[str, np.ndarray], pos: np.ndarray, spec, epsilon: float) -> dict[str, np.ndarray]:
    """Features per kind, each (signals, rows), from the readings, the ones before and the statistics of their frames."""
    enough, enough_wave = pos >= spec.min_rows, pos >= spec.spectral_min_rows
    n, m = (np.minimum(pos, w).astype(float) for w in (spec.window, spec.spectral_window))
    mean = np.where(enough, found["avg"], np.nan)
    spread = np.sqrt(found["var"] * n / np.maximum(n - 1.0, 1.0))
    std = np.where(enough, np.where(found["min"] == found["max"], 0.0, spread), np.nan)
    gap = x - mean
    # Energy without a transform: Parseval over the half spectrum needs only the
    # variance and, for an even number of rows, the alternating sum.
    power = m * m * found.get("wave_var", found["var"])
    swing = np.where(m % 2 == 0, found["swing"] ** 2, 0.0)
    return {"mean": mean, "std": std, "min": np.where(enough, found["min"], np.nan), "max": np.where(enough, found["max"], np.nan),
            "trend": mean, "resid": gap, "delta": gap, "zscore": gap / (std + epsilon), "diff": x - prev,
            "fft_energy": np.where(enough_wave, (power + swing) / 2.0, np.nan)}


def add_rolling(df: DataFrame, spec, inputs: dict[str, str], order: list[str], keep: list[str], names: list[str], epsilon: float) -> DataFrame:
    """``keep`` and the features ``names``, those of signals and ``state_change_count`` from rolling frames, others taken from ``df``.

    Rows must be partitioned by device and slice; those of a halo go. What is missing or infinite becomes 0.0.
    """
    longest, sources, signals = max(spec.spectral_window, spec.window), list(inputs.values()), list(inputs)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, T.DoubleType()) for n in names])

    def run(batches):
        tail, turns = np.empty((len(sources), 0)), np.empty(0)
        for batch in batches:
            halo = batch.column(HALO).to_numpy(zero_copy_only=False)
            pos = np.where(halo, 0, batch.column(POS).to_numpy())
            fresh = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in sources])
            values, first = np.concatenate([tail, fresh], axis=1), tail.shape[1]
            ends = np.arange(first, values.shape[1])
            changed = np.concatenate([turns, batch.column(CHANGED).to_numpy(zero_copy_only=False).astype(float)])
            upto = np.concatenate([[0.0], np.cumsum(changed)])
            own = {"state_change_count": np.where(pos >= spec.min_rows, upto[ends + 1] - upto[ends + 1 - np.minimum(pos, spec.window)], 0.0)}
            with np.errstate(all="ignore"):
                prev = np.where(pos > 1, values[:, np.maximum(ends - 1, 0)], np.nan)
                kinds = _signal_features(fresh, prev, rolling_frames(values, first, pos, spec), pos, spec, epsilon)
                own |= {f"{s}_{k}": np.where(np.isfinite(v[i]), v[i], 0.0) for k, v in kinds.items() for i, s in enumerate(signals)}
                if spec.dominant_bins:
                    lengths = np.where(pos < spec.spectral_min_rows, 0, np.minimum(pos, spec.spectral_window))
                    own |= {f"{s}_fft_dom_bin": rolling_dominant_bin(v, ends, lengths) for s, v in zip(signals, values, strict=True)}
            tail, turns = values[:, -(longest - 1):], changed[-(longest - 1):]
            out = pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(own[n]) if n in own else batch.column(n) for n in names]],
                                             names=[*keep, *names])
            yield out.filter(pa.array(~halo)) if halo.any() else out

    # The same order the windows left behind: planned as a requirement, removed as redundant.
    return df.sortWithinPartitions(DEVICE, *order).mapInArrow(run, schema)
