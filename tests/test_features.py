import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import at
from sensorloom.operators.features import (
    FeatureSpec, feature_matrix, feature_names, ffill_signals, sample_step_seconds, signal_medians)
from sensorloom.operators.sequence import Slicing
from sensorloom.operators.spectral import rolling_dominant_bin
from sensorloom.schema import SIGNALS

SPEC = FeatureSpec(ties=("row_id",))


def random_rows(n=150, devices=3, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        gap = lambda v: None if rng.random() < 0.15 else v
        rows.append(dict(
            timestamp=at(float(rng.integers(0, 4000)) / 7), device_id=f"DEV-{rng.integers(devices)}",
            state=rng.choice(["RUN", "RUN", "IDLE", "MAINT"]).item(), rpm=gap(int(rng.integers(0, 2000))),
            temp_c=gap(float(rng.normal(60, 5))), vibration_g=gap(float(rng.random())),
            current_a=float(rng.normal(4, 1)), voltage_v=24.0, error_code=int(rng.random() < 0.4) * 3,
            anomaly_tag=rng.choice([" ", "power_spike", "nan"]).item()))
    return rows


def brute(frame: pd.DataFrame, window=30, fft_window=30, season=600):
    """Row by row, straight from the definitions."""
    frame = frame.sort_values(["device_id", "timestamp", "row_id"]).reset_index(drop=True)
    for s in SIGNALS:
        frame[s] = frame[s].astype(float)
        frame[s] = frame.groupby("device_id")[s].ffill()
        frame[s] = frame[s].fillna(frame[s].median())
    us = frame["timestamp"].astype("datetime64[us]").astype("int64").to_numpy()
    step = max(1, round(float(np.median(np.diff(np.sort(us)))) / 1e6))
    bins = max(1, round(season / step))
    minp, fft_minp = max(5, window // 5), max(8, fft_window // 3)
    out = []
    for _, g in frame.groupby("device_id", sort=False):
        streak, error_at, change_at, changes = 0, None, None, []
        for j in range(len(g)):
            row, t = g.iloc[j], us[g.index[j]]
            f = {"row_id": row["row_id"]}
            angle = 2 * np.pi * min((t // 1_000_000 % season) // step, bins - 1) / bins
            f["phase_sin"], f["phase_cos"] = np.sin(angle), np.cos(angle)
            for s in SIGNALS:
                x = g[s].to_numpy()
                w, z = x[max(0, j - window + 1):j + 1], x[max(0, j - fft_window + 1):j + 1]
                f.update({f"{s}_{k}": 0.0 for k in ("mean", "std", "min", "max", "trend", "resid", "delta", "zscore")})
                if len(w) >= minp:
                    std = 0.0 if w.min() == w.max() else w.std(ddof=1)
                    f.update({f"{s}_mean": w.mean(), f"{s}_std": std, f"{s}_min": w.min(), f"{s}_max": w.max(),
                              f"{s}_trend": w.mean(), f"{s}_resid": x[j] - w.mean(), f"{s}_delta": x[j] - w.mean(),
                              f"{s}_zscore": (x[j] - w.mean()) / (std + 1e-6)})
                f[f"{s}_diff"] = x[j] - x[j - 1] if j else 0.0
                f[f"{s}_fft_energy"] = f[f"{s}_fft_dom_bin"] = 0.0
                if len(z) >= fft_minp:
                    mag = np.abs(np.fft.rfft(z - z.mean()))
                    f[f"{s}_fft_energy"] = (mag ** 2).sum()
                    f[f"{s}_fft_dom_bin"] = 1.0 if z.min() == z.max() else float(np.argmax(mag[1:]) + 1)
            streak = streak + 1 if row["error_code"] else 0
            error_at = t if row["error_code"] else error_at
            changed = j == 0 or row["state"] != g.iloc[j - 1]["state"]
            changes.append(changed)
            change_at = t if changed else change_at
            f["error_streak"] = streak
            f["time_since_error_s"] = 1e9 if error_at is None else (t - error_at) / 1e6
            f["state_change"] = float(changed)
            recent = changes[-window:]
            f["state_change_count"] = float(sum(recent)) if len(recent) >= minp else 0.0
            f["time_since_state_change_s"] = (t - change_at) / 1e6
            out.append(f)
    return pd.DataFrame(out).sort_values("row_id").reset_index(drop=True)


def collected(df, names):
    out = df.select("row_id", *names).toPandas()
    return out.sort_values("row_id").reset_index(drop=True)


def agree(actual, expected, names):
    for n in names:
        np.testing.assert_allclose(actual[n], expected[n], rtol=1e-9, atol=1e-6, err_msg=n)


@pytest.mark.parametrize("window,fft_window", [(30, None), (12, 20), (25, 9)])
def test_matrix_equals_brute_force(spark, telemetry, window, fft_window):
    df = telemetry(random_rows())
    spec = FeatureSpec(ties=("row_id",), window=window, fft_window=fft_window)
    expected = brute(df.toPandas(), window, fft_window or window)
    actual = collected(feature_matrix(df, spec), feature_names(spec))
    assert len(actual) == 150
    agree(actual, expected, feature_names(spec))


@pytest.mark.parametrize("max_rows,bucket", [(60, 60), (64, 3600), (61, 1)])
def test_slices_do_not_change_the_result(spark, telemetry, max_rows, bucket):
    """A device above the limit is cut; halo and carry make the cut invisible."""
    rows = random_rows(400, devices=1, seed=8) + random_rows(30, devices=2, seed=9)
    for r in rows[:150]:
        r["temp_c"] = None  # a gap longer than a slice
        r["error_code"] = 0
    df = telemetry(rows)
    cut = FeatureSpec(ties=("row_id",), slicing=Slicing(max_rows, bucket))
    names = feature_names(SPEC)
    agree(collected(feature_matrix(df, cut), names), collected(feature_matrix(df, SPEC), names), names)
    assert signal_medians(df, cut) == signal_medians(df, SPEC)


def test_slice_must_hold_two_halos(telemetry):
    with pytest.raises(ValueError):
        ffill_signals(telemetry([{}]), FeatureSpec(slicing=Slicing(max_rows=59)))


@pytest.mark.parametrize("n", [0, 1, 5, 6, 9, 10])
def test_short_devices(spark, telemetry, n):
    df = telemetry([dict(temp_c=50.0 + i) for i in range(n)])
    rows = collected(feature_matrix(df, SPEC), feature_names(SPEC))
    assert len(rows) == n
    if n:
        assert (rows["temp_c_mean"].iloc[:5] == 0).all()
        assert (rows["temp_c_fft_energy"].iloc[:9] == 0).all() and (rows["temp_c_fft_dom_bin"].iloc[:9] == 0).all()
        assert rows["temp_c_diff"].iloc[0] == 0 and rows["state_change"].iloc[0] == 1
    if n >= 6:
        assert rows["temp_c_mean"].iloc[5] == pytest.approx(52.5)
    if n == 10:
        assert rows["temp_c_fft_energy"].iloc[9] > 0


def test_signal_that_is_never_known_is_zero(spark, telemetry):
    df = telemetry([dict(vibration_g=None) for _ in range(12)])
    rows = collected(feature_matrix(df, SPEC), feature_names(SPEC))
    assert (rows[[c for c in rows if c.startswith("vibration_g")]] == 0).all().all()


def test_infinite_readings_become_zero_features(spark, telemetry):
    rows = [dict(current_a=float("inf") if i == 3 else 4.0) for i in range(12)]
    out = collected(feature_matrix(telemetry(rows), SPEC), feature_names(SPEC))
    assert np.isfinite(out.to_numpy(dtype=float)).all()


def test_constant_far_from_zero_has_no_spread(spark, telemetry):
    rows = [dict(voltage_v=230.1 + 1e-9 * (i == 0), rpm=None, device_id="A") for i in range(40)]
    out = collected(feature_matrix(telemetry(rows), SPEC), feature_names(SPEC))
    assert out["voltage_v_std"].iloc[35] == 0.0 and out["voltage_v_zscore"].iloc[35] == pytest.approx(0, abs=1e-6)


def test_step_counts_repeated_times_as_zero(spark, telemetry):
    together = [dict(timestamp=at(i), device_id=d) for i in range(5) for d in "ABC"]
    df = telemetry(together)
    assert sample_step_seconds(df) == 1
    assert sample_step_seconds(df, per_device=True) == 60
    assert sample_step_seconds(telemetry([{}])) == 1
    # Half-way cases round to even, as do the middle two of an even count.
    assert sample_step_seconds(telemetry([dict(timestamp=at(m)) for m in (0, 2.5 / 60)])) == 2
    assert sample_step_seconds(telemetry([dict(timestamp=at(m)) for m in (0, 2, 5)])) == 150


@pytest.mark.parametrize("per_device", [False, True])
def test_step_over_several_ranges_equals_plain(spark, telemetry, per_device):
    rng = np.random.default_rng(7)
    rows = [(d, int(m)) for d in "AB" for m in rng.integers(0, 90_000, 900)] + [("C", 5)]
    df = telemetry([dict(device_id=d, timestamp=at(m / 60)) for d, m in rows]).repartition(6)
    gaps = []
    for d in "ABC" if per_device else [None]:
        times = sorted(m for who, m in rows if d in (None, who))
        gaps += [b - a for a, b in zip(times, times[1:])]
    assert sample_step_seconds(df, per_device) == max(1, round(np.median(gaps)))


def test_ffill_stays_within_the_device(spark, telemetry):
    df = telemetry([dict(device_id="A", temp_c=1.0), dict(device_id="B", temp_c=None), dict(device_id="A", temp_c=None)])
    found = {r.row_id: r.temp_c for r in ffill_signals(df, SPEC).collect()}
    assert found == {0: 1.0, 1: None, 2: 1.0}


def test_dominant_bin_matches_the_transform():
    rng = np.random.default_rng(0)
    x = rng.normal(size=200).cumsum()
    ends, lengths = np.arange(200), np.minimum(np.arange(200) + 1, 24)
    lengths[:8] = 0
    got = rolling_dominant_bin(x, ends, lengths)
    for i, n in zip(ends, lengths):
        want = 0 if n == 0 else np.argmax(np.abs(np.fft.rfft(x[i - n + 1:i + 1] - x[i - n + 1:i + 1].mean()))[1:]) + 1
        assert got[i] == want


def test_dominant_bin_ties_go_to_the_lowest():
    spike = np.zeros(30)
    spike[7] = 1.0
    ends, lengths = np.array([29]), np.array([30])
    assert rolling_dominant_bin(spike, ends, lengths)[0] == 1
    assert rolling_dominant_bin(np.full(30, 0.15), ends, lengths)[0] == 1
    assert rolling_dominant_bin(np.full(30, np.nan), ends, lengths)[0] == 0


def test_bins_cross_arrow_batches(spark, telemetry):
    df = telemetry(random_rows(300, devices=2, seed=3))
    whole = collected(feature_matrix(df, SPEC), feature_names(SPEC))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        small = collected(feature_matrix(df, SPEC), feature_names(SPEC))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    agree(small, whole, feature_names(SPEC))


def test_one_exchange_and_one_sort_per_matrix(spark, telemetry):
    df = telemetry(random_rows())
    plan = feature_matrix(df, SPEC, step_s=60, medians={s: 0.0 for s in SIGNALS})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_frames_are_not_aggregated_row_by_row(spark, telemetry):
    """No sliding frame is left to the window operator, and finished features pass through no projection of their own."""
    plan = feature_matrix(telemetry(random_rows(20)), SPEC, step_s=60, medians={s: 0.0 for s in SIGNALS})._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "-29" not in text and "var_pop" not in text
    assert plan.optimizedPlan().nodeName() == "MapInArrow"
