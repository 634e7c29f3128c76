import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import at
from sensorloom.functions.families import sensor_family
from sensorloom.functions.scalars import normalize_tag
from sensorloom.operators import evaluate as E, explain as X, lookup as L, metrics as M, quality as Q, summarize as G


def test_empty_table(telemetry):
    df = telemetry([{}]).limit(0)
    assert M.row_count(df).first().rows == 0 and M.anomaly_rate(df).first().anomaly_rate == 0.0
    assert M.error_code_rate(df).first().error_rate == 0.0 and tuple(M.time_bounds(df).first()) == (None, None)
    assert M.rows_per_device(df).count() == 0 and E.per_tag_recall(L.flag(df.withColumn("score", F.lit(0.1)), 0)).count() == 0
    report = M.ops_metrics(df).first()
    assert (report.row_count, report.anomaly_rate, report.error_rate, report.by_tag) == (0, 0.0, 0.0, [])


def test_tags(spark):
    tags = [None, "", " ", "nan", " NULL ", "null", "None", "none", " wear "]
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    got = [r[0] for r in df.select(normalize_tag(F.col("t"))).collect()]
    assert got == [""] * 7 + ["none", "wear"]


def test_rates_and_ops(telemetry):
    df = telemetry([dict(anomaly_tag=t, error_code=c, device_id=d) for t, c, d in [
        ("wear", 2, "A"), (" wear", 0, "A"), (" ", None, "B"), ("spike", 5, "A")]])
    assert M.anomaly_rate(df).first().anomaly_rate == 0.75 and M.error_code_rate(df).first().error_rate == 0.5
    report = M.ops_metrics(df).first()
    assert report.row_count == 4 and report.anomaly_rate == 0.75 and report.error_rate == 0.5
    assert [tuple(x) for x in report.by_tag] == [("wear", 2), ("spike", 1)]
    assert [tuple(x) for x in report.by_code] == [(2, 1), (5, 1)]
    assert [tuple(x) for x in report.rows_per_device] == [("A", 3), ("B", 1)]
    assert (report.min_ts, report.max_ts) == (at(0), at(3))


def test_ranges_ignore_missing_and_nan(telemetry):
    df = telemetry([dict(temp_c=t, voltage_v=v, rpm=r) for t, v, r in [
        (float("nan"), None, None), (120.0, 30.0, 0), (120.1, 19.9, -1), (-20.5, 31.0, -2)]])
    assert tuple(Q.range_checks(df).first()) == (2, 2, 2)
    rates = {r.column: r.missing_rate for r in Q.missing_rates(df).collect()}
    assert rates["temp_c"] == 0.25 and rates["rpm"] == 0.25 and rates["state"] == 0.0


def test_report_names_missing_columns(telemetry):
    report = Q.validation_report(telemetry([{}]).drop("rpm", "state")).first()
    assert not report.schema_valid and report.missing_columns == ["state", "rpm"] and report.range_checks is None


def test_windows_and_latest(telemetry):
    df = telemetry([dict(device_id=d, timestamp=at(m)) for d, m in [("A", 0), ("A", 9), ("A", 10), ("B", 4), ("A", 20)]])
    span = L.device_window(df, "A", at(0), at(10))
    assert [r.timestamp for r in span.collect()] == [at(0), at(9)]
    assert L.device_window(df, "A", at(0), at(10), 1).count() == 1
    assert [r.timestamp for r in L.recent_device_window(df).collect()] == [at(10)]
    assert sorted((r.device_id, r.timestamp) for r in L.latest_per_device(df, 2).collect()) == [
        ("A", at(10)), ("A", at(20)), ("B", at(4))]


def test_auc_and_sweep_against_definitions(spark):
    rng = np.random.default_rng(2)
    y, s = rng.integers(0, 2, 800), rng.integers(0, 40, 800) / 40.0
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double").repartition(5)
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert E.roc_auc(df).first().roc_auc == pytest.approx(auc, rel=1e-12)
    rows = E.threshold_sweep(df, limit=50).collect()
    assert sorted(r.threshold for r in rows) == pytest.approx(sorted(set(np.quantile(s, E.SWEEP_QUANTILES))))
    for r in rows:
        hit = s >= r.threshold
        assert r.precision == pytest.approx(y[hit].mean()) and r.recall == pytest.approx(hit[y == 1].mean())
    assert [(r.recall, r.precision) for r in rows] == sorted([(r.recall, r.precision) for r in rows], reverse=True)
    assert E.best_threshold(E.threshold_sweep(df, [0.5]))["threshold"] == 0.5
    with pytest.raises(ValueError):
        E.best_threshold(E.threshold_sweep(df, []))


@pytest.mark.parametrize("labels", [[0, 0], [1, 1], []])
def test_one_class_has_no_auc(spark, labels):
    df = spark.createDataFrame([(y, 0.5) for y in labels], "y int, score double")
    assert E.roc_auc(df).first().roc_auc == 0.0
    row = E.threshold_sweep(df, [0.9]).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_families():
    names = {"voltage_v_mean": "Voltage", "rpm_fft_energy": "RPM", "error_streak": "Error/Flags", "my_flag": "Error/Flags",
             "state_change_count": "State", "in_transition": "State", "time_since_error_s": "Time", "phase_sin": "Other"}
    assert {n: sensor_family(n) for n in names} == names
    assert sensor_family("flow_rate_mean", ["flow", "flow_rate"]) == "flow_rate"


def test_contributions(spark):
    names = ["rpm_mean", "temp_c_mean", "rpm_std", "phase_sin"]
    rows = [(1, 3.0, -1.0, 1.0, float("inf")), (2, 0.0, 0.0, None, float("nan"))]
    df = spark.createDataFrame(rows, "id int, rpm_mean double, temp_c_mean double, rpm_std double, phase_sin double")
    a, b = X.contributions(df, names, 2).orderBy("id").collect()
    assert [tuple(x) for x in a.top_features] == [("rpm_mean", 60.0), ("temp_c_mean", 20.0)]  # ties: earlier column
    assert a.family_totals == {"RPM": 80.0, "Temperature": 20.0, "Other": 0.0}
    assert [tuple(x) for x in a.families_sorted] == [("RPM", 80.0), ("Temperature", 20.0), ("Other", 0.0)]
    assert b.top_features == [] and b.family_totals == {} and b.families_sorted == []


def test_summaries(spark):
    rows = [("A", 0.1, {"RPM": 60.0, "Time": 40.0}), ("A", 0.3, {"RPM": 20.0, "Voltage": 80.0}), ("A", None, None),
            ("B", 0.9, {"RPM": 0.0}), (None, 0.5, {"Time": 10.0})]
    df = spark.createDataFrame(rows, "device_id string, score double, family_totals map<string,double>")
    got = {r.group_key: r for r in G.aggregate_explanations(df, top_k=2).collect()}
    assert list(got) == ["A", "B", "nan"]
    a = got["A"]
    assert a.n_flagged == 3 and a.avg_score == pytest.approx(0.4 / 3) and a.p95_score == pytest.approx(np.percentile([0.1, 0.3, 0], 95))
    assert [tuple(x) for x in a.top_families] == [("RPM", 40.0), ("Voltage", 40.0)]
    assert [tuple(x) for x in got["B"].top_families] == [("RPM", 0.0)]
    assert G.aggregate_explanations(df, None).first().n_flagged == 5
    with pytest.raises(ValueError):
        G.aggregate_explanations(df.drop("family_totals"))
