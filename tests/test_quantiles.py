import numpy as np
import pytest

from sensorloom.operators import quantiles as Q
from sensorloom.operators.summarize import aggregate_explanations


@pytest.mark.parametrize("kind", ["normal", "ties", "two values", "skewed", "one"])
def test_exact_under_any_limit(spark, kind):
    rng = np.random.default_rng(4)
    values = {"normal": rng.normal(size=3000), "ties": rng.integers(0, 5, 3000).astype(float),
              "two values": np.repeat([1.0, 2.0], 500), "skewed": rng.pareto(1.0, 3000), "one": np.array([7.0])}[kind]
    df = spark.createDataFrame([(float(v), None if i % 3 else float(v)) for i, v in enumerate(values)], "a double, b double")
    b = values[::3]
    probabilities = [0.0, 0.02, 0.5, 0.95, 1.0]
    for limit in (10, 10_000):
        got = Q.exact_quantiles(df, ["a", "b"], probabilities, limit)
        np.testing.assert_allclose(got["a"], np.quantile(values, probabilities), rtol=1e-12)
        np.testing.assert_allclose(got["b"], np.quantile(b, probabilities), rtol=1e-12)


def test_nothing_known(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert Q.exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}
    assert Q.exact_quantiles(df, ["a"], [0.5], limit=-1) == {"a": [None]}


@pytest.mark.parametrize("accuracy", [10_000, 200])
def test_group_quantile_with_a_hot_group(spark, monkeypatch, accuracy):
    """With a coarse sketch the hot group goes through the bracket, small ones stay whole."""
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    rng = np.random.default_rng(9)
    groups = {"hot": rng.normal(size=4000), "tied": np.repeat([1.0, 2.0, 3.0], [2000, 50, 950]),
              "two": np.array([1.0, 5.0]), "one": np.array([3.0]), None: rng.random(70)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "g string, v double")
    for p in (0.5, 0.95):
        got = {r.g: (r.n, r.value) for r in Q.group_quantile(df, ["g"], "v", p).collect()}
        assert set(got) == set(groups)
        for k, vs in groups.items():
            assert got[k][0] == len(vs) and got[k][1] == pytest.approx(np.quantile(vs, p), rel=1e-12)


def test_groups_that_a_sketch_misses_are_ranked_in_full(spark, monkeypatch):
    """A bracket that cannot hold the rank: no job fails, and the hot group spreads over ranges."""
    monkeypatch.setattr(Q, "ACCURACY", 100)
    monkeypatch.setattr(Q, "MARGIN", 0.0)
    by_ranges, used = Q._quantile_by_ranges, []
    monkeypatch.setattr(Q, "_quantile_by_ranges", lambda *a: used.append(a) or by_ranges(*a))
    rng = np.random.default_rng(11)
    groups = {"hot": rng.pareto(1.0, 9000), "tied": np.repeat([1.0, 2.0, 3.0], [2000, 50, 950]), None: rng.random(700), "few": rng.random(7)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("hot", None), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for p in (0.0, 0.3, 0.95, 1.0):
        got = {r.g: (r.n, r.value) for r in Q.group_quantile(df, ["g"], "v", p).collect()}
        assert set(got) == set(groups)
        for k, vs in groups.items():
            assert got[k][0] == len(vs) and got[k][1] == pytest.approx(np.quantile(vs, p), rel=1e-12)
    assert used
    full = {r.g: r.value for r in by_ranges(df, ["g"], "v", 0.7).collect()}
    assert full == {k: pytest.approx(np.quantile(vs, 0.7), rel=1e-12) for k, vs in groups.items()}


def test_two_frequent_values_with_many_between(spark):
    values = [0.0] * 5000 + [1.0] * 5000 + [i / 3001 for i in range(1, 3001)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    wanted = [0.2, 0.38461, 0.3846153846, 0.45, 0.5, 0.6153846, 0.7]
    got = Q.exact_quantiles(df, ["v"], wanted, limit=20)["v"]
    for p, g in zip(wanted, got):
        assert g == pytest.approx(float(np.quantile(values, p)), abs=1e-12)


def test_fleet_summary_has_no_join(spark):
    rows = spark.createDataFrame([("A", 0.2, {"X": 30.0, "Y": 70.0}), ("B", None, {"X": 50.0})],
                                 "device_id string, score double, family_totals map<string,double>")
    fleet = aggregate_explanations(rows, None)
    row = fleet.first()
    assert (row.group_key, row.n_flagged, row.avg_score) == ("fleet", 2, 0.1)
    assert [(f.family, round(f.pct, 6)) for f in row.top_families] == [("X", 53.333333), ("Y", 46.666667)]
    plan = fleet._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    assert aggregate_explanations(rows.limit(0), None).count() == 0
