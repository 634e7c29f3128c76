import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators.forest import fit_forest, grow_tree, mean_path, on_grid, score_forest
from sensorloom.operators.scaling import align_features, fit_scaler, standardize
from sensorloom.plans.scoring import run_scoring, write_run
from sensorloom.plans.training import train
from sensorloom.operators.features import FeatureSpec
from sensorloom.sources import feeds
from sensorloom.sources.model_store import load_model, save_model

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *map(float, rng.normal(size=3))) for i in range(3000)]
    rows += [(9000 + i, 8.0 + i, -9.0, 7.0) for i in range(5)]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double").repartition(4)


@pytest.fixture(scope="module")
def model(cloud):
    return fit_forest(cloud, FEATURES, ["id"], trees=60)


def test_planted_outliers_rank_on_top(cloud, model):
    top = score_forest(cloud, model).orderBy(F.desc("score")).limit(5).collect()
    assert {r.id for r in top} == {9000, 9001, 9002, 9003, 9004}


def test_about_two_percent_of_training_rows_reach_zero(cloud, model):
    scores = np.array([r.score for r in score_forest(cloud, model).select("score").collect()])
    assert np.mean(scores >= 0) == pytest.approx(0.02, abs=0.002)
    assert ((scores + model.offset > 0) & (scores + model.offset < 1)).all()


def test_forest_does_not_depend_on_partitioning(cloud, model):
    again = fit_forest(cloud.repartition(7, "b"), FEATURES, ["id"], trees=60)
    assert again.nodes.equals(model.nodes) and again.offset == pytest.approx(model.offset, rel=1e-12)
    other = fit_forest(cloud, FEATURES, ["id"], trees=60, seed=7)
    assert not other.nodes.equals(model.nodes)


def test_trees_are_well_formed(model):
    nodes = model.nodes
    assert nodes["tree"].nunique() == 60 and (nodes.groupby("tree")["size"].max() == 256).all()
    assert nodes["depth"].max() <= 8
    for _, tree in nodes.groupby("tree"):
        size = tree.set_index("node")["size"]
        inner = tree[tree["feature"] >= 0]
        assert (size[inner["left"]].to_numpy() + size[inner["right"]].to_numpy() == inner["size"].to_numpy()).all()
        assert size[tree[tree["feature"] < 0]["node"]].sum() == 256


def test_samples_come_from_a_bounded_pool(spark):
    """More rows than the pool holds: every tree still gets a full sample."""
    df = spark.range(600_000).select("id", *[(F.xxhash64("id", F.lit(f)) / F.lit(2.0 ** 63)).alias(f) for f in FEATURES])
    fitted = fit_forest(df, FEATURES, ["id"], trees=8)
    assert (fitted.nodes.groupby("tree")["size"].max() == 256).all() and fitted.nodes["tree"].nunique() == 8


def test_split_never_leaves_a_side_empty():
    edge = np.array([[1.0], [np.nextafter(1.0, 2.0)]])
    nodes = grow_tree(edge, 42, 0, 8)
    assert sorted(n[5] for n in nodes) == [1, 1, 2]
    assert [n[1] for n in grow_tree(np.ones((5, 2)), 42, 0, 8)] == [-1]


def test_mean_path():
    assert [mean_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert mean_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_few_rows(spark):
    df = spark.createDataFrame([(i, float(i), 0.0, 1.0) for i in range(3)], "id bigint, a double, b double, c double")
    fitted = fit_forest(df, FEATURES, ["id"], trees=5)
    assert fitted.sample_size == 3 and score_forest(df, fitted).count() == 3
    with pytest.raises(ValueError):
        fit_forest(df.limit(0), FEATURES, ["id"])


def test_columns_are_aligned_by_name(spark, model):
    df = spark.createDataFrame([(1, 0.5, "x", -0.5)], "id int, c double, extra string, a double")
    full = df.withColumn("b", F.lit(0.0))
    assert score_forest(df, model).first().score == score_forest(full, model).first().score
    assert align_features(df, FEATURES, ["id"]).first() == (1, -0.5, 0.0, 0.5)


def test_scaler_keeps_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = fit_scaler(df, ["a", "b"])
    assert (scaler.mean, scaler.std) == ((2.0, 5.0), (1.0, 1.0))
    assert sorted(map(tuple, standardize(df, scaler).collect())) == [(-1.0, 0.0), (1.0, 0.0)]


def test_model_survives_storage(spark, cloud, model, tmp_path):
    save_model(spark, model, str(tmp_path / "m"))
    loaded = load_model(spark, str(tmp_path / "m"))
    assert loaded.scaler == model.scaler and loaded.offset == model.offset and loaded.nodes.equals(model.nodes)
    a, b = (score_forest(cloud, m).orderBy("id").limit(20).collect() for m in (model, loaded))
    assert a == b


def test_whole_job(spark, telemetry, tmp_path):
    from test_features import random_rows
    rows = random_rows(240, devices=3)
    for r in rows:
        r["anomaly_tag"] = " "
    for r in rows[:6]:
        r.update(current_a=400.0, temp_c=900.0, anomaly_tag="power_spike", state="RUN")
    df = telemetry(rows)
    spec = FeatureSpec(ties=("row_id",))
    run = run_scoring(df, train(df, spec, trees=40), spec, top_n=15)
    assert run.scored.count() == 240 and 0 < run.explanations.count() <= 15
    assert run.best["recall"] > 0 and run.sweep.count() <= 5
    assert {r.tag for r in run.tag_recall.collect()} == {"power_spike"}
    n = run.explanations.count()
    assert sum(r.n_flagged for r in run.summaries.collect()) == n == run.alerts.count()
    write_run(run, str(tmp_path / "out"))
    write_run(run, str(tmp_path / "out"))  # replaced, not appended
    assert feeds.read_alerts(spark, str(tmp_path / "out/alerts")).count() == n
    assert feeds.read_metrics(spark, str(tmp_path / "out/metrics")).first().threshold == pytest.approx(run.best["threshold"])
    with pytest.raises(ValueError):
        train(df.where("state = 'MAINT'"), spec)


def test_grid_swallows_the_last_places():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=1000) * 10.0 ** rng.integers(-3, 8, 1000), [0.0, 0.1, -5e-7]])
    noisy = x * (1 + 1e-15) + 1e-14
    assert (on_grid(x) == on_grid(noisy)).mean() > 0.999
    x = np.concatenate([x, [1e9, -1e9, 1e300, 1e-300]])
    assert np.allclose(on_grid(x), x, rtol=2e-6, atol=2e-6)


def test_missing_readings_are_fitted_as_zero(spark):
    """Doubles reach the scores as they are; missing, absent and whole-numbered features count as before."""
    rows = [(i, None if i % 3 == 0 else float(i % 11), i % 5) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, a double, b int")
    filled = df.selectExpr("row_id", "coalesce(a, 0D) AS a", "CAST(b AS double) AS b", "0D AS c")
    fit = lambda table: fit_forest(table, ["a", "b", "c"], ["row_id"], trees=5, sample_size=32)
    got, want = fit(df), fit(filled)
    assert got.offset == want.offset and got.nodes.equals(want.nodes)
