"""The scoring job: features, scores, threshold, explanations, summaries, alerts."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sensorloom.operators.alerts import alerts_batch
from sensorloom.operators.evaluate import best_threshold, per_tag_recall, threshold_sweep
from sensorloom.operators.explain import explain_rows
from sensorloom.operators.features import (
    FeatureSpec, feature_matrix, sample_step_seconds, signal_medians)
from sensorloom.operators.forest import ForestModel, score_forest
from sensorloom.operators.lookup import flag, top_anomalies
from sensorloom.operators.rules import FamilyRule
from sensorloom.operators.scaling import standardize
from sensorloom.operators.summarize import aggregate_explanations
from sensorloom.sources.feeds import write_feed, write_metrics
from sensorloom.workspace import BROADCAST_ROWS, materialize

# Fixed value: how many of the highest scores are explained.
TOP_ROWS = 20


@dataclass(frozen=True)
class ScoringRun:
    """Frames of one run; ``scored`` is stored, the others are small or lazy."""
    scored: DataFrame
    sweep: DataFrame
    best: dict
    tag_recall: DataFrame
    explanations: DataFrame
    summaries: DataFrame
    alerts: DataFrame


def score_telemetry(telemetry: DataFrame, model: ForestModel, spec: FeatureSpec = FeatureSpec(),
                    **statistics) -> DataFrame:
    """Every reading with label and score: the wide features stay inside the pass."""
    matrix = feature_matrix(telemetry, spec, keep=("state", "anomaly_tag"), **statistics)
    return score_forest(matrix, model).drop(*model.scaler.features)


def run_scoring(telemetry: DataFrame, model: ForestModel, spec: FeatureSpec = FeatureSpec(),
                top_n: int | None = TOP_ROWS, thresholds: list[float] | None = None,
                rules: list[FamilyRule] = ()) -> ScoringRun:
    """Score the table once, then evaluate and explain from the stored narrow result.

    ``top_n`` highest scores are explained and alerted on, as a report; None takes all flagged rows.

    The features of the few explained rows are built again from their own devices only,
    which costs less than storing all features of all rows.
    """
    statistics = {"step_s": sample_step_seconds(telemetry), "medians": signal_medians(telemetry, spec)}
    scored = materialize(score_telemetry(telemetry, model, spec, **statistics), "scored")
    sweep = threshold_sweep(scored, thresholds)
    best = best_threshold(sweep)
    flagged = flag(scored, best["threshold"])
    keys = ["device_id", "timestamp", *spec.ties]
    chosen = flagged.where("pred = 1") if top_n is None else top_anomalies(flagged, top_n, keys)
    top = materialize(chosen, "top")
    # A short report, and with it its devices, may be broadcast; anything longer is joined as Spark sees fit.
    side = F.broadcast if top_n is not None and top_n <= BROADCAST_ROWS else (lambda df: df)
    devices = side(top.select("device_id").distinct())
    matrix = feature_matrix(telemetry.join(devices, "device_id", "left_semi"), spec, **statistics)
    wide = matrix.drop("y").join(side(top), keys)
    columns = [*keys, "state", "anomaly_tag", "y", "score", "pred"]
    z = standardize(wide, model.scaler, columns)
    explained = materialize(explain_rows(z, model.scaler.features), "explained")
    return ScoringRun(scored=flagged, sweep=sweep, best=best, tag_recall=per_tag_recall(flagged),
                      explanations=explained, summaries=aggregate_explanations(explained),
                      alerts=alerts_batch(explained, rules))


def write_run(run: ScoringRun, folder: str) -> None:
    """The four JSON outputs of a run, replaced each time."""
    write_metrics(run.sweep.sparkSession, run.best, f"{folder}/metrics")
    write_feed(run.explanations, f"{folder}/explanations")
    write_feed(run.summaries, f"{folder}/aggregates")
    write_feed(run.alerts, f"{folder}/alerts")
