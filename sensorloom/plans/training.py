"""Train on normal rows of producing devices."""

from pyspark.sql import DataFrame

from sensorloom.operators.features import FeatureSpec, feature_matrix, feature_names
from sensorloom.operators.forest import CONTAMINATION, SEED, TREES, ForestModel, fit_forest
from sensorloom.operators.lookup import normal_rows, production_rows
from sensorloom.workspace import materialize


def training_rows(telemetry: DataFrame, spec: FeatureSpec = FeatureSpec(), **statistics) -> DataFrame:
    """Features of RUN and IDLE rows; maintenance rows leave before the windows are formed,
    tagged rows after."""
    matrix = feature_matrix(production_rows(telemetry), spec, **statistics)
    return normal_rows(matrix)


def train(telemetry: DataFrame, spec: FeatureSpec = FeatureSpec(),
          contamination: float = CONTAMINATION, trees: int = TREES, seed: int = SEED) -> ForestModel:
    """A fitted model. Features are stored once, since fitting reads them several times."""
    stored = materialize(training_rows(telemetry, spec), "training")
    if stored.isEmpty():
        raise ValueError("no normal RUN or IDLE rows to train on")
    keys = ["device_id", "timestamp", *spec.ties]
    return fit_forest(stored, feature_names(spec), keys, contamination, trees, seed)
