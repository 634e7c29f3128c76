"""Standard scores, fitted once and applied as column expressions."""

from dataclasses import dataclass
from math import sqrt

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Scaler:
    """Per-feature mean and population deviation, in training order."""
    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    rows: int = 0


def fit_scaler(df: DataFrame, features) -> Scaler:
    """One summary of a vector column; a constant feature keeps deviation 1."""
    if df.isEmpty():
        raise ValueError("no rows to fit on")
    vector = array_to_vector(F.array(*features)).alias("v")
    found = (align_features(df, features).select(vector)
             .select(Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s"))
             .select("s.*").first())
    rows = found["count"]
    std = [sqrt(v * (rows - 1) / rows) or 1.0 for v in found["variance"]]
    return Scaler(tuple(features), tuple(float(m) for m in found["mean"]), tuple(std), rows)


def align_features(df: DataFrame, features, keep=()) -> DataFrame:
    """Kept columns and the features in training order; absent ones are 0.0, others go."""
    present = set(df.columns)
    value = lambda f: f"coalesce(CAST(`{f}` AS DOUBLE), 0D)" if f in present else "0D"
    return df.selectExpr(*keep, *[f"{value(f)} AS `{f}`" for f in features])


def standardize(df: DataFrame, scaler: Scaler, keep=()) -> DataFrame:
    """z = (x - mean) / std for every feature of the scaler."""
    aligned = align_features(df, scaler.features, keep)
    return aligned.selectExpr(*keep, *[
        f"(`{f}` - {m!r}D) / {s!r}D AS `{f}`"
        for f, m, s in zip(scaler.features, scaler.mean, scaler.std)])
