"""Isolation forest (Liu, Ting, Zhou, ICDM 2008) as Spark jobs.

All randomness is md5: a row is drawn for a tree by a hash of its key, and a node draws its feature and
its split by a hash of (seed, tree, node).  So the same table gives the same forest however it
is partitioned, and another program can draw it again.  Nodes are numbered like a heap, the root is 1 and the children
of k are 2 k and 2 k + 1.  Trees are grown in parallel, one small group of ``sample_size`` rows each.
Scoring is a narrow Arrow pass with the node table broadcast; that table has at most
``trees * 2 * sample_size`` rows whatever the size of the data.

Standardizing shifts and stretches each feature, which moves uniform splits along with the
rows and changes no path.  Trees are therefore grown on the readings themselves, and the
rounding of a distributed mean cannot make two fits differ; the scaler serves attribution.
Trees see readings on a grid (:func:`on_grid`), so that errors in the last places of a feature decide nothing.
"""

from dataclasses import dataclass
from hashlib import md5
from math import ceil, log, log1p, log2, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sensorloom.functions.scalars import epoch_micros
from sensorloom.operators.quantiles import DIRECT_ROWS, exact_quantiles
from sensorloom.operators.scaling import Scaler, align_features, fit_scaler
from sensorloom.workspace import materialize

# Size of a tree's sample, the expected share of outliers in training rows,
# number of trees, seed, and Euler's constant as used in the path length formula.
SAMPLE_SIZE = 256
CONTAMINATION = 0.02
TREES = 100
SEED = 42
EULER = 0.5772156649

# Grid of readings: steps of a millionth, a shift that keeps halves off its borders, and 2 ** 33 + 1, by which a double is cut to 20 binary digits.
STEPS, SHIFT, CUT, GRID_END = 1e6, 0.6281718, 8589934593.0, 1e9
UNIT = 1 << 52  # steps of a uniform draw: thirteen hexadecimal digits

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("split", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()), T.StructField("depth", T.IntegerType()),
])


def mean_path(n: int) -> float:
    """Average path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (log(n - 1) + EULER) - 2.0 * (n - 1) / n


@dataclass(frozen=True)
class ForestModel:
    scaler: Scaler
    nodes: pd.DataFrame
    sample_size: int
    offset: float = 0.0


def on_grid(x: np.ndarray) -> np.ndarray:
    """Readings as trees see them: multiples of 1e-6 (below 1e9), cut to 20 binary digits."""
    small = np.abs(x) < GRID_END
    fine = np.where(small, np.floor(np.where(small, x, 0.0) * STEPS + SHIFT) / STEPS, x)
    wide = np.where(np.abs(fine) < 1e290, fine, 0.0) * CUT
    return np.where(np.abs(fine) < 1e290, wide - (wide - fine), fine)


def draw(seed: int, tree: int, node: int, what: str) -> float:
    """A uniform number from [0, 1) for one decision of one node."""
    return int(md5(f"{seed}:{tree}:{node}:{what}".encode()).hexdigest()[:13], 16) / UNIT


def grow_tree(sample: np.ndarray, seed: int, tree: int, max_depth: int) -> list[tuple]:
    """Node tuples (node, feature, split, left, right, size, depth); feature -1 marks a leaf."""
    nodes, pending = [], [(1, np.arange(len(sample)), 0)]
    while pending:
        node, rows, depth = pending.pop()
        here = sample[rows]
        low, high = here.min(axis=0), here.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or not len(varying):
            nodes.append((node, -1, 0.0, node, node, len(rows), depth))
            continue
        feature = int(varying[int(draw(seed, tree, node, "feature") * len(varying))])
        # Rounding may put the draw on the maximum, which would leave one side empty.
        split = min(float(low[feature] + draw(seed, tree, node, "split") * (high[feature] - low[feature])),
                    float(np.nextafter(high[feature], -np.inf)))
        below = here[:, feature] <= split
        left, right = 2 * node, 2 * node + 1
        nodes.append((node, feature, split, left, right, len(rows), depth))
        pending += [(right, rows[~below], depth + 1), (left, rows[below], depth + 1)]
    return nodes


def _draws(chance: float, trees: int) -> tuple[str, str]:
    """SQL for whether a row is drawn for any tree, and for the trees it is drawn for, each with this chance, from the row's md5 ``_key``.

    The next tree is found by a geometric jump, so a row costs about one hash, not one per tree.
    """
    if chance >= 1.0:
        return "true", f"sequence(0, {trees - 1})"
    digits = lambda k: "_key" if k == "0" else f"md5(concat(_key, ':', {k}))"
    jump = lambda k: (f"CAST(least(1 + floor(ln((CAST(conv(substring({digits(k)}, 1, 13), 16, 10) AS DOUBLE) + 0.5D) / {UNIT}D) / "
                      f"{log1p(-chance)!r}D), {trees}) AS INT)")
    step = (f"CASE WHEN s.at >= {trees} THEN s ELSE named_struct('at', s.at + {jump('k')}, 'hits', concat(s.hits, array(s.at))) END")
    # One draw tells that most rows are in no tree; only the others go on jumping.
    return (f"{jump('0')} <= {trees}",
            f"CASE WHEN {jump('0')} > {trees} THEN NULL ELSE aggregate(sequence(1, {trees}), "
            f"named_struct('at', {jump('0')} - 1, 'hits', CAST(array() AS array<int>)), (s, k) -> {step}, s -> s.hits) END")


def _samples(df: DataFrame, keys, features, total: int, trees: int, size: int, seed: int) -> DataFrame:
    """``size`` rows per tree, drawn without replacement from all rows, as (tree, rank, features).

    Hashes of the row key put somewhat more rows than needed before each tree, which takes
    its lowest draws.
    """
    chance = min(1.0, (size + 8 * sqrt(size) + 32) / total)
    in_tree = Window.partitionBy("tree").orderBy("draw", *keys)
    text = [(epoch_micros(F.col(k)) if df.schema[k].dataType.typeName().startswith("timestamp") else F.col(k)).cast("string") for k in keys]
    drawn, hits = _draws(chance, trees)
    # Rows of no tree leave before the columns of all others are copied.
    return (df.withColumn("_key", F.md5(F.concat_ws("|", *text, F.lit(str(seed))))).where(drawn)
            # An outer explode: a plain one lets the optimizer draw twice, to test for hits.
            .withColumn("tree", F.explode_outer(F.expr(hits))).where("tree IS NOT NULL")
            .select("tree", F.md5(F.concat("_key", F.lit(":t"), F.col("tree").cast("string"))).alias("draw"), *keys, *features)
            .withColumn("rank", F.row_number().over(in_tree)).where(F.col("rank") <= size)
            .select("tree", "rank", *features))


def grow_forest(df: DataFrame, features, keys, total: int, trees: int = TREES, seed: int = SEED,
                sample_size: int = SAMPLE_SIZE) -> DataFrame:
    """Node table of a forest over aligned feature rows."""
    size = min(sample_size, total)
    depth = max(1, ceil(log2(max(2, size))))
    columns = list(features)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        sample = on_grid(group.sort_values("rank")[columns].to_numpy(dtype=float))
        nodes = grow_tree(sample, seed, tree, depth)
        return pd.DataFrame([(tree, *n) for n in nodes], columns=NODE_SCHEMA.names)

    drawn = _samples(df, keys, columns, total, trees, size, seed)
    return drawn.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


class _Packed:
    """Node table as one row of arrays per tree, ready for vectorised descent."""

    def __init__(self, nodes: pd.DataFrame, sample_size: int):
        trees, width = int(nodes["tree"].max()) + 1, int(nodes["node"].max()) + 1
        at = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())
        fill = lambda values, dtype: self._scatter((trees, width), at, values, dtype)
        feature = nodes["feature"].to_numpy()
        self.feature = fill(np.maximum(feature, 0), np.int32)
        self.split = fill(nodes["split"].to_numpy(), np.float64)
        # Children side by side: one lookup goes down a step on either side.
        self.children = np.stack([fill(nodes[c], np.int64) for c in ("left", "right")], axis=2).reshape(trees, 2 * width)
        leaf_path = nodes["depth"].to_numpy() + np.array([mean_path(int(n)) for n in nodes["size"]])
        self.path = fill(np.where(feature < 0, leaf_path, 0.0), np.float64)
        self.steps = int(nodes["depth"].max())
        self.norm = mean_path(sample_size) or 1.0

    @staticmethod
    def _scatter(shape, at, values, dtype):
        out = np.zeros(shape, dtype)
        out[at] = values
        return out

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path) per row."""
        rows = len(x)
        # Readings of a feature side by side, so that rows at the same node read neighbouring ones.
        flat, row = np.ascontiguousarray(x.T).ravel(), np.arange(rows)
        total = np.zeros(rows)
        for at, split, children, path in zip(self.feature.astype(np.int64) * rows, self.split, self.children, self.path):
            node = np.ones(rows, np.int64)
            for _ in range(self.steps):
                goes_right = flat.take(at.take(node) + row) > split.take(node)
                node = children.take(2 * node + goes_right)
            total += path.take(node)
        return np.exp2(-total / len(self.path) / self.norm)


def score_forest(df: DataFrame, model: ForestModel, score: str = "score") -> DataFrame:
    """Append the score; higher is more anomalous, about ``contamination`` of training rows reach 0."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(_Packed(model.nodes, model.sample_size))
    offset = model.offset
    features = model.scaler.features
    present = set(df.columns)
    schema = T.StructType([f for f in df.schema.fields if f.name != score]
                          + [T.StructField(score, T.DoubleType())])
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches):
        packed = shared.value
        for batch in batches:
            x = np.zeros((batch.num_rows, len(features)))
            for i, f in enumerate(features):
                if f in present:
                    x[:, i] = batch.column(f).to_numpy(zero_copy_only=False)
            scores = packed.anomaly(on_grid(np.nan_to_num(x, nan=0.0))) - offset
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(scores)], names=[*kept, score])

    return df.mapInArrow(run, schema)


def fit_forest(df: DataFrame, features, keys, contamination: float = CONTAMINATION,
               trees: int = TREES, seed: int = SEED, sample_size: int = SAMPLE_SIZE,
               limit: int = DIRECT_ROWS) -> ForestModel:
    """Scaler, trees and offset.

    ``df`` is read several times (moments, sample, offset), so pass a stored table when
    its features are costly.  ``keys`` must identify a row.
    """
    scaler = fit_scaler(df, features)
    aligned = align_features(df, features, keys)
    nodes = grow_forest(aligned, features, keys, scaler.rows, trees, seed, sample_size).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    model = ForestModel(scaler, nodes, min(sample_size, scaler.rows))
    # Stored once: exact quantiles read the scores several times.
    # Doubles go to the scores as they are, which takes missing ones as 0.0: a projection of all would be too long to be compiled.
    kinds = dict(df.dtypes)
    readings = align_features(df, [f for f in features if kinds.get(f) != "double"], [f"`{f}`" for f in features if kinds.get(f) == "double"])
    raw = materialize(score_forest(readings, model, "_s").select("_s"), "scores")
    offset = exact_quantiles(raw, ["_s"], [1.0 - contamination], limit)["_s"][0]
    return ForestModel(scaler, nodes, model.sample_size, offset)
