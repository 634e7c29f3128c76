"""Toxicity by a chain of linear classifiers.

Categories are predicted in a fixed order. The model of a category sees the words of the text and
the probabilities of all earlier categories. While training, those probabilities are out of fold:
each row's come from models that never saw the row, as they will be for new texts.

Fitting takes at most `per_class` labelled rows of every combination of labels, chosen by a hash of
the key; rows are weighted back to the shares of the whole label table. That bound keeps the ids fit to be
broadcast and the training set small. Scoring is a narrow Arrow pass over all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WORD = re.compile(r"[^\W\d_]+")
STEM = 4        # letters of the beginning of a longer word, a feature of its own
PER_CLASS = 3000
FEATURES = 8192  # most features, by their distance from chance
FOLDS = 3
THRESHOLD = 0.06  # classes are far from even, so clear cases of the rare one end below one half
CLEAR = 4.5     # standard errors between classes from which a feature counts


def features(text: str) -> set[str]:
    """Words in small letters, and the beginnings (with a hyphen) of those of four letters or more."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:STEM] + "-" for w in words if len(w) >= STEM}


@dataclass(frozen=True)
class Linear:
    """A linear model: weights of features, of earlier probabilities, and a constant."""

    weights: dict[str, float] = field(default_factory=dict)
    chain: tuple[float, ...] = ()
    constant: float = -20.0

    def probability(self, seen: set[str], earlier: list[float]) -> float:
        small, large = (seen, self.weights) if len(seen) < len(self.weights) else (self.weights, seen)
        z = self.constant + sum(self.weights[f] for f in small if f in large)
        z += sum(w * p for w, p in zip(self.chain, earlier, strict=True))
        return 1 / (1 + float(np.exp(-min(30.0, max(-30.0, z)))))


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    models: tuple[Linear, ...]

    def predict(self, text: str) -> list[float]:
        seen, out = features(text), []
        for model in self.models:
            out.append(model.probability(seen, out))
        return out


def fit(hits: list[list[int]], names: list[str], y: np.ndarray, weight: np.ndarray, chain: np.ndarray, steps: int = 500) -> Linear:
    """Weighted logistic regression with a ridge, by Adam over all rows at once.

    hits: places in `names` of the features of each row; chain: earlier probabilities. With one class alone there is
    nothing to tell apart: the result is the constant of that class.
    """
    if not len(y) or y.min() == y.max():
        return Linear({}, (0.0,) * chain.shape[1], 20.0 if len(y) and y[0] else -20.0)
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    col = np.concatenate([np.asarray(h, np.int64) for h in hits])
    n, m, k = len(hits), len(names), chain.shape[1]
    theta, first, second = np.zeros(m + k + 1), np.zeros(m + k + 1), np.zeros(m + k + 1)
    share = weight / weight.sum()
    # Both classes pull alike; the constant is set back to the true shares afterwards.
    p1 = float(share[y == 1].sum())
    balanced = np.where(y == 1, share / p1, share / (1 - p1)) / 2
    for step in range(1, steps + 1):
        z = np.bincount(row, theta[col], n) + chain @ theta[m:m + k] + theta[-1]
        error = balanced * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        slope = np.concatenate([np.bincount(col, error[row], m), chain.T @ error, [error.sum()]])
        slope[:-1] += 1e-5 * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        theta -= 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
    constant = theta[-1] + np.log(p1 / (1 - p1))
    return Linear(dict(zip(names, theta[:m].tolist(), strict=True)), tuple(theta[m:m + k].tolist()), float(constant))


def fit_chain(hits: list[list[int]], names: list[str], labels: np.ndarray, weight: np.ndarray, categories: tuple[str, ...],
              folds: int = FOLDS) -> Chain:
    """labels: a column of 0 and 1 per category. Rows are dealt to folds in turn."""
    n = len(hits)
    fold = np.arange(n) % folds
    chain, models = np.zeros((n, 0)), []
    for c in range(len(categories)):
        y, out = labels[:, c], np.zeros(n)
        last = c == len(categories) - 1
        for f in () if last else range(folds):
            seen, held = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            model = fit([hits[i] for i in seen], names, y[seen], weight[seen], chain[seen])
            out[held] = [model.probability({names[j] for j in hits[i]}, chain[i].tolist()) for i in held]
        models.append(fit(hits, names, y, weight, chain))
        chain = np.column_stack([chain, out])
    return Chain(categories, tuple(models))


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], key: str = "doc_id", text: str = "text",
          per_class: int = PER_CLASS) -> Chain:
    """Fit on labelled rows of `docs`; `categories` maps each name to a boolean over `labels`.

    Rows whose key or any label is null are left out; of repeated keys in `labels` the largest labels count, and repeated
    documents all count. Without labelled rows every probability is near zero.
    """
    names = tuple(categories)
    rated = (labels.select(F.col(key).cast("long").alias("id"), *[c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())])
             .dropna().groupBy("id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))]))
    ys = [f"y{i}" for i in range(len(names))]
    shares = {tuple(r[:-1]): r["count"] for r in rated.groupBy(*ys).count().collect()}  # 2 ** categories rows at most
    chosen = None
    for combination in sorted(shares):
        match = F.lit(True)
        for y, value in zip(ys, combination, strict=True):
            match = match & (F.col(y) == value)
        part = rated.where(match).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        return Chain(names, tuple(Linear({}, (0.0,) * i) for i in range(len(names))))
    pairs = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(
        F.broadcast(chosen), "id")  # at most per_class rows for each combination
    sample = stored(_featured(pairs, ys))
    vocabulary = _clear_features(sample, ys)
    rows = _places(sample, ys, vocabulary).orderBy("id").collect()  # a few dozen numbers for each sampled row
    count = Counter(tuple(r[y] for y in ys) for r in rows)
    weight = np.array([shares[tuple(r[y] for y in ys)] / count[tuple(r[y] for y in ys)] for r in rows], float)
    matrix = np.array([[r[y] for y in ys] for r in rows], int).reshape(-1, len(ys))
    return fit_chain([r["places"] for r in rows], vocabulary, matrix, weight, names)


def _clear_features(sample: DataFrame, ys: list[str]) -> list[str]:
    """Features clearly more frequent on one side of some category, the clearest first; FEATURES at most."""
    totals = sample.agg(F.count("*").alias("n"), *[F.sum(y).alias(y) for y in ys]).first()
    n = totals["n"] or 0
    if not n:
        return []
    counts = sample.select(*ys, F.explode("seen").alias("f")).groupBy("f").agg(
        F.count("*").alias("c"), *[F.sum(y).alias(y) for y in ys]).where("c >= 3")
    p, distance = F.col("c") / n, F.lit(0.0)
    for y in ys:
        n1 = totals[y]
        if 0 < n1 < n:
            gap = F.abs(F.col(y) / n1 - (F.col("c") - F.col(y)) / (n - n1))
            distance = F.greatest(distance, gap / F.sqrt(p * (1 - p) * (1 / n1 + 1 / (n - n1)) + 1e-12))
    return [r.f for r in counts.select("f", distance.alias("z")).where(F.col("z") >= CLEAR).orderBy(F.desc("z"), "f").limit(FEATURES).collect()]


def _places(sample: DataFrame, ys: list[str], vocabulary: list[str]) -> DataFrame:
    at = {f: i for i, f in enumerate(vocabulary)}

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [sorted(at[f] for f in seen.as_py() if f in at) for seen in part.column(len(ys) + 1)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.list_(pa.int32()))], names=["id", *ys, "places"])

    return sample.mapInArrow(batches, ", ".join(["id long", *[f"{y} int" for y in ys], "places array<int>"]))


def _featured(pairs: DataFrame, ys: list[str]) -> DataFrame:
    names = ["id", *ys, "text"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [sorted(features(t.as_py())) for t in part.column(len(ys) + 1)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.list_(pa.string()))],
                                             names=["id", *ys, "seen"])

    return pairs.select(*names).mapInArrow(batches, ", ".join(["id long", *[f"{y} int" for y in ys], "seen array<string>"]))


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """All of `docs` plus `p_<category>`; a null text counts as empty. Columns of those names are replaced."""
    added = [f"p_{c}" for c in chain.categories]
    source = docs.drop(*added)
    names, place = source.columns, source.columns.index(text)
    out = source.select("*", *[F.lit(0.0).alias(a) for a in added]).schema

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [chain.predict(t.as_py() or "") for t in part.column(place)]
            more = [pa.array([f[i] for f in found], pa.float64()) for i in range(len(added))]
            yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*names, *added])

    return source.mapInArrow(batches, out)


def label_categories() -> dict[str, Column]:
    """The chain over the label table: low quality first, then toxic."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """`score` with a chain trained on `labels`, plus the boolean `rejected` (p_toxic at or above the threshold)."""
    chain = train(docs, labels, label_categories(), per_class=per_class)
    return score(docs, chain).withColumn("rejected", F.col("p_toxic") >= threshold)
