"""Threshold metrics, ranking quality and recall per fault."""

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.functions.scalars import normalize_tag
from sensorloom.operators.quantiles import DIRECT_ROWS, exact_quantiles

# Quantiles of the score used as thresholds where none are given.
SWEEP_QUANTILES = [0.90, 0.92, 0.94, 0.96, 0.98]


def score_quantile_thresholds(df: DataFrame, score: str = "score",
                              limit: int = DIRECT_ROWS) -> list[float]:
    """Distinct quantiles of the score, ascending."""
    found = exact_quantiles(df, [score], SWEEP_QUANTILES, limit)[score]
    return sorted({q for q in found if q is not None})


def roc_auc(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Rank AUC with ties averaged, one row; 0.0 where a class is absent.

    Scores are reduced to class counts per distinct value and range-partitioned.  Each
    range is read once in order and yields three numbers; ranges are then added up.
    """
    counts = (df.where(F.col(score).isNotNull())
              .groupBy(F.col(score).cast("double").alias("s"))
              .agg(F.sum(F.col(y).cast("double")).alias("pos"),
                   F.sum(1.0 - F.col(y).cast("double")).alias("neg")))

    def range_totals(batches):
        low, pos, neg, wins = None, 0.0, 0.0, 0.0
        for b in batches:
            if not len(b):
                continue
            low = b["s"].iloc[0] if low is None else low
            under = neg + b["neg"].cumsum() - b["neg"]
            wins += float((b["pos"] * (under + b["neg"] / 2)).sum())
            pos, neg = pos + float(b["pos"].sum()), neg + float(b["neg"].sum())
        if low is not None:
            yield pd.DataFrame({"low": [low], "pos": [pos], "neg": [neg], "wins": [wins]})

    ranges = (counts.repartitionByRange("s").sortWithinPartitions("s")
              .mapInPandas(range_totals, "low double, pos double, neg double, wins double"))
    # One row per partition: few enough for a single ordered sum.
    upto = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    lower = ranges.withColumn("under", F.coalesce(F.sum("neg").over(upto), F.lit(0.0)))
    pairs = F.sum("pos") * F.sum("neg")
    area = F.sum(F.col("wins") + F.col("pos") * F.col("under")) / F.nullif(pairs, F.lit(0.0))
    return lower.agg(F.coalesce(area, F.lit(0.0)).alias("roc_auc"))


def threshold_sweep(df: DataFrame, thresholds: list[float] | None = None, y: str = "y",
                    score: str = "score", limit: int = DIRECT_ROWS) -> DataFrame:
    """Precision, recall, f1 and AUC per threshold, best recall then precision first.

    All thresholds are counted in one pass, without a join.
    """
    if thresholds is None:
        thresholds = score_quantile_thresholds(df, score, limit)
    auc = roc_auc(df, y, score).first()["roc_auc"]
    positive, value = F.col(y) == 1, F.col(score)
    counts = [F.count_if(positive).alias("p")]
    for i, t in enumerate(thresholds):
        counts += [F.count_if((value >= t) & positive).alias(f"tp{i}"),
                   F.count_if(value >= t).alias(f"n{i}")]
    cells = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"),
                               F.col(f"n{i}").alias("n")) for i, t in enumerate(thresholds)])
    if not thresholds:
        cells = F.array().cast("array<struct<threshold:double,tp:bigint,n:bigint>>")
    share = lambda part, whole: F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))
    tp, n, p = F.col("c.tp"), F.col("c.n"), F.col("p")
    return (df.agg(*counts).select("p", F.explode(cells).alias("c"))
            .select(F.col("c.threshold").alias("threshold"),
                    share(tp, n).alias("precision"), share(tp, p).alias("recall"),
                    share(2 * tp, n + p).alias("f1"), F.lit(auc).alias("roc_auc"))
            .orderBy(F.desc("recall"), F.desc("precision"), "threshold"))


def best_threshold(sweep: DataFrame) -> dict[str, float]:
    """First row of a sweep; a sweep of nothing cannot select a threshold."""
    row = sweep.first()
    if row is None:
        raise ValueError("the sweep has no thresholds to select from")
    return row.asDict()


def per_tag_recall(df: DataFrame, pred: str = "pred", tag: str = "anomaly_tag") -> DataFrame:
    """Recall, hits and misses per fault tag, best first."""
    tagged = df.select(normalize_tag(F.col(tag)).alias("tag"), pred).where("tag <> ''")
    tp, fn = F.count_if(F.col(pred) == 1), F.count_if(F.col(pred) == 0)
    return (tagged.groupBy("tag").agg(tp.alias("tp"), fn.alias("fn"))
            .select("tag", (F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fn"))).alias("recall"),
                    "tp", "fn")
            .orderBy(F.desc("recall"), "tag"))
