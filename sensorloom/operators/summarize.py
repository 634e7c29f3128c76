"""Explained rows rolled up per device, per tag or for the whole fleet."""

from pyspark.sql import DataFrame, functions as F

from sensorloom.operators.quantiles import exact_quantiles, group_quantile

FLEET = "fleet"
FAMILIES = "array<struct<family:string,pct:double>>"


def _entries():
    return F.collect_list(F.struct((-F.col("pct")).alias("down"), "family", "pct")).alias("e")


def _leading(top_k: int):
    """The largest shares of ``e`` in order, scaled to 100."""
    return F.transform(F.slice(F.array_sort("e"), 1, top_k), lambda e: F.struct(e.family.alias("family"), F.when(
        F.col("total") > 0, e.pct / F.col("total") * 100.0).otherwise(F.lit(0.0)).alias("pct")))


def _fleet(rows: DataFrame, top_k: int, score: str, totals: str) -> DataFrame:
    """The whole table as one group: plain aggregates and an exact quantile, nothing joined."""
    scored = rows.select(F.coalesce(F.col(score), F.lit(0.0)).alias("s"))
    p95 = exact_quantiles(scored, ["s"], [0.95])["s"][0]
    count = scored.agg(F.count(F.lit(1)).alias("n_flagged"), F.avg("s").alias("avg_score")).withColumn(
        "top_families", F.lit(None).cast(FAMILIES))
    shares = (rows.select(F.explode_outer(totals).alias("family", "pct")).where("family IS NOT NULL")
              .groupBy("family").agg(F.sum("pct").alias("pct")))
    top = shares.agg(_entries(), F.sum("pct").alias("total")).select(
        F.lit(None).cast("long").alias("n_flagged"), F.lit(None).cast("double").alias("avg_score"), _leading(top_k).alias("top_families"))
    both = count.unionByName(top).agg(F.max("n_flagged").alias("n_flagged"), F.max("avg_score").alias("avg_score"),
                                      F.first("top_families", True).alias("top_families"))
    return both.where("n_flagged > 0").select(
        F.lit(FLEET).alias("group_key"), F.lit(None).cast("string").alias("device_id"), "n_flagged", "avg_score",
        F.lit(p95).cast("double").alias("p95_score"), F.coalesce("top_families", F.array().cast(FAMILIES)).alias("top_families"))


def aggregate_explanations(rows: DataFrame, group_by: str | None = "device_id",
                           top_k: int = 5, score: str = "score",
                           totals: str = "family_totals") -> DataFrame:
    """Count, mean and 95th percentile of the score, and the leading families of each group.

    Family shares are summed per (group, family) and scaled to 100.  Every part is a
    partial aggregate; only one row per group, or per group and family, is joined.
    """
    if totals not in rows.columns:
        raise ValueError(f"Expected '{totals}' column on rows.")
    if group_by is None:
        return _fleet(rows, top_k, score, totals)
    key = F.coalesce(F.col(group_by).cast("string"), F.lit("nan"))
    keyed = rows.select(key.alias("group_key"), F.coalesce(F.col(score), F.lit(0.0)).alias("s"),
                        F.col(totals).alias("t"))
    scores = keyed.groupBy("group_key").agg(F.count(F.lit(1)).alias("n_flagged"), F.avg("s").alias("avg_score"))
    p95 = group_quantile(keyed, ["group_key"], "s", 0.95).select("group_key", F.col("value").alias("p95_score"))
    # An outer explode: a plain one lets the optimizer compute the map twice, to test its size.
    shares = (keyed.select("group_key", F.explode_outer("t").alias("family", "pct"))
              .where("family IS NOT NULL")
              .groupBy("group_key", "family").agg(F.sum("pct").alias("pct")))
    top = (shares.groupBy("group_key").agg(_entries(), F.sum("pct").alias("total"))
           .select("group_key", _leading(top_k).alias("top_families")))
    none = F.array().cast(FAMILIES)
    return (scores.join(p95, "group_key").join(top, "group_key", "left")
            .select("group_key", F.col("group_key").alias("device_id") if group_by == "device_id"
                    else F.lit(None).cast("string").alias("device_id"),
                    "n_flagged", "avg_score", "p95_score",
                    F.coalesce("top_families", none).alias("top_families"))
            .orderBy(F.desc("n_flagged"), F.desc("p95_score"), "group_key"))
