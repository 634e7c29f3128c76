"""Fleet counters: all are partial aggregates combined before the shuffle."""

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions.scalars import label, normalize_tag

# Rank of a severity, and the spans the fleet view covers.
SEVERITY_RANK = {"INFO": 10, "WARNING": 20, "CRITICAL": 30}
FLEET_BUCKETS = [("Last 1h", 1), ("Last 24h", 24)]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def time_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts"))


def rows_per_device(df: DataFrame, top_n: int = 10) -> DataFrame:
    counts = df.groupBy("device_id").agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), "device_id").limit(top_n)


def anomaly_rate(df: DataFrame) -> DataFrame:
    """Share of tagged rows; 0 for an empty table."""
    return df.agg(F.coalesce(F.avg(label(F.col("anomaly_tag"))), F.lit(0.0)).alias("anomaly_rate"))


def anomalies_by_tag(df: DataFrame) -> DataFrame:
    tagged = df.select(normalize_tag(F.col("anomaly_tag")).alias("tag")).where("tag <> ''")
    return tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "tag")


def error_code_rate(df: DataFrame) -> DataFrame:
    """Share of rows with a non-zero code; 0 for an empty table."""
    failed = F.coalesce(F.col("error_code") != 0, F.lit(False)).cast("int")
    return df.agg(F.coalesce(F.avg(failed), F.lit(0.0)).alias("error_rate"))


def errors_by_code(df: DataFrame) -> DataFrame:
    failed = df.where("error_code <> 0").groupBy("error_code")
    return failed.agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "error_code")


def ops_metrics(df: DataFrame, top_n: int = 10) -> DataFrame:
    """All counters as one row: a single pass groups the table by device, tag and code."""
    cells = (df.select("device_id", "timestamp",
                       normalize_tag(F.col("anomaly_tag")).alias("tag"),
                       F.coalesce(F.col("error_code"), F.lit(0)).alias("code"))
               .groupBy("device_id", "tag", "code")
               .agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("lo"),
                    F.max("timestamp").alias("hi")))
    # One grouping set per report keeps each list next to the totals it belongs to.
    sets = (cells.groupingSets([[], ["device_id"], ["tag"], ["code"]], "device_id", "tag", "code")
                 .agg(F.grouping_id().alias("g"), F.sum("n").alias("n"),
                      F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    total, by_device, by_tag, by_code = F.col("g") == 7, F.col("g") == 3, F.col("g") == 5, F.col("g") == 6
    device_total = sets.where(by_device).orderBy(F.desc("n"), "device_id").limit(top_n)
    others = sets.where(~by_device)
    rows = F.max(F.when(total, F.col("n")))

    def listing(kind, name):
        pairs = F.collect_list(F.when(kind, F.struct((-F.col("n")).alias("o"), F.col(name).alias("k"))))
        return F.transform(F.array_sort(pairs), lambda p: F.struct(p.k.alias(name), (-p.o).alias("rows")))

    tagged = by_tag & (F.col("tag") != "")
    failed = by_code & (F.col("code") != 0)
    return (others.unionByName(device_total)
            .agg(F.coalesce(rows, F.lit(0)).alias("row_count"),
                 F.max(F.when(total, F.col("lo"))).alias("min_ts"),
                 F.max(F.when(total, F.col("hi"))).alias("max_ts"),
                 listing(by_device, "device_id").alias("rows_per_device"),
                 F.coalesce(F.sum(F.when(tagged, F.col("n"))) / rows, F.lit(0.0)).alias("anomaly_rate"),
                 listing(tagged, "tag").alias("by_tag"),
                 F.coalesce(F.sum(F.when(failed, F.col("n"))) / rows, F.lit(0.0)).alias("error_rate"),
                 listing(failed, "code").alias("by_code")))


def label_breakdown(df: DataFrame) -> DataFrame:
    """Counts of normal (0) and anomalous (1) rows."""
    y = F.col("y") if "y" in df.columns else label(F.col("anomaly_tag"))
    return df.groupBy(y.alias("y")).agg(F.count(F.lit(1)).alias("rows"))


def fleet_buckets(alerts: DataFrame, buckets=FLEET_BUCKETS) -> DataFrame:
    """Distinct devices, alerts and mean severity rank over the last hours of the feed.

    Rows are first combined per device and span, so a device with very many alerts
    is one row per span after the partial aggregate.
    """
    newest = alerts.agg(F.max("timestamp")).scalar()
    rank = F.lit(0)
    for name, value in SEVERITY_RANK.items():
        rank = F.when(F.upper("severity") == name, F.lit(value)).otherwise(rank)
    spans = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(name).alias("bucket"), F.lit(h).alias("hours"))
                      for i, (name, h) in enumerate(buckets)])
    widest = F.expr(f"INTERVAL {max(h for _, h in buckets)} HOURS")
    recent = (alerts.select("device_id", "timestamp", rank.alias("rank"))
              .where(F.col("timestamp") > newest - widest)
              .withColumn("span", F.explode(spans))
              .where(F.col("timestamp") > newest - F.make_dt_interval(F.lit(0), F.col("span.hours"))))
    per_device = recent.groupBy("span", "device_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rank").alias("ranks"))
    return (per_device.groupBy("span").agg(
                F.count(F.lit(1)).alias("devices"), F.sum("n").alias("alerts"),
                (F.sum("ranks") / F.sum("n")).alias("avg_severity"))
            .orderBy("span.ord")
            .select("span.bucket", "devices", "alerts", "avg_severity"))


def anomaly_rate_over_time(df: DataFrame, unit: str = "hour") -> DataFrame:
    """Share of flagged rows per time unit."""
    return (df.groupBy(F.date_trunc(unit, "timestamp").alias("time"))
              .agg(F.avg("pred").alias("rate"), F.count(F.lit(1)).alias("rows")))


def alerts_by_route(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("route").agg(F.count(F.lit(1)).alias("alerts"))
