"""JSON outputs of a scoring run, and the document shapes a feed may have.

Alerts and summaries are open objects: known keys become typed columns, and the whole object stays beside them in the VARIANT
column ``body``, so that other keys can be read by path, sorted by and written again.

Spark writes JSON lines, which split and scale.  A feed may also be one JSON document, a list
or an object, which is cut into its items (``documents``); it is only offered for feeds, never for
telemetry.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sensorloom.schema import AGGREGATE, ALERT
from sensorloom.sources.documents import read_keyed, read_list


OPEN = "body"


def extra(path: str, kind: str) -> Column:
    """The value at a path of the whole object, such as ``$.site.room``; null where there is none of this type."""
    return F.try_variant_get(F.col(OPEN), path, kind)


def as_json(df: DataFrame) -> Column:
    """A row as JSON text: its columns, and all keys of its open object that are not among them."""
    columns = [c for c in df.columns if c != OPEN]
    every = {"ignoreNullFields": "false"}
    typed = F.to_json(F.struct(*columns), every)
    if OPEN not in df.columns:
        return typed
    entries = lambda text: F.from_json(text, "map<string,variant>")
    others = F.map_filter(entries(F.to_json(OPEN)), lambda key, _: ~key.isin(*columns))
    return F.when(F.col(OPEN).isNull(), typed).otherwise(F.to_json(F.map_concat(entries(typed), others), every))


def write_feed(df: DataFrame, path: str) -> None:
    """JSON lines, replaced on every run; keys of an open object are kept."""
    if OPEN in df.columns:
        df.select(as_json(df).alias("value")).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """The selected metrics as one record."""
    schema = T.StructType([T.StructField(k, T.DoubleType()) for k in metrics])
    row = [tuple(None if v is None else float(v) for v in metrics.values())]
    write_feed(spark.createDataFrame(row, schema).coalesce(1), path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def _is_text(item: Column, name: str) -> Column:
    value = F.variant_get(F.try_parse_json(item), f"$.{name}", "variant")
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that hold an object, with their place ``pos`` among all of them in the order of files and lines.

    Spark reads the largest splits first, so places are counted: inside a split by line, and over
    the splits, a short list, in the order of their files.
    """
    lines = (spark.read.text(path)
             .select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_line"))
             .where(F.ltrim("value").startswith("{")))
    split = ["_file", "_block"]
    counts = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(*split, (F.sum("_n").over(Window.orderBy(*split)) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*split).orderBy("_line"))
    return (lines.withColumn("_inside", inside).join(before, split)
            .select("value", (F.col("_before") + F.col("_inside") - 1).alias("pos")))


def _typed(rows: DataFrame, schema) -> DataFrame:
    """Rows (pos, item) with the known keys of the item as columns of ``a``; items that are no JSON go."""
    return rows.withColumn("a", F.from_json("item", schema)).where("a IS NOT NULL")


def read_alerts(spark: SparkSession, path: str, document: bool = False, parts: bool = False) -> DataFrame:
    """Alerts with their position ``pos`` and the whole object ``body``.

    ``document``: one JSON list, or an object whose ``alerts`` key holds the list; with ``parts`` all files together are the document.
    Otherwise JSON lines, whose order is the order of files and lines.
    """
    if document:
        rows = read_list(spark, path, "alerts", parts)
    else:
        rows = _lines(spark, path).withColumnRenamed("value", "item")
    # An id that is no text, such as a number, is none.
    ids = {n: F.when(_is_text(F.col("item"), n), F.col(f"a.{n}")) for n in ("alert_id", "id")}
    known = [ids.get(f.name, F.col(f"a.{f.name}")).alias(f.name) for f in ALERT]
    return _typed(rows, ALERT).select("pos", *known, F.try_parse_json("item").alias(OPEN))


def read_aggregates(spark: SparkSession, path: str, document: bool = False, parts: bool = False) -> DataFrame:
    """Summaries keyed by ``device_id``, with the whole object ``body``; the last one of a device counts.

    ``document``: one JSON list of summaries, or an object keyed by device; with ``parts`` all files together are the document.
    """
    if document:
        rows = read_keyed(spark, path, parts)
    else:
        rows = _lines(spark, path).select("pos", F.lit(None).cast("string").alias("key"), F.col("value").alias("item"))
    rows = _typed(rows, AGGREGATE).withColumn("device", F.coalesce("a.device_id", "key")).where("device IS NOT NULL")
    last = rows.groupBy("device").agg(F.max_by(F.struct("a", "item"), "pos").alias("s"))
    rest = [f"s.a.{f.name}" for f in AGGREGATE if f.name != "device_id"]
    return last.select(F.col("device").alias("device_id"), *rest, F.try_parse_json("s.item").alias(OPEN))
