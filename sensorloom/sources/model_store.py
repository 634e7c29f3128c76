"""A fitted model as three Parquet tables: scaler, forest and meta."""

from pyspark.sql import DataFrame, SparkSession, types as T

from sensorloom.operators.forest import NODE_SCHEMA, ForestModel
from sensorloom.operators.scaling import Scaler

SCALER_SCHEMA = T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("feature", T.StringType()),
    T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType()),
])
META_SCHEMA = T.StructType([
    T.StructField("sample_size", T.IntegerType()), T.StructField("offset", T.DoubleType()),
    T.StructField("rows", T.LongType()),
])


def model_tables(spark: SparkSession, model: ForestModel) -> dict[str, DataFrame]:
    s = model.scaler
    rows = [(i, f, m, d) for i, (f, m, d) in enumerate(zip(s.features, s.mean, s.std))]
    return {
        "scaler": spark.createDataFrame(rows, SCALER_SCHEMA),
        "forest": spark.createDataFrame(model.nodes, NODE_SCHEMA),
        "meta": spark.createDataFrame([(model.sample_size, model.offset, s.rows)], META_SCHEMA),
    }


def save_model(spark: SparkSession, model: ForestModel, path: str) -> None:
    for name, table in model_tables(spark, model).items():
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def load_model(spark: SparkSession, path: str) -> ForestModel:
    """All three tables are bounded by the number of features and trees."""
    scaler = spark.read.schema(SCALER_SCHEMA).parquet(f"{path}/scaler").orderBy("pos").collect()
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/forest").orderBy("tree", "node").toPandas()
    meta = spark.read.schema(META_SCHEMA).parquet(f"{path}/meta").first()
    return ForestModel(
        Scaler(tuple(r.feature for r in scaler), tuple(r["mean"] for r in scaler),
               tuple(r["std"] for r in scaler), meta.rows),
        nodes, meta.sample_size, meta.offset)
