"""Completeness and range checks, each one pass over the table."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorloom.schema import TELEMETRY_COLUMNS

# Accepted ranges.
TEMP_RANGE = (-20, 120)
VOLTAGE_RANGE = (20, 30)


def _missing(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _share_missing(df: DataFrame, name: str) -> Column:
    return F.avg(_missing(df, name).cast("double")).alias(name)


def _outside(name: str, low, high) -> Column:
    # NaN sorts above every number, so it is excluded by name.
    value = F.col(name).cast("double")
    return ~F.isnan(value) & ((value < low) | (value > high))


def _range_counts() -> list[Column]:
    return [
        F.count_if(F.col("rpm") < 0).alias("rpm_negative"),
        F.count_if(_outside("temp_c", *TEMP_RANGE)).alias("temp_out_of_bounds"),
        F.count_if(_outside("voltage_v", *VOLTAGE_RANGE)).alias("voltage_out_of_bounds"),
    ]


def missing_rates(df: DataFrame) -> DataFrame:
    """Share of missing values per column: (column, missing_rate)."""
    wide = df.agg(*[_share_missing(df, c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "missing_rate")


def range_checks(df: DataFrame) -> DataFrame:
    """Counts of out-of-range readings; missing readings never count."""
    return df.agg(*_range_counts())


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in TELEMETRY_COLUMNS if c not in df.columns]


def validation_report(df: DataFrame) -> DataFrame:
    """Row count, column check, missing shares and range counts as one nested row."""
    absent = missing_columns(df)
    shares = F.struct(*[_share_missing(df, c) for c in df.columns]).alias("missing_rates")
    ranges = [F.lit(None).cast("struct<>").alias("range_checks")] if absent else [
        F.struct(*_range_counts()).alias("range_checks")]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(not absent).alias("schema_valid"),
        F.lit(absent).cast("array<string>").alias("missing_columns"),
        shares, *ranges,
    )
