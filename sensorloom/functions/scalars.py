"""Small column expressions: tags, times, numbers."""

from pyspark.sql import Column, functions as F

# Texts that stand for "no tag" after a file round trip.
MISSING_TAG_LITERALS = ["nan", "None", "NULL", "null"]


def normalize_tag(tag: Column) -> Column:
    """Trimmed tag; missing values and their literal spellings become ''."""
    text = F.trim(F.coalesce(tag.cast("string"), F.lit("")))
    return F.when(text.isin(MISSING_TAG_LITERALS), F.lit("")).otherwise(text)


def label(tag: Column) -> Column:
    """1 where a fault tag is present, else 0."""
    return (normalize_tag(tag) != "").cast("int")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def parse_time(text: Column) -> Column:
    """ISO text to TIMESTAMP (UTC session); null where it cannot be parsed.

    A trailing ``Z`` and numeric offsets are both understood.
    """
    trimmed = F.trim(text.cast("string"))
    return F.try_to_timestamp(F.when(trimmed != "", trimmed))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970, for TIMESTAMP and for naive timestamps in UTC."""
    return F.unix_micros(ts.cast("timestamp"))
