"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.workspace import materialize

#: White space of the word rules below: the blank and the five controls from tab to return.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row, however often `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_of(name: str = "text") -> Column:
    """The column as text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of other characters than `BLANKS`."""
    return F.array_remove(F.split(text, BLANKS), "")


def lower_ascii(text: Column) -> Column:
    """Only A-Z become small."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(df: DataFrame) -> DataFrame:
    """Write once to the folder that the cluster shares and read back: cuts the lineage and survives lost executors."""
    return materialize(df, "corpus")


def tokenizer_path(name: str) -> str:
    """Default place of a public vocabulary file; operators take another path as a parameter."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Names for internal columns that no column of `df` has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
