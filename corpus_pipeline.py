"""Documents to tokens in stages; each stage works on all rows that its predecessor kept.

All stages but the last return the columns of `documents`. Null and empty texts pass every stage but the
second, which keeps one of all texts without a word, and end as rows without tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import bpe
from sensorloom.llm.common import table, tokenizer_path
from sensorloom.llm.decontam import drop_leaks
from sensorloom.llm.pii import mask_personal_data
from sensorloom.llm.simhash import keep_first
from sensorloom.llm.toxicity import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = "byte_bpe_50k.json"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the label table, does not reject."""
    return toxicity(docs, table(spark, sf_dir, "labels")).where(~F.col("rejected")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies (fingerprints of four-word shingles, four bits apart at most)."""
    return keep_first(docs, words=4, radius=4).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mask_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; n_chars follows the new text."""
    return mask_personal_data(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents, and whether they decode to the text again."""
    both = bpe.encode_and_decode(docs, tokenizer_path(VOCABULARY))
    return both.select("doc_id", "lang", "source", "n_chars", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("personal data", mask_persons),
    ("bpe tokens", to_tokens),
]

ORACLE_SQL = None  # SQL can express neither the classifier nor the fingerprints; tests/llm holds a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
