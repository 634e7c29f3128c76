"""License scans by diagonal voting.

Every rolling pair of words of every text is hashed and joined to the places of the same pair in
the templates. A hit votes for the diagonal `place in text - place in template`. Votes on one
diagonal, and on diagonals next to each other (words put in or left out), form a span; a span is
verified by the words that hits really share and scored by the part of the template it covers.

The template table is fixed by a parameter and bounded, so the join is a broadcast, and the corpus
side never moves: only hits do. Votes are counted as sets, so repeated rows do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lower_ascii, text_of

#: The four base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Further notices, as found at the head of licensed works, and their labels.
NOTICES = (
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("boost software license", "boost"),
    ("creative commons attribution", "cc-by"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nd", "cc-by-nd"),
    ("all rights reserved", "proprietary"),
    ("released into the public domain", "public-domain"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
)

WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what stands between words once A-Z are small
RAW_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same before that, where A-Z belong to words
K = 2            # words of a rolling hash: the shortest phrase has two
DRIFT = 2        # diagonals this near belong to one span
NEED = 0.75      # part of a template's word pairs that a span must cover


def scan_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), WORDS), "")


def templates(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """One row per place of each template: its hash, its words, and how many places it has."""
    rows = []
    for exact, table in ((True, base), (False, notices)):
        for phrase, label in table:
            words = phrase.split(" ")
            if len(words) < K:
                raise ValueError(f"a template needs {K} words: {phrase}")
            for i in range(len(words) - K + 1):
                rows.append((f"{'base' if exact else 'notice'}:{phrase}", label, exact, i, len(words) - K + 1, words[i:i + K]))
    schema = "template string, label string, exact boolean, at int, places int, pair array<string>"
    table = spark.createDataFrame(rows, schema)
    return table.withColumn("hash", F.xxhash64(F.element_at("pair", 1), F.element_at("pair", 2)))


def hits(docs: DataFrame, table: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """All verified hits: key columns, template columns, and `place` in the text."""
    words = docs.select(*key, scan_words(text_of(text)).alias("_words"))
    # zip_with pads the shorter side with null; the last, half pair is cut off.
    pairs = F.slice(F.zip_with("_words", F.slice("_words", 2, F.size("_words")), lambda a, b: F.xxhash64(a, b)),
                    1, F.greatest(F.size("_words") - 1, F.lit(0)))
    rolled = words.select(*key, "_words", F.posexplode(pairs).alias("place", "hash"))
    found = rolled.join(F.broadcast(table), "hash")  # bounded by the template table
    same = (F.get("_words", F.col("place")) == F.element_at("pair", 1)) & (F.get("_words", F.col("place") + 1) == F.element_at("pair", 2))
    return found.where(same).drop("_words", "hash", "pair")


def spans(votes: DataFrame, key: list[str]) -> DataFrame:
    """Spans: diagonals of one text and template, merged where they are neighbours in drift and place."""
    by = [*key, "template"]
    lines = (votes.withColumn("diagonal", F.col("place") - F.col("at"))
             .groupBy(*by, "label", "exact", "places", "diagonal")
             .agg(F.collect_set("at").alias("covered"), F.min("place").alias("start"), F.max("place").alias("end")))
    order = Window.partitionBy(*by).orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT) | F.col("exact"), F.lit(True))
    groups = lines.withColumn("span", F.sum(apart.cast("int")).over(order))
    return groups.groupBy(*by, "label", "exact", "places", "span").agg(
        F.min("start").alias("start"), (F.max("end") + K).alias("end"),
        F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("votes")).withColumn(
        "score", F.col("votes") / F.col("places"))


def license_spans(docs: DataFrame, key: list[str], text: str = "text", base=BASE, notices=NOTICES, need: float = NEED) -> DataFrame:
    """Verified spans: key, label, exact, start, end (words, end exclusive), score.

    Base phrases count only when whole. Texts that are null or empty have no span.
    """
    found = spans(hits(docs, templates(docs.sparkSession, base, notices), key, text), key)
    return found.where(F.when(F.col("exact"), F.col("votes") == F.col("places")).otherwise(F.col("score") >= need)).drop("span")


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of `docs`: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Rows with equal key and text get equal results; a null key is a key like any other. Columns of
    `docs` other than key and text are not read.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"),
                       F.xxhash64(F.col(key), F.col(text)).alias("_row"))
    found = license_spans(rows, ["_key", "_row"], "_text", **options)
    exact = F.col("exact")
    summary = found.groupBy("_key", "_row").agg(
        F.count(F.when(exact, 1)).alias("n_base"),
        F.min(F.when(exact, F.col("start"))).alias("first_word"), F.max(F.when(exact, F.col("start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(exact, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"))
    counted = rows.select("_key", "_row", F.size(F.array_remove(F.split(text_of("_text"), RAW_WORDS), "")).cast("long").alias("n_words"))
    s = summary.withColumnRenamed("_key", "_k").withColumnRenamed("_row", "_r")
    return counted.join(s, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_row") == F.col("_r")), "left").select(
        F.col("_key").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
