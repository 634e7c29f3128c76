"""The operators as named queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat
from .common import let, table, text_of, tokenizer_path, words_of
from .decontam import decontaminate
from .html import extract
from .licenses import license_scan
from .lines import drop_repeated_lines
from .oracles import ORACLES as ORACLES
from .pii import KINDS, personal_spans, written
from .quality import quality_rules
from .runs import periodic_runs
from .simhash import near_duplicates
from .suffix import repeated_spans
from .toxicity import toxicity
from .variants import spelling_variants


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"), "n_lines", "n_stop_words")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], turns.schema)
    path = tokenizer_path("byte_bpe_50k.json")
    nodes, leaves = chat.prefix_tree(turns.unionByName(extra), path)
    back = chat.read_conversations(nodes, leaves, path)
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op3_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", F.round("p_low_quality", 6).alias("p_low_quality"), F.round("p_toxic", 6).alias("p_toxic"),
        F.col("rejected").alias("toxic"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digest_tokens(docs, tokenizer_path("byte_bpe_50k.json")).drop("text")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_items", F.array_join(F.col("items").cast("array<string>"), ",").alias("item_ids"),
                        F.round("similarity", 6).alias("similarity"), F.col("leaked").alias("contaminated"))


def op9_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents by the contract of op11: the words of about a tenth of them repeat from one place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)

        def by_place(a: Column) -> Column:
            p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
            return F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p)))

        return F.when(n > 0, F.array_join(let((g % n).cast("int"), by_place), " ")).otherwise("")

    return docs.withColumn("text", F.when(h % 10 == 0, let(words_of(text_of()), repeated)).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.withColumn("best", longest)
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), every=97)


QUERIES = {query.__name__: query for query in (
    op1_quality_rules, op2_chat_format, op3_toxicity_chain, op4_license_scan, op5_simhash_dedup, op6_personal_data, op7_bpe_codec,
    op8_decontamination, op9_repeated_strings, op10_main_text, op11_periodic_runs, op12_line_dedup,
    op13_spelling_variants)}
