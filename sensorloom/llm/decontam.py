"""Benchmark decontamination: rare shingles of items propose, item-sized windows are verified exactly.

1. Items are sets of five-word shingles, rare shingles of the benchmark weighing more than those that many items share.
2. Heads. The heaviest shingles of an item are listed until they weigh more than it may miss. A window that reaches the wanted
   similarity holds one of them for sure, so a text that holds none is done. Shingles that many items share come last and are
   seldom listed; nothing is left out.
3. Each text is compared with the items that it shares a listed shingle with: the weighted part of the item's shingles that
   a window of the item's size holds. A window may be moved right to its first common shingle without losing any, so windows that
   start at common shingles hold the best one, also after words were put in or left out.

Only DataFrame functions run. No fingerprint stands between: equal shingles have close prints, but a part of an item that weighs enough
may be few of its shingles, at any distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_names, let, stored, text_of, words_of

SHINGLE = 5
SIMILARITY = 0.8
BROADCAST = 200_000  # most listed shingles of items that are broadcast; more are shuffled


def shingles(text: Column) -> Column:
    """Hashes of all windows of five words in small letters; a shorter text is one shingle, an empty one none."""
    def joined(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

    def fives(w: Column) -> Column:
        n = F.size(w)
        long = let(joined(w, F.slice(w, 2, n)), lambda two: let(
            joined(two, F.slice(two, 3, n)), lambda four: F.slice(joined(four, F.slice(w, 5, n)), 1, n - (SHINGLE - 1))))
        return (F.when(n >= SHINGLE, long).when(n > 0, F.array(F.xxhash64(w)))
                .otherwise(F.array().cast("array<bigint>")))

    return let(words_of(F.lower(text)), fives)


def _small(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast behind a count; a larger table takes the way Spark chooses."""
    return F.broadcast(table) if rows <= BROADCAST else table


def items_of(benchmark: DataFrame, item: str = "item_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per different item text: item (smallest id), its size, its shingles with weights, heaviest first, and its head."""
    raw = (benchmark.select(F.col(item).alias("item"), shingles(text_of(text)).alias("shingles"))
           .where((F.size("shingles") > 0) & F.col("item").isNotNull()))
    raw = raw.groupBy("shingles").agg(F.min("item").alias("item"))
    each = raw.select("item", F.explode("shingles").alias("h"))
    total = raw.count()
    weight = each.distinct().groupBy("h").agg((1 + F.log(F.lit(float(total)) / F.count("*"))).alias("w"))
    weighted = each.groupBy("item", "h").agg(F.count("*").cast("int").alias("n")).join(weight, "h").groupBy("item").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("w")).alias("order"), "h", "n", "w"))).alias("weighted"))
    return raw.join(weighted, "item").select("item", F.size("shingles").alias("size"), "weighted", head(F.col("weighted"), least).alias("head"))


def weight_of(weighted: Column) -> Column:
    return F.aggregate(weighted, F.lit(0.0), lambda s, x: s + x["w"] * x["n"])


def head(weighted: Column, least: float) -> Column:
    """The first shingles, until they weigh more than a window of similarity `least` may miss."""
    def upto(most: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(weighted, start, lambda s, x: F.struct(
            (s["sum"] + x["w"] * x["n"]).alias("sum"),
            F.when(s["sum"] <= most, F.concat(s["out"], F.array(x["h"]))).otherwise(s["out"]).alias("out")), lambda s: s["out"])

    return let(weight_of(weighted) * (1 - least + 1e-6), upto)


def best_window(every: Column, weighted: Column, size: Column) -> Column:
    """(similarity, back) of the most similar window, the first of equal ones; back is its start, negative.

    Similarity is the weighted part of the item's shingles that the window holds, repeats counted up to those of the item.
    At the end of a text the window is moved inside; a text shorter than the item is one window. Only places of common shingles are
    looked at: one counts in a window that starts after the n-th same place before it, if the item has the shingle n times.
    """
    table = F.map_from_arrays(F.transform(weighted, lambda x: x["h"]), F.transform(weighted, lambda x: F.struct(x["n"], x["w"])))

    def places(h: Column) -> Column:
        found = let(table, lambda t: F.transform(h, lambda v, p: F.struct(p.alias("p"), v.alias("h"), F.try_element_at(t, v).alias("x"))))
        return F.filter(found, lambda y: y["x"].isNotNull())

    def with_rivals(hits: Column) -> Column:
        def one(y: Column) -> Column:
            earlier = F.filter(hits, lambda z: (z["h"] == y["h"]) & (z["p"] < y["p"]))
            rival = let(earlier, lambda e: F.get(e, F.size(e) - y["x"]["n"])["p"])
            return F.struct(y["p"].alias("p"), y["x"]["w"].alias("w"), F.coalesce(rival, F.lit(-1)).alias("rival"))
        return F.transform(hits, one)

    def rated(h: Column) -> Column:
        last = F.greatest(F.lit(0), F.size(h) - size)

        def best(hits: Column) -> Column:
            def of(start: Column) -> Column:
                got = F.aggregate(hits, F.lit(0.0), lambda s, y: s + F.when(
                    (y["p"] >= start) & (y["p"] < start + size) & (y["rival"] < start), y["w"]).otherwise(0.0))
                return F.struct((got / weight_of(weighted)).alias("similarity"), (-start).alias("back"))
            return F.array_max(F.transform(F.array_distinct(F.transform(hits, lambda y: F.least(y["p"], last))), of))

        return let(let(places(h), with_rivals), best)

    return let(every, rated)


def leaks(docs: DataFrame, benchmark: DataFrame, key: list[str], text: str = "text", item: str = "item_id",
          least: float = SIMILARITY) -> DataFrame:
    """Verified pairs: key columns, item, start (word of the text), similarity; the best window of each pair.

    Items without a word or id leak nowhere; items of equal text are one, under their smallest id.
    """
    items = stored(items_of(benchmark, item, least=least))
    n, listed = items.count(), items.select("item", F.explode("head").alias("h"))
    met = docs.select(*key, F.explode(shingles(text_of(text))).alias("h")).join(_small(listed, listed.count()), "h")
    pairs = stored(met.select(*[F.col(k).alias(f"_{k}") for k in key], "item").distinct())
    match = F.lit(True)
    for k in key:  # null keys must meet as well
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    rated = docs.select(*key, F.col(text).alias("_body")).join(pairs, match).join(_small(items, n * 40), "item").withColumn(
        "best", best_window(shingles(text_of("_body")), F.col("weighted"), F.col("size")))
    return rated.where(F.col("best.similarity") >= least - 1e-9).groupBy(*key, "item").agg(
        F.max("best.similarity").alias("similarity"), F.min(-F.col("best.back")).alias("start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of `docs`: key, n_items, items (ids in order), similarity (of the nearest, else null), leaked.

    Null and empty texts leak nothing; rows of equal key and text get equal results. Columns of `docs`
    other than key and text are not read.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(F.col(key), F.col(text)).alias("_row"))
    found = leaks(rows, benchmark, ["_key", "_row"], "_text", **options).groupBy("_key", "_row").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("similarity").alias("similarity"))
    found = found.withColumnRenamed("_key", "_k").withColumnRenamed("_row", "_r")
    return rows.drop("_text").join(found, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_row") == F.col("_r")), "left").select(
        F.col("_key").alias(key), F.coalesce(F.size("items"), F.lit(0)).alias("n_items"),
        F.coalesce("items", F.array().cast(found.schema["items"].dataType)).alias("items"), "similarity", F.col("items").isNotNull().alias("leaked"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that hold no benchmark item; columns, whatever their names, stay as they are."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(F.col(key), F.col(text)).alias("_row"))
    k, r, own = fresh_names(docs, "k", "r", "own")
    bad = leaks(rows, benchmark, ["_key", "_row"], "_text", **options).select(F.col("_key").alias(k), F.col("_row").alias(r)).distinct()
    return docs.withColumn(own, F.xxhash64(F.col(key), F.col(text))).join(
        bad, F.col(key).eqNullSafe(F.col(k)) & (F.col(own) == F.col(r)), "left_anti").select(*docs.columns)
