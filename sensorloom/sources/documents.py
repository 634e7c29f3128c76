"""One JSON document as a table of its items, however large the document is.

Written, a document is a folder: its part files, in the order of their names, are the text.  Read, it is cut after every
closing brace, at which files split like at line ends.  What a piece means depends on whether it starts inside a string
and how deep it lies; both are running totals, summed inside a split and over the splits, a short list.  The pieces of an
item are then put together and parsed by themselves.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sensorloom.workspace import materialize

SPLIT = ["_doc", "_file", "_block"]

# A character after a backslash means nothing; what others mean for strings and depth.
ESCAPED = re.compile(rb"\\.", re.DOTALL)
QUOTE = 2
KINDS = np.zeros(256, np.int8)
KINDS[[ord(c) for c in "[{]}"]] = [1, 1, -1, -1]
KINDS[ord('"')] = QUOTE


def write_document(items: DataFrame, opening: str, closing: str, path: str) -> None:
    """Rows (pos, item) in order between ``opening``, which holds no item, and ``closing``; a comma stands before every item but the
    first one, and before that too if ``opening`` ends in one."""
    spark = items.sparkSession
    # Stored, since the first item is looked up before all are sorted.
    rows = materialize(items.select("pos", "item", F.monotonically_increasing_id().alias("_n")), "items")
    first = rows.agg(F.min(F.struct("pos", "item", "_n")).alias("s")).select("s._n").first()[0]
    edge = lambda at, text: spark.range(1).select(
        F.lit(at).alias("_at"), F.lit(None).cast(rows.schema["pos"].dataType).alias("pos"), F.lit(text).alias("item"))
    comma = F.when(F.col("_n").eqNullSafe(F.lit(first)), F.lit("")).otherwise(F.lit(","))
    body = rows.select(F.lit(1).alias("_at"), "pos", F.concat(comma, "item").alias("item"))
    every = edge(0, opening).unionByName(body).unionByName(edge(2, closing))
    # Equal places meet in one range, where their texts decide, as commas are no part of the order.
    (every.repartitionByRange("_at", "pos").sortWithinPartitions("_at", "pos", F.ltrim(F.col("item"), F.lit(",")))
     .select(F.col("item").alias("value")).write.text(path))


def _pieces(spark: SparkSession, path: str, parts: bool) -> DataFrame:
    """Texts between closing braces, in their order inside a split."""
    file = F.col("_metadata.file_path")
    return spark.read.option("lineSep", "}").text(path).select(
        "value", (F.lit("") if parts else file).alias("_doc"), file.alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Slices of batches, each of one split, and whether the split is a new one."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c) for c in SPLIT]
        ends = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            ends |= pc.not_equal(k.slice(1), k.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(ends) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:]):
            here = tuple(k[start].as_py() for k in keys)
            yield batch.slice(start, end - start), here != last
            last = here


def _marks(text: bytes, quotes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotes and brackets, what each adds to the depth, and the quotes up to it, of which there were ``quotes`` before."""
    codes = np.frombuffer(ESCAPED.sub(b"  ", text) if b"\\" in text else text, np.uint8)
    kinds = KINDS[codes]
    at = np.flatnonzero(kinds)
    found = kinds[at]
    return at, np.where(found == QUOTE, 0, found), quotes + np.cumsum(found == QUOTE)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice of a split: its pieces and quotes, and how much deeper it ends if the split starts outside (0) or inside (1) of a string."""
    quotes = 0
    for batch, new in _by_split(batches):
        quotes = 0 if new else quotes
        values = batch.column("value").to_pylist()
        _, steps, upto = _marks("}".join([*values, ""]).encode(), quotes)
        before, quotes = quotes, int(upto[-1])
        first = values[0].lstrip(" ")[:1] if new else None
        numbers = [len(values), quotes - before, *(int(steps[upto % 2 == k].sum()) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(0, 1) for c in SPLIT], pa.array([first], pa.string()),
                                          *[pa.array([n], pa.int64()) for n in numbers]], names=[*SPLIT, "_first", "_n", "_quotes", "_d0", "_d1"])


def _states(pieces: DataFrame, below: dict[str, int]) -> DataFrame:
    """Each split with what holds at its start: ``_in`` a string or not, ``_depth``; of its document the first character
    ``kind`` and the depth ``_level`` at which items lie; and how many pieces it has, if it is the last of its file.
    Documents that do not end where they began have none."""
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in SPLIT)
    splits = pieces.mapInArrow(_summaries, f"{keys}, _first string, _n long, _quotes long, _d0 long, _d1 long")
    splits = splits.groupBy(*SPLIT).agg(F.first("_first", True).alias("_first"), *[F.sum(c).alias(c) for c in ("_n", "_quotes", "_d0", "_d1")])
    doc, file = Window.partitionBy("_doc"), Window.partitionBy("_doc", "_file")
    before = doc.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    # The last piece of a file has no closing brace, or that of the document itself.
    splits = splits.withColumns({"_last": F.when(F.col("_block") == F.max("_block").over(file), F.col("_n")),
                                 "_in": F.coalesce(F.sum("_quotes").over(before), none) % 2})
    open_end = F.when(F.col("_last").isNotNull() & ((F.col("_in") + F.col("_quotes")) % 2 == 0), 1).otherwise(0)
    splits = splits.withColumn("_grown", F.when(F.col("_in") == 0, F.col("_d0")).otherwise(F.col("_d1")) + open_end)
    splits = splits.withColumns({
        "_depth": F.coalesce(F.sum("_grown").over(before), none), "_end": F.sum("_grown").over(doc), "_all": F.sum("_quotes").over(doc),
        "kind": F.first("_first").over(doc.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    level = F.when(F.col("kind") == "[", below["["]).when(F.col("kind") == "{", below["{"]).cast("long")
    whole = (F.col("_all") % 2 == 0) & ((F.col("_end") == 0) | (F.col("_end") == 1) & (F.col("kind") == "{"))
    return splits.withColumn("_level", level).where(whole & level.isNotNull()).select(*SPLIT, "_in", "_depth", "_last", "kind", "_level")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a split up to each object at the level of items, numbered ``_k``: the depth ``start`` at which one begins and
    ``_end``, null for what the split leaves open."""
    quotes = depth = start = k = seen = 0
    text, keys = b"", None

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))]
        return pa.RecordBatch.from_arrays([*[pa.array([v] * len(found), t) for v, t in keys], *columns],
                                          names=[*SPLIT, "kind", "_level", "_k", "text", "start", "_end"])

    for batch, new in _by_split(batches):
        of = lambda name: batch.column(name)[0].as_py()
        if new:
            if text:
                yield rows([(k, text.decode("utf-8", "replace"), start, None)])
            quotes, depth, start, k, seen, text = of("_in"), of("_depth"), of("_depth"), 0, 0, b""
            keys = [(of(c), batch.schema.field(c).type) for c in (*SPLIT, "kind", "_level")]
        seen += batch.num_rows
        open_end = of("_last") is not None and of("_last") == seen
        fresh = "}".join([*batch.column("value").to_pylist(), *([] if open_end else [""])]).encode()
        at, steps, upto = _marks(fresh, quotes)
        outside = upto % 2 == 0
        depths = depth + np.cumsum(np.where(outside, steps, 0))
        codes = np.frombuffer(fresh, np.uint8)[at]
        cuts = np.flatnonzero((codes == ord("}")) & outside & (depths <= of("_level")))
        found, done = [], 0
        for i in cuts.tolist():
            end = int(at[i]) + 1
            found.append((k, (text + fresh[done:end]).decode("utf-8", "replace"), start, int(depths[i])))
            text, done, start, k = b"", end, int(depths[i]), k + 1
        text += fresh[done:]
        if len(at):
            quotes, depth = int(upto[-1]), int(depths[-1])
        if found:
            yield rows(found)
    if text:
        yield rows([(k, text.decode("utf-8", "replace"), start, None)])


def _groups(spark: SparkSession, path: str, below: dict[str, int], parts: bool) -> DataFrame:
    """The text of a document in parts that end with an object at the level of items: _doc, pos, kind, text, and the depth ``start``
    at which it begins."""
    pieces = _pieces(spark, path, parts)
    rows = pieces.join(F.broadcast(_states(pieces, below)), SPLIT)
    keys = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (*SPLIT, "kind", "_level"))
    runs = materialize(rows.mapInArrow(_runs, f"{keys}, _k long, text string, start long, _end long"), "runs")
    # What a split leaves open goes on in the next one.
    before = Window.partitionBy("_doc").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    cuts = runs.groupBy(*SPLIT).agg(F.count("_end").alias("_n")).select(
        *SPLIT, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = runs.join(F.broadcast(cuts), SPLIT).withColumn("pos", F.col("_before") + F.col("_k"))
    place = F.struct("_file", "_block")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_file", "_block", "text"))), lambda p: p["text"]), "")
    groups = joined.groupBy("_doc", "kind", "_level", "pos").agg(whole.alias("text"), F.min_by("start", place).alias("start"), F.max("_end").alias("_end"))
    return groups.where(F.col("_end") == F.col("_level")).drop("_end", "_level")


def objects(items: Column) -> Column:
    """Elements that are objects; others are dropped before positions are given."""
    return F.filter(items, lambda x: F.ltrim(x).startswith("{"))


def _at_depth(*openings: str) -> Column:
    """What makes JSON of a text that begins at depth 0, 1, ..."""
    return F.element_at(F.array(*[F.lit(o) for o in openings]), F.col("start").cast("int") + 1)


def _closed(opening: Column, closing: str) -> Column:
    return F.concat(opening, F.col("text"), F.lit(closing))


def read_list(spark: SparkSession, path: str, key: str, parts: bool = False) -> DataFrame:
    """Objects (pos, item) of a document that is a list, or an object whose ``key`` holds one.

    Every file is a document, or, with ``parts``, all of them are one in the order of their names; such a file ends in a line feed.
    """
    last = lambda items: F.try_element_at(objects(items), F.lit(-1))
    listed = lambda opening: last(F.from_json(_closed(opening, "]"), "array<string>"))
    keyed = last(F.from_json(_closed(_at_depth("", '{"":0', '{"":[0'), "]}"), f"struct<`{key}`:array<string>>")[key])
    groups = _groups(spark, path, {"[": 1, "{": 2}, parts)
    in_list, goes_on = F.col("kind") == "[", (F.col("kind") == "{") & (F.col("start") == 2)
    found = groups.withColumn("item", F.when(in_list, listed(_at_depth("", "[0"))).when(goes_on, listed(F.lit("[0"))))
    # A text of an object that does not go on with the list before it names another key.
    found = found.withColumn("_turns", ~in_list & F.col("item").isNull())
    found = found.withColumn("item", F.when(F.col("_turns"), keyed).otherwise(F.col("item"))).select("_doc", "pos", "kind", "_turns", "item")
    found = materialize(found, "listed")
    turns = found.where("_turns")
    start = turns.where("item IS NOT NULL").groupBy("_doc").agg(F.max("pos").alias("_first"))
    # One row for each document, as few as files; a join by document would gather one in a task.
    end = turns.join(F.broadcast(start), "_doc").where("pos > _first").groupBy("_doc").agg(F.min("pos").alias("_next"))
    rows = found.join(F.broadcast(start), "_doc", "left").join(F.broadcast(end), "_doc", "left")
    of_key = (F.col("pos") >= F.col("_first")) & (F.col("_next").isNull() | (F.col("pos") < F.col("_next")))
    return rows.where(F.col("item").isNotNull() & ((F.col("kind") == "[") | of_key)).select(
        F.when(F.col("kind") == "[", F.col("pos")).otherwise(F.col("pos") - F.col("_first")).alias("pos"), "item")


def read_keyed(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """Objects (pos, key, item) of a document that is an object of objects, or a list of them without keys; files as in ``read_list``."""
    listed = F.try_element_at(objects(F.from_json(_closed(_at_depth("", "[0"), "]"), "array<string>")), F.lit(-1))
    entries = F.map_entries(F.from_json(_closed(_at_depth("", '{"":0'), "}"), "map<string,string>"))
    keyed = F.try_element_at(F.filter(entries, lambda e: F.ltrim(e.value).startswith("{")), F.lit(-1))
    shape = lambda key, item: F.struct(key.alias("key"), item.alias("item"))
    found = _groups(spark, path, {"[": 1, "{": 1}, parts).select(
        "pos", F.when(F.col("kind") == "[", shape(F.lit(None).cast("string"), listed)).otherwise(shape(keyed["key"], keyed["value"])).alias("e"))
    return found.select("pos", "e.key", "e.item").where("item IS NOT NULL")
