"""Repeated lines: Bloom filters find suspects, which alone are counted exactly.

1. A narrow Arrow pass names every line that may be dropped by 128 bits of its key. A batch of documents
   knows which of its names two of its documents share: their lines are suspects at once, and one entry, marked as
   seen twice, stands for them. All other names are one entry each, so a line that a third of all documents hold is
   an entry a batch.
2. Entries go to segments of the space of names. A segment streams them through two Bloom filters: a name that
   the first has seen enters the second. Then the second is asked for every entry; what it knows is a suspect too.
   Segments follow from the size of the texts, so that their filters and entries stay small.
3. Only suspects, a name and a key of a document each, are shuffled for the exact count of their documents and for the
   largest key, and the lines to drop go back to their documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

LEAST = 40           # code points of a key that may be dropped
COPIES = 5           # documents that hold it
SEGMENT = 1 << 18    # entries of a segment at most, about
BITS = 16            # of either filter for an entry
PROBES = 5
SPACE = b" \t\n\x0b\x0c\r"
NAME = np.dtype([("low", "<u8"), ("high", "<u8")])
ONCE, TWICE, SUSPECT = 0, 1, 2


def line_key(line: bytes, least: int) -> bytes | None:
    """Stripped and in small letters; None for a line that always stays."""
    if len(line) < least:
        return None
    key = line.strip(SPACE).lower()  # on bytes both act on ASCII alone
    long = len(key) >= least and (key.isascii() or len(key.decode(errors="replace")) >= least)
    return key if long else None


def names_of(text: bytes, least: int) -> set[bytes]:
    keys = (line_key(line, least) for line in text.split(b"\n"))
    return {xxhash.xxh3_128_digest(key) for key in keys if key is not None}


class Bloom:
    """A filter of names; the bits of a name come from its two halves."""

    def __init__(self, entries: int):
        self.size = max(64, entries * BITS)
        self.bits = np.zeros(self.size, bool)

    def places(self, names: np.ndarray) -> np.ndarray:
        steps = np.arange(PROBES, dtype=np.uint64)
        return (names["low"][:, None] + steps * (names["high"][:, None] | np.uint64(1))) % np.uint64(self.size)

    def add(self, names: np.ndarray) -> None:
        self.bits[self.places(names)] = True

    def has(self, names: np.ndarray) -> np.ndarray:
        return self.bits[self.places(names)].all(1)


def entries(docs: DataFrame, least: int, segments: int) -> DataFrame:
    """Of `docs` (key, bytes): segment, role, names (16 bytes each) and keys.

    ONCE: names that one document of a batch holds, and its key. TWICE: names that several do. SUSPECT: those names with
    all their keys.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, first, found = part.column(0), {}, set()
            for i, (k, value) in enumerate(zip(ids.to_pylist(), part.column(1), strict=True)):
                own = first.setdefault(k, i)  # rows of one key are one document
                found.update((name, own) for name in names_of(value.as_py(), least))
            if not found:
                continue
            names = np.frombuffer(b"".join(name for name, _ in found), NAME)
            owner = np.fromiter((own for _, own in found), np.int64, len(found))
            order = np.lexsort((names["high"], names["low"]))
            names, owner = names[order], owner[order]
            new = np.r_[True, names[1:] != names[:-1]]
            alone = new & np.r_[new[1:], True]
            segment = (names["high"] % np.uint64(segments)).astype(np.int64)
            out = [(-1, SUSPECT, np.flatnonzero(~alone))]
            for role, chosen in ((ONCE, np.flatnonzero(alone)), (TWICE, np.flatnonzero(new & ~alone))):
                chosen = chosen[np.argsort(segment[chosen], kind="stable")]
                cuts = np.flatnonzero(np.diff(segment[chosen])) + 1
                out += [(int(segment[rows[0]]), role, rows) for rows in np.split(chosen, cuts) if len(rows)]
            out = [x for x in out if len(x[2])]
            held = [ids.take(pa.array(owner[rows] if role != TWICE else owner[:0])) for _, role, rows in out]
            bounds = np.r_[0, np.cumsum([len(x) for x in held])].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _, _ in out], pa.int64()), pa.array([r for _, r, _ in out], pa.int32()),
                 pa.array([names[rows].tobytes() for *_, rows in out], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.concat_arrays(held))], names=["segment", "role", "names", "keys"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(batches, f"segment long, role int, names binary, keys array<{kind}>")


def _rows(names: np.ndarray, keys: pa.Array) -> pa.Table:
    return pa.table({"name": pa.array([names[i:i + 1].tobytes() for i in range(len(names))], pa.binary()), "key": keys})


def suspects(found: DataFrame) -> DataFrame:
    """Names that may stand in two documents, each with the key of a document: name, key."""
    kind = found.schema["keys"].dataType.elementType.simpleString()

    def judge(group: pa.Table) -> pa.Table:
        """Entries of one segment; those of one row are different names."""
        rows = [(role, np.frombuffer(names, NAME)) for role, names in
                zip(group.column("role").to_pylist(), group.column("names").to_pylist(), strict=True)]
        n = sum(len(names) for _, names in rows)
        once, twice = Bloom(n), Bloom(n)
        for role, names in rows:
            twice.add(names if role == TWICE else names[once.has(names)])
            once.add(names)
        hit, chosen = [], []
        for i, (role, names) in enumerate(rows):
            if role == ONCE and (some := np.flatnonzero(twice.has(names))).size:
                hit.append(names[some])
                chosen.append(group.column("keys")[i].values.take(pa.array(some)))
        nothing = group.column("keys").combine_chunks().values[:0]
        return _rows(np.concatenate(hit) if hit else np.empty(0, NAME), pa.concat_arrays(chosen) if chosen else nothing)

    def unpacked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for names, keys in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                yield from _rows(np.frombuffer(names, NAME), keys.values).to_batches()

    out = f"name binary, key {kind}"
    sure = found.where(F.col("role") == SUSPECT).select("names", "keys").mapInArrow(unpacked, out)
    return found.where(F.col("role") != SUSPECT).groupBy("segment").applyInArrow(judge, out).unionByName(sure)


def lines_to_drop(docs: DataFrame, least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """Names of the lines that documents lose: key, names. `docs` (key, bytes) has no null key."""
    size = docs.agg(F.sum(F.octet_length("bytes").cast("long"))).first()[0] or 0
    segments = max(1, -(-size // (least * SEGMENT)))
    suspected = stored(suspects(stored(entries(docs, least, segments))))
    counted = suspected.groupBy("name").agg(F.count_distinct("key").alias("n"), F.max("key").alias("keeper"))
    confirmed = stored(counted.where(F.col("n") >= copies).select("name", "keeper"))
    return suspected.join(confirmed, "name").where("key <> keeper").groupBy("key").agg(F.collect_set("name").alias("names"))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """One row per row of `docs`: key, n_lines, n_dropped, kept (text).

    A line whose key has `least` code points and stands in `copies` documents stays only in the document of the largest key, there as
    often as it stands. Null and empty texts are one empty line. Rows of equal key are one document; a row
    without a key counts for no line and stays whole. Other columns of `docs` are not read; an empty table gives an empty one.
    """
    source = docs.select(F.col(key).alias("key"), text_of(text).cast("binary").alias("bytes"))
    lost = stored(lines_to_drop(source.where(F.col("key").isNotNull()), least, copies))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            total, gone, kept = [], [], []
            for value, names in zip(part.column(1), part.column(2), strict=True):
                data, dropped = value.as_py(), set(names.as_py() or ())
                n = stays = data.count(b"\n") + 1
                if dropped:
                    lines = [line for line in data.split(b"\n") if not _is_named(line, least, dropped)]
                    data, stays = b"\n".join(lines), len(lines)
                total.append(n)
                gone.append(n - stays)
                kept.append(data)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                                             names=["key", "n_lines", "n_dropped", "kept"])

    kind = source.schema["key"].dataType.simpleString()
    # Texts meet their lists in a shuffle at every size; lists grow with the corpus, so they are no broadcast side.
    done = source.join(lost.hint("merge"), "key", "left").select("key", "bytes", "names").mapInArrow(
        batches, f"key {kind}, n_lines long, n_dropped long, kept binary")
    return done.select(F.col("key").alias(key), "n_lines", "n_dropped", F.col("kept").cast("string").alias("kept"))


def _is_named(line: bytes, least: int, names: set[bytes]) -> bool:
    key = line_key(line, least)
    return key is not None and xxhash.xxh3_128_digest(key) in names
