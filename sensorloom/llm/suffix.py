"""Exact removal of repeated byte strings, by distributed prefix doubling over anchors.

Every byte that a string of `length` bytes covers is removed if that string also starts elsewhere.

Sorting all byte positions would move dozens of bytes for each byte of the corpus. So positions are thinned
without loss first: each window of `length` bytes has one anchor, the place of the smallest hash of
its `unit`-byte strings. Equal windows have their anchor at the same offset, so only anchors need ranks.

Round by round the ranked strings around an anchor grow, as in prefix doubling: the rank of the longer
string is that of the pair (rank so far, the bytes that are new). A round names each rank by a digest of
its string, and counts it over the whole corpus:

* offsets between window and anchor are kept as ranges. All windows of a range share their core, and
  the whole they span is their block;
* a core that stands once is unique: none of its windows repeats, and the range is dropped;
* a block that stands twice repeats with all its windows: the range is settled as removed. One row
  of each block stays behind as a witness for ranges that only overlap it;
* any other range is cut into `FAN` parts, whose cores are longer, until it is one window and its core
  is `length` bytes.

A narrow Arrow pass finds anchors (about two in 300 bytes) and the first ranks; only ranges still open
after it carry their bytes. Counts are combined before they are shuffled and joined back in sort-merge
joins that Spark splits, so a passage that a third of all documents share stays spread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

LENGTH = 400
UNIT = 64          # bytes of the strings whose hashes choose anchors
FAN = 19           # parts of a range
PIECE = 1 << 18    # bytes of a long text that are hashed at a time

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashes:
    """Rolling hashes of all `unit`-byte strings, by prefix sums modulo 2 ** 64."""

    def __init__(self, unit: int, most: int):
        self.unit, most = unit, most + unit
        self.table = np.array([xxhash.xxh64_intdigest(bytes([b]), 1) for b in range(256)], np.uint64)
        self.up, self.down = _powers(_MULTIPLIER, most), _powers(_INVERSE, most)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:len(data)], out=sums[1:])
        h = (sums[self.unit:] - sums[:-self.unit]) * self.down[:len(data) - self.unit + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of every run of `width` keys: prefix minima of a block meet suffix minima of the one before."""
    n = len(keys)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - width + 1], before[width - 1:n])


def anchors(data: np.ndarray, hashes: Hashes, length: int) -> np.ndarray:
    """Rows (anchor, first window, last window): the windows, in a row, whose leftmost smallest hash is at the anchor.

    Long texts are taken in overlapping pieces, so memory does not grow with them.
    """
    width = length - hashes.unit + 1
    found = []
    windows = len(data) - length + 1
    low = np.uint64((1 << 20) - 1)
    for at in range(0, max(0, windows), PIECE):
        part = data[at:min(at + PIECE, windows) + length - 1]
        h = hashes(part)
        keys = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # ties go to the left
        best = (sliding_minimum(keys, width) & low).astype(np.int64)
        head = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
        tail = np.r_[head[1:], len(best)] - 1
        found.append(np.stack([best[head], head, tail], 1) + at)
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.concatenate(found)
    # A border between pieces may cut the windows of one anchor in two.
    head = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
    return np.stack([rows[head, 0], rows[head, 1], rows[np.r_[head[1:], len(rows)] - 1, 2]], 1)


def _digest(piece: bytes, salt: int) -> int:
    """A name for a string and the place it has in its range, as a signed long."""
    value = xxhash.xxh3_64_intdigest(piece, salt)
    return value - (1 << 64) if value >> 63 else value


def _block(text: bytes, x: int, a: int, b: int, length: int) -> int:
    """Name of what windows that start a..b bytes before x span, cut at the ends of the text, and of the cuts."""
    start, end = max(0, x - b), min(len(text), x - a + length)
    return _digest(text[start:end], 1 + (x - start) * 4096 + (end - x))


_RANKED = "row binary, at long, low int, high int, settled boolean, core long, block long"
_TYPES = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]


def _ranked(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split(" ")[0] for x in _RANKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=names)


def first_ranks(docs: DataFrame, length: int, unit: int) -> DataFrame:
    """Anchors of all texts: row, at, low..high (offsets of its windows), names of core and block."""
    reach = length - unit

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(unit, PIECE + length)
        for part in parts:
            for r, value in zip(part.column(0), part.column(1), strict=True):
                row, text = r.as_py(), value.as_py()
                found = anchors(np.frombuffer(text, np.uint8), hashes, length).tolist()
                if found:
                    yield _ranked([(row, x, x - last, x - first, False, _digest(text[x:x + unit], 0),
                                    _block(text, x, 0, reach, length)) for x, first, last in found])

    return docs.select("row", "bytes").mapInArrow(batches, _RANKED)


def next_ranks(held: DataFrame, length: int, step: int) -> DataFrame:
    """Each open range cut at multiples of `step`, the same for all anchors: the new, longer cores and their blocks.

    held: row, at, low, high, settled, left, context (the bytes from `left` before the anchor to `length` after it).
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: list[tuple] = []
            for row, at, low, high, settled, left, context in zip(*[c.to_pylist() for c in part.columns], strict=True):
                for a in range(low // step * step, high + 1, step):
                    b = a + step - 1
                    core = _digest(context[left - a:left - b + length], 1 + a * 4096 + step)
                    out.append((row, at, max(low, a), min(high, b), settled, core, _block(context, left, a, b, length)))
                if len(out) >= 4096:
                    yield _ranked(out)
                    out = []
            if out:
                yield _ranked(out)

    return held.select("row", "at", "low", "high", "settled", "left", "context").mapInArrow(batches, _RANKED)


def _judged(ranked: DataFrame) -> DataFrame:
    """Rows whose core stands more than once, with `repeats` (the block does too) and `stays` (needed in the next round)."""
    name = F.xxhash64("row", "at", "low")
    # Stored, so that both joins below have plain exchanges on either side, which Spark can split where a core is hot.
    by_block = stored(ranked.groupBy("core", "block").agg(F.count("*").alias("same"), F.min(name).alias("first")))
    by_core = stored(by_block.groupBy("core").agg(F.sum("same").alias("total"), F.count("*").alias("kinds")).where("total > 1"))
    known = by_block.where("same > 1").select("core", "block", "first")
    judged = ranked.join(by_core.select("core", "kinds"), "core").join(known, ["core", "block"], "left")
    repeats = F.col("first").isNotNull()
    return judged.select("row", "at", "low", "high", "settled", repeats.alias("repeats"),
                         (~repeats | (F.col("first") == name) & (F.col("kinds") > 1)).alias("stays"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, unit: int = UNIT) -> DataFrame:
    """Byte ranges (row, start, end) of `docs` (row, bytes) that repeated strings cover; they may overlap."""
    reach, step = length - unit, length - unit + 1
    ranked, contexts, removed = stored(first_ranks(docs, length, unit)), None, []
    while True:
        state = stored(_judged(ranked))
        # At the last step a block is the window itself; a row that was settled before is only a witness.
        removed.append(state.where("repeats AND NOT settled").select(
            "row", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("end")))
        if step == 1:
            break
        step = -(-step // FAN)
        live = state.where("stays").select("row", "at", "low", "high", (F.col("settled") | F.col("repeats")).alias("settled"))
        if contexts is None:
            contexts = stored(_contexts(docs, live.groupBy("row").agg(F.collect_set("at").alias("anchors")), length, reach))
        ranked = stored(next_ranks(live.join(contexts, ["row", "at"]), length, step))
    out = removed[0]
    for more in removed[1:]:
        out = out.union(more)
    return out


def _contexts(docs: DataFrame, live: DataFrame, length: int, reach: int) -> DataFrame:
    """The bytes that windows of open anchors may hold: row, at, left, context."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r, value, found in zip(*part.columns, strict=True):
                row, text = r.as_py(), value.as_py()
                all_at = found.as_py()
                for k in range(0, len(all_at), 4096):
                    at = all_at[k:k + 4096]
                    left = [min(x, reach) for x in at]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row] * len(at), pa.binary()), pa.array(at, pa.int64()), pa.array(left, pa.int32()),
                        pa.array([text[x - n:x + length] for x, n in zip(at, left, strict=True)], pa.binary())],
                        names=["row", "at", "left", "context"])

    # Repeated rows have one name and equal texts; one of them is enough.
    bodies = docs.join(live, "row").select("row", "bytes", "anchors")
    return bodies.mapInArrow(batches, "row binary, at long, left int, context binary").dropDuplicates(["row", "at"])


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of `docs`: key, n_bytes, n_removed, spans (array of start, end: maximal removed runs), kept (bytes).

    Texts are UTF-8 bytes, null counts as empty, and matches never cross texts. Repeated rows are copies of each
    other, so their text goes as far as it is long enough. A null key is a key like any other.
    """
    # Rows need a name of their own: equal rows are two texts. The count of equal rows makes it.
    own = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    body = own.withColumn("row", F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("_key").cast("string"), F.lit("null")), F.md5(F.col("_text").cast("binary"))))))
    numbered = body.select("_key", "row", F.col("_text").cast("binary").alias("bytes"))
    return _spans(numbered, key, length)


def _spans(numbered: DataFrame, key: str, length: int) -> DataFrame:
    ranges = repeated_ranges(numbered.select("row", "bytes"), length)
    per_row = ranges.distinct().groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    joined = numbered.join(per_row, "row", "left").select("_key", "bytes", "ranges")
    key_type = numbered.schema["_key"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, gone, spans, kept = [], [], [], []
            for value, found in zip(part.column(1), part.column(2), strict=True):
                data, runs = value.as_py(), _union(found.as_py() or [])
                pieces, at = [], 0
                for start, end in runs:
                    pieces.append(data[at:start])
                    at = end
                pieces.append(data[at:])
                sizes.append(len(data))
                gone.append(sum(e - s for s, e in runs))
                spans.append([{"start": s, "end": e} for s, e in runs])
                kept.append(b"".join(pieces))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=[key, "n_bytes", "n_removed", "spans", "kept"])

    return joined.mapInArrow(batches, f"{key} {key_type}, n_bytes long, n_removed long, "
                                      "spans array<struct<start:bigint,end:bigint>>, kept binary")


def _union(ranges: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((r["start"], r["end"]) for r in ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out

