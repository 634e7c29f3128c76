"""Near-duplicates by SimHash: bit planes, carry-save counters, and blocks that are given up early.

1. A narrow Arrow pass gives each text a 64-bit fingerprint; equal fingerprints become one row.
2. The 64 bits fall into six parts. Two fingerprints within four bits agree on two parts at
   least, so each goes to one bucket per pair of parts (15), and every pair within the radius
   meets in a bucket. Longer radii take more parts in the same way.
3. A bucket above `block` rows is cut into blocks, and each pair of blocks is a task of its own, so a
   group of copies, however large, is spread and no two of its rows are compared twice.
4. Inside a task, bit planes of a block lie vertically: one machine word holds the same bit of 64
   fingerprints. A query is compared with all lanes at once; differing bits are added up in
   carry-save counters that stop at the radius, and a block is given up as soon as every lane has
   passed it. What leaves a task is a spanning forest of its links, never all pairs.
5. Components join the forests; rows with equal fingerprints share the component.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .common import fresh_names, stored

BITS = 64
SEED = 42
BLOCK = 4096
COMPANY = 64  # random fingerprints in a bucket, on average at most
SMALL = 24  # buckets up to this size share one comparison of all their pairs


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """Hashes of all shingles in order of the text; a shorter text is one shingle, a text without a word has none."""
    tokens = text.encode().lower().split()  # on bytes both act on ASCII alone
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    starts = np.zeros(len(tokens) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in tokens], out=starts[1:])
    n = max(1, len(tokens) - words + 1)
    last = starts[min(words, len(tokens)):] - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)), np.uint64, n)


def fingerprint(text: str, words: int) -> int:
    """Majority of the bits of the shingles' hashes; no word gives zero."""
    hashes = shingle_hashes(text, words)
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 8192):
        ones += np.unpackbits(hashes[at:at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4) -> DataFrame:
    """All of `docs` but the text, plus `fp` (long). A null text counts as empty."""
    rest = [c for c in docs.columns if c not in (text, "fp")]
    source = docs.select(*rest, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    out = source.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            column = part.column(part.num_columns - 1)
            fps = [fingerprint(column[i].as_py(), words) for i in range(part.num_rows)]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(signed)], names=out.names)

    return source.mapInArrow(batches, out)


def buckets(fp: Column, radius: int, parts: int | None = None) -> Column:
    """Keys of the buckets of a fingerprint: all choices of `parts - radius` parts.

    Two fingerprints within the radius differ in at most `radius` parts, so some choice of the
    others has no difference.
    """
    parts = parts or radius + 2
    cuts = [BITS * i // parts for i in range(parts + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    keys = []
    for k, chosen in enumerate(combinations(masks, parts - radius)):
        mask = functools.reduce(lambda a, b: a | b, chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(k).alias("k"), fp.bitwiseAND(F.lit(signed).cast("long")).alias("key")))
    return F.array(*keys)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes, highest bit first: row b holds bit b of all values, 64 lanes to a word."""
    lanes = -(-len(values) // 64) * 64
    bits = np.zeros((lanes, BITS), np.uint8)
    bits[:len(values)] = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(differences: Iterator[np.ndarray] | np.ndarray, radius: int, words: int, rows: int = 1) -> np.ndarray:
    """Lanes with at most `radius` set bits over all planes, as booleans.

    Counters are bit planes too: adding a plane ripples a carry through them. `over` marks lanes
    that have passed the radius; once all have, the rest of the planes is left out.
    """
    width = radius.bit_length() + 1
    counters = [np.zeros((rows, words), np.uint64) for _ in range(width)]
    over = np.zeros((rows, words), np.uint64)
    limit = radius + 1
    for b, carry in enumerate(differences):
        carry = carry & ~over  # lanes that are out stay out and no longer count
        for c in counters:
            carry, c[...] = c & carry, c ^ carry
        over |= carry  # a carry out of the highest counter is past the radius too
        if b % 4 == 3 or b == BITS - 1:
            # Counts grow by one a plane, so a lane meets `limit` .. `limit + 3` before it is tested.
            for reached in range(limit, limit + 4):
                if reached >> width:
                    break
                same = ~np.zeros((rows, words), np.uint64)
                for i, c in enumerate(counters):
                    same &= c if reached >> i & 1 else ~c
                over |= same
            if b > 2 * radius and (over == ~np.uint64(0)).all():
                break
    bits = np.unpackbits((~over).view(np.uint8).reshape(rows, -1), axis=1, bitorder="little")
    return bits.astype(bool)


class Forest:
    """Union-find over the rows of one task; keeps the smallest place of each tree as its root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def links_between(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks (or inside one), as places in left then right."""
    n = len(left)
    everything = left if same else np.concatenate([left, right])
    stored_planes = planes(right)
    words = stored_planes.shape[1]
    trees, out = Forest(len(everything)), []
    queries = planes(left)
    ones = ~np.uint64(0)
    step = max(1, 16384 // words)
    for at in range(0, n, step):
        rows = np.arange(at, min(at + step, n))
        bits = (queries[:, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
        flips = (np.uint64(0) - bits)[:, :, None] & ones
        hit = within((stored_planes[b][None, :] ^ flips[b] for b in range(BITS)), radius, words, len(rows))[:, :len(right)]
        i, j = np.nonzero(hit)
        i = i + at
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        else:
            j = j + n
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if trees.join(a, b):
                out.append((a, b))
    return out


def links_in_small(values: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """Places (i, j) of all links inside groups of at most `SMALL` rows that stand together."""
    found = []
    for shift in range(1, SMALL):
        i = np.flatnonzero(group[:-shift] == group[shift:]) if shift < len(group) else np.empty(0, int)
        if not len(i):
            break
        for at in range(0, len(i), BLOCK):
            lanes = i[at:at + BLOCK]
            p = planes(values[lanes] ^ values[lanes + shift])
            hit = within((row[None, :] for row in p), radius, p.shape[1])[0, :len(lanes)]
            found.append(np.stack([lanes[hit], lanes[hit] + shift], 1))
    return np.concatenate(found) if found else np.empty((0, 2), int)


def _links(rows: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (k, key, i, j, side): runs of one task (k, key, i, j) at a time."""
    def emit(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    held: list[np.ndarray] = []

    def work(block: np.ndarray) -> Iterator[pa.RecordBatch]:
        """block: columns k, key, i, j, side, fp, id."""
        head = np.flatnonzero(np.r_[True, (block[1:, :4] != block[:-1, :4]).any(1)])
        size = np.diff(np.r_[head, len(block)])
        group = np.repeat(np.arange(len(head)), size)
        fps, ids = block[:, 5].copy().view(np.uint64), block[:, 6]
        few = np.repeat((size <= SMALL) & (size > 1), size) & (block[:, 2] == block[:, 3])
        if few.any():
            pairs = links_in_small(fps[few], group[few], radius)
            if len(pairs):
                yield emit(np.sort(ids[few][pairs], axis=1))
        for g in np.flatnonzero((size > SMALL) | (block[head, 2] != block[head, 3])):
            rows = slice(head[g], head[g] + size[g])
            side, f, n = block[rows, 4], fps[rows], ids[rows]
            same = bool(block[head[g], 2] == block[head[g], 3])
            left, right = (f, f) if same else (f[side == 0], f[side == 1])
            order = n if same else np.concatenate([n[side == 0], n[side == 1]])
            if len(left) and len(right):
                pairs = np.array(links_between(left, right, radius, same), np.int64).reshape(-1, 2)
                if len(pairs):
                    yield emit(np.sort(order[pairs], axis=1))

    for batch in rows:
        block = np.stack([np.asarray(c) for c in batch.columns], 1)
        block = np.concatenate([*held, block]) if held else block
        last = block[-1, :4]
        cut = len(block) - int(np.argmin(np.r_[(block[::-1, :4] == last).all(1), False]))
        held = [block[cut:]]
        if cut:
            yield from work(block[:cut])
    if held:
        yield from work(held[0])


def near_links(prints: DataFrame, radius: int = 4, block: int = BLOCK, parts: int | None = None) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of `prints` (fp, id) within the radius.

    `fp` must be distinct. Every task holds two blocks at most.
    """
    keyed = prints.select(F.explode(buckets(F.col("fp"), radius, parts)).alias("x"), "fp", "id").select("x.k", "x.key", "fp", "id")
    # Only buckets of more than one block need a number of blocks; their list is joined, not broadcast by hand.
    large = keyed.groupBy("k", "key").count().where(F.col("count") > block)
    large = large.select("k", "key", F.ceil(F.col("count") * 2 / block).cast("long").alias("blocks"))
    placed = keyed.join(large, ["k", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda other: F.struct(
        F.least(F.col("own"), other).alias("i"), F.greatest(F.col("own"), other).alias("j"),
        (F.col("own") > other).cast("long").alias("side")))
    spread = placed.select(F.col("k").cast("long").alias("k"), "key", F.explode(pairs).alias("p"), "fp", "id").select(
        "k", "key", "p.i", "p.j", "p.side", "fp", "id")
    ready = spread.repartition("k", "key", "i", "j").sortWithinPartitions("k", "key", "i", "j", "side")
    return ready.mapInArrow(lambda rows: _links(rows, radius), "a long, b long")


def parts_for(prints: int, radius: int) -> int:
    """Parts of a fingerprint, so many that a bucket holds `COMPANY` random fingerprints at most.

    More parts mean more tables of smaller buckets; every number of parts finds all links.
    """
    parts = radius + 2
    while prints > COMPANY << (BITS * (parts - radius) // parts) and parts < radius + 8:
        parts += 1
    return parts


def _grouped(prints: DataFrame, radius: int) -> DataFrame:
    """Component of each fingerprint in `prints`: fp, component (a fingerprint of it)."""
    distinct = stored(prints.select("fp").distinct())
    links = near_links(distinct.withColumn("id", F.col("fp")), radius, parts=parts_for(distinct.count(), radius))
    joined = components(links).withColumnRenamed("node", "fp")
    return distinct.join(joined, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of `docs`: key, fingerprint (16 hexadecimal digits), component_id.

    `component_id` is the smallest key reachable over links, its own included; keys may be of any ordered type. Texts without a word
    have fingerprint zero and link like any other. A row without a key gets a null component
    and links nothing. Repeated rows share fingerprint and component. Other columns of `docs` are not read.
    """
    prints = stored(fingerprints(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), words=words))
    keyed = prints.where("id IS NOT NULL")
    first = stored(keyed.groupBy("fp").agg(F.min("id").alias("id")).join(_grouped(keyed, radius), "fp"))
    least = first.groupBy("component").agg(F.min("id").alias("component_id"))
    labels = first.join(least, "component").select("fp", "component_id")
    return prints.join(labels, "fp", "left").select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component: the first by key, then by a hash of the text; of repeated rows one stays. Columns stay as they are.

    Rows without a key stay and link nothing. Each row is judged by its own text, also if its key is there again.
    """
    [place] = fresh_names(docs, "place")
    source = stored(docs.withColumn(place, F.monotonically_increasing_id()))
    rows = source.where(F.col(key).isNotNull()).select(
        F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.col(place).alias("place")).alias("rank"), F.col(text).alias("text"))
    prints = stored(fingerprints(rows, words=words))
    first = prints.groupBy("fp").agg(F.min("rank").alias("rank")).join(_grouped(prints, radius), "fp")
    kept = first.groupBy("component").agg(F.min("rank").alias("rank")).select(F.col("rank.place").alias(place))
    stay = source.where(F.col(key).isNotNull()).join(kept, place, "left_semi")
    return stay.unionByName(source.where(F.col(key).isNull())).select(*docs.columns)
