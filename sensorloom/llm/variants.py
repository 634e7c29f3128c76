"""Groups of spelling variants: words one edit apart, found in k-d trees over letter counts.

1. A narrow Arrow pass counts words; counts are combined in it and again before they are shuffled.
2. Words of one length are points, their coordinates the counts of their letters. One edit moves a point by little: a replaced letter
   takes one from a coordinate and adds one to another, an inserted letter adds one, so the L1 distance is at most two. All
   words of a length are one k-d tree. Spark grows its upper part level by level: counts of letters choose the letter and
   the threshold that halve a node best, until nodes are small enough for a task. Nodes of equal points are halved by a hash.
3. Every word searches the trees of its own length and of the next. A range search goes down to both sides of a
   split that one edit may cross, and prunes the side it cannot reach: at most one count up, and one down for a replacement.
4. A task grows the rest of a node's tree over its words, searches it with all words that came there, and verifies the order
   of letters of what lies within the distance. Only counts and the best neighbour leave it.
5. Words point at their largest neighbour; doubling pointers lead each one to its root.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, text_of

LETTERS = re.compile(r"[A-Za-zÀ-ÿ]+")
SHORTEST = 5           # code points of a word
SEEN = 3               # occurrences of a word
TIMES = 2              # how much more often a form is seen than its variant
FLUSH = 1 << 17        # different words that a task counts before it passes the counts on
NODE = 1 << 18         # letters of all words of a node that a task takes
SEARCHES = 1 << 16     # words that search a node in one task
LEAF = 64              # words of a leaf
PAIRS = 1 << 20        # pairs compared at a time


def damaged(word: str, h: int) -> str:
    """The word without its code point h % length."""
    at = h % len(word)
    return word[:at] + word[at + 1:]


def text_words(text: bytes, key: str | None, every: int, shortest: int) -> Counter[str]:
    """Counts of the words of a text, A-Z in small letters.

    With `every` and a key, the hash crc32 of `<key>:<word>` damages the words whose hash it divides.
    """
    found = Counter(LETTERS.findall(text.lower().decode(errors="replace")))
    if not every or key is None:
        return Counter({w: n for w, n in found.items() if len(w) >= shortest})
    head, out = zlib.crc32(f"{key}:".encode()), Counter()
    for w, n in found.items():
        h = zlib.crc32(w.encode(), head)
        if h % every == 0:
            w = damaged(w, h)
        if len(w) >= shortest:
            out[w] += n
    return out


def count_words(docs: DataFrame, key: str, text: str, every: int = 0, shortest: int = SHORTEST, seen: int = SEEN) -> DataFrame:
    """Words of all texts that are `shortest` code points long and stand `seen` times: word, n."""
    source = docs.select(F.col(key).cast("string").alias("key"), text_of(text).cast("binary").alias("bytes"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(total: dict[str, int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        total: Counter[str] = Counter()
        for part in parts:
            for k, value in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                for w, n in text_words(value.as_py(), k, every, shortest).items():
                    total[w] += n
                if len(total) >= FLUSH:
                    yield packed(total)
                    total = Counter()
        if total:
            yield packed(total)

    return source.mapInArrow(batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= seen)


def _count(letter: Column) -> Column:
    return F.length("word") - F.length(F.replace(F.col("word"), letter, F.lit("")))


def _splits(members: DataFrame, node: int) -> DataFrame:
    """For each node above `node` letters: length, node, letter and threshold (null letter: halve by a hash).

    Every letter with every count that its words have is a possible split; the one nearest to a half is taken.
    """
    by = ["length", "node"]
    large = members.groupBy(*by).agg(F.count("*").alias("size")).where((F.col("size") * F.col("length") > node) & (F.col("size") > 1))
    # Few rows a length: as many as a length has letters more than `node`.
    open_words = members.join(large, by)
    held = open_words.select(*by, "size", "word", F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
    counts = held.withColumn("c", _count(F.col("letter"))).groupBy(*by, "size", "letter", "c").agg(F.count("*").alias("k"))
    # Words above a threshold t of a letter: those with a count of t + 1 or more.
    above = F.sum("k").over(Window.partitionBy(*by, "letter").orderBy(F.col("c").desc()))
    each = counts.withColumn("above", above).where(F.col("above") < F.col("size"))
    best = each.groupBy(*by).agg(F.min(F.struct(F.abs(2 * F.col("above") - F.col("size")).alias("off"), "letter", (F.col("c") - 1).alias("t"))).alias("b"))
    return large.select(*by).join(best, by, "left").select(*by, F.col("b.letter").alias("letter"), F.col("b.t").alias("t"))


def _children(members: DataFrame, searches: DataFrame, splits: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Members go to one side of a split; searches go to each side that one edit of the word may reach."""
    left, right = 2 * F.col("node"), 2 * F.col("node") + 1
    split = splits.withColumn("split", F.lit(True))
    c = _count(F.col("letter"))
    own = F.when(F.col("letter").isNull(), F.pmod(F.xxhash64("word", F.lit(level)), F.lit(2)) == 1).otherwise(c > F.col("t"))
    down = members.join(split, ["length", "node"], "left").select(
        "word", "n", "length", F.when(F.col("split").isNull(), F.col("node")).when(own, right).otherwise(left).alias("node"))

    def side(node: Column, up: Column, low: Column) -> Column:
        return F.struct(node.alias("node"), up.alias("up"), low.alias("down"))

    up, low = F.col("up"), F.col("down")
    nothing = F.lit(None).cast("struct<node:bigint,up:int,down:int>")
    stay = F.array(side(F.col("node"), up, low))
    both = F.array(side(left, up, low), side(right, up, low))
    at_right = F.array(side(right, up, low), F.when((c == F.col("t") + 1) & (low > 0), side(left, up, low - 1)).otherwise(nothing))
    at_left = F.array(side(left, up, low), F.when((c == F.col("t")) & (up > 0), side(right, up - 1, low)).otherwise(nothing))
    ways = (F.when(F.col("split").isNull(), stay).when(F.col("letter").isNull(), both).when(c > F.col("t"), at_right).otherwise(at_left))
    over = searches.join(split, ["length", "node"], "left").select("word", "n", "length", F.explode(F.array_compact(ways)).alias("w"))
    return down, over.select("word", "n", "length", "w.node", "w.up", "w.down")


def _cells(words: DataFrame, node: int) -> tuple[DataFrame, DataFrame]:
    """Members (word, n, length, node) and searches (word, n, length and node searched) of the upper trees' last nodes."""
    members = words.select("word", "n", F.length("word").alias("length"), F.lit(1).cast("long").alias("node"))
    # One edit: a replacement inside the length (one count up, one down), or an insertion into the next (one up).
    searches = members.select("word", "n", F.explode(F.array(
        F.struct(F.col("length").alias("length"), F.lit(1).alias("down")), F.struct((F.col("length") + 1).alias("length"), F.lit(0).alias("down")))).alias("s"),
        "node", F.lit(1).alias("up")).select("word", "n", "s.length", "node", "up", "s.down")
    searches = searches.join(members.select("length").distinct(), "length", "left_semi").select("word", "n", "length", "node", "up", "down")
    level = 0
    while True:
        splits = stored(_splits(members, node))
        if splits.isEmpty():
            return members, searches
        members, searches = map(stored, _children(members, searches, splits, level))
        level += 1


class Tree:
    """A k-d tree over the letter counts of words of one length, searched with many words at a time."""

    def __init__(self, codes: np.ndarray, leaf: int = LEAF):
        self.codes, self.leaf = codes, leaf
        self.letters = np.unique(codes)
        self.counts = letter_counts(codes, self.letters)
        self.bits = thermometer(codes)

    def near(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of pairs (search, member) one edit apart: of equal length one replacement, else one insertion into the search."""
        longer = self.codes.shape[1] - codes.shape[1]
        counts, bits = letter_counts(codes, self.letters), thermometer(codes)
        n = len(codes)
        stack = [(np.arange(len(self.codes)), np.arange(n), np.ones(n, np.int8), np.full(n, 1 - longer, np.int8))]
        while stack:
            own, some, up, down = stack.pop()
            if not len(some):
                continue
            split = None if len(own) <= self.leaf else best_split(self.counts[own])
            if split is None:
                step = max(1, PAIRS // len(own))
                for k in range(0, len(some), step):
                    yield self._verified(own, some[k:k + step], codes, bits, longer)
                continue
            letter, t = split
            right, c = self.counts[own, letter] > t, counts[some, letter]
            above = c > t
            climb, drop = ~above & (c == t) & (up > 0), above & (c == t + 1) & (down > 0)
            for side, stays, crosses, du, dd in ((own[right], above, climb, 1, 0), (own[~right], ~above, drop, 0, 1)):
                stack.append((side, np.r_[some[stays], some[crosses]], np.r_[up[stays], up[crosses] - du].astype(np.int8),
                              np.r_[down[stays], down[crosses] - dd].astype(np.int8)))

    def _verified(self, own: np.ndarray, some: np.ndarray, codes: np.ndarray, bits: np.ndarray, longer: int) -> tuple[np.ndarray, np.ndarray]:
        apart = np.zeros((len(some), len(own)), np.uint8)
        for word in range(bits.shape[1]):
            apart += np.bitwise_count(bits[some, word][:, None] ^ self.bits[own, word][None, :])
        i, j = np.nonzero(apart <= 2 - longer)
        i, j = some[i], own[j]
        hit = [np.empty(0, bool)]
        step = max(1, PAIRS // self.codes.shape[1])
        for k in range(0, len(i), step):
            test = one_inserted if longer else one_replaced
            hit.append(test(codes[i[k:k + step]], self.codes[j[k:k + step]]))
        hit = np.concatenate(hit)
        return i[hit], j[hit]


def letter_counts(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """How often each word (a row) has each of `letters`; other letters are left out."""
    place = np.searchsorted(letters, codes)
    place[place == len(letters)] = 0
    known = letters[place] == codes
    row = np.broadcast_to(np.arange(len(codes))[:, None], codes.shape)
    flat = np.bincount((row * len(letters) + place)[known], minlength=len(codes) * len(letters))
    return flat.reshape(len(codes), len(letters)).astype(np.int32)


def thermometer(codes: np.ndarray) -> np.ndarray:
    """Bits that change by no more than letter counts do: one bit each for a first, second and third a to z, others share some."""
    out = np.zeros((len(codes), 2), np.uint64)
    letters = np.unique(codes)
    counts = letter_counts(codes, letters)
    for k, code in enumerate(letters.tolist()):
        plain = code - ord("a")
        if 0 <= plain < 26:
            for times, (word, bit) in enumerate(((0, plain), (1, plain), (1, 26 + plain))):
                out[:, word] |= (counts[:, k] > times).astype(np.uint64) << np.uint64(bit)
        else:
            out[:, 0] |= (counts[:, k] > 0).astype(np.uint64) << np.uint64(26 + code % 38)
    return out


def best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and threshold that halve the rows best; None if all are equal."""
    n, best, most = len(counts), None, int(counts.max())
    for t in range(most):
        above = (counts > t).sum(0)
        off = np.where((above > 0) & (above < n), np.abs(2 * above - n), 2 * n)
        k = int(off.argmin())
        if off[k] < 2 * n and (best is None or off[k] < best[0]):
            best = (int(off[k]), k, t)
    return best and best[1:]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of `a` that a row of `b` becomes without one of its letters."""
    before = np.logical_and.accumulate(a == b[:, :-1], axis=1)
    after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return after[:, 0] | before[:, -1] | (before[:, :-1] & after[:, 1:]).any(1)


def as_codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a word a row."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def near_words(words: DataFrame, node: int = NODE, searches: int = SEARCHES) -> DataFrame:
    """Of `words` (word, n) those with near ones: word, n_near, best (struct of -n and word of the largest, ties: smallest word)."""
    members, asked = _cells(words, node)
    # A node that many words search is searched in blocks, each with all members of the node.
    blocks = stored(asked.groupBy("length", "node").agg(F.ceil(F.count("*") / searches).cast("int").alias("blocks")))
    by = ["length", "node"]
    query = asked.join(blocks, by).select(*by, F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int").alias("block"), "word", "n", F.lit(1).alias("side"))
    member = members.join(blocks, by).select(*by, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "word", "n", F.lit(0).alias("side"))

    def work(group: pa.Table) -> pa.Table:
        length, side = group.column("length")[0].as_py(), group.column("side").to_numpy()
        names, counts = np.array(group.column("word").to_pylist(), object), group.column("n").to_numpy()
        # Places in the order of what is the better neighbour.
        order = np.lexsort((np.argsort(np.argsort(names)), -counts))
        names, counts, side = names[order], counts[order], side[order]
        sizes = np.array([len(w) for w in names])
        kept = np.flatnonzero(side == 0)
        n_near, best = np.zeros(len(names), np.int64), np.full(len(names), len(names))

        def note(place: np.ndarray, other: np.ndarray) -> None:
            np.add.at(n_near, place, 1)
            np.minimum.at(best, place, other)

        if len(kept):
            tree = Tree(as_codes(names[kept].tolist()))
            for size in (length - 1, length):
                some = np.flatnonzero((side == 1) & (sizes == size))
                for i, j in tree.near(as_codes(names[some].tolist())) if len(some) else ():
                    note(some[i], kept[j])
                    if size < length:  # only the shorter word searches
                        note(kept[j], some[i])
        hit = np.flatnonzero(n_near)
        return pa.table({"word": pa.array(names[hit], pa.string()), "n_near": pa.array(n_near[hit]),
                         "best_n": pa.array(counts[best[hit]], pa.int64()), "best": pa.array(names[best[hit]], pa.string())})

    found = query.unionByName(member).groupBy(*by, "block").applyInArrow(work, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best"))


def variant_groups(words: DataFrame, times: int = TIMES, **options) -> DataFrame:
    """One row per word of `words` (word, n; words are distinct): word, form, root, n, n_near, form_n.

    Words are near if one inserted, deleted or replaced code point makes one the other. The form of a word is its near word
    of largest n (ties: the smallest in code-point order), if that is `times` the word's own or more; else null. The root is where
    forms lead in the end, the word itself if it has none. An empty table gives an empty one; null words are left out.
    """
    words = stored(words.where("word IS NOT NULL").select("word", "n"))
    near = near_words(words, **options)
    form = F.when(-F.col("best.less") >= times * F.col("n"), F.col("best"))
    known = stored(words.join(near, "word", "left").withColumn("form", form).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form.word").alias("form"), (-F.col("form.less")).alias("form_n")))
    # Counts at least double along forms, so paths are short, and every round doubles what a pointer covers.
    ahead = stored(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        beyond = ahead.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = stored(ahead.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        ahead = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return known.join(ahead, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 0, shortest: int = SHORTEST, seen: int = SEEN,
                      **options) -> DataFrame:
    """Groups of variants among the words of all texts: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters, A-Z made small, at least `shortest` code points long and seen `seen` times overall. Null and empty
    texts have none; every row counts, also a repeated one. `every` damages words on purpose (see `text_words`), but
    not those of rows without a key. Columns of `docs` other than key and text are not read.
    """
    return variant_groups(count_words(docs, key, text, every, shortest, seen), **options)
