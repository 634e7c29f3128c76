"""Periodic runs of words, by block convolution at dyadic scales.

A run of period q holds two periods, so at the scale B with 2 B - 1 <= q <= 4 B - 2 one aligned block of B words lies in its
first period and stands again q words later. At every scale:

1. Each block is searched in the window at these distances. The sum of squared differences between the block and
   the window at all distances is one convolution, computed in integers by a number theoretic transform; it is zero
   where the block stands again. A prime modulus keeps the numbers small; a sum that is only zero modulo the prime falls in step 2.
2. The distances found are seeds: word by word they are extended to both sides, as long as words a distance apart are equal.
3. Stretches of two periods are runs; equal stretches have one run, that of the smallest period.

Two tests spare convolutions and lose nothing. A block with a word that does not come again within the window stands nowhere
in it. And inside a run of a period q up to B, a block stands at multiples of q only, which give this run again.

Texts are independent, so a narrow Arrow pass does it all. Several texts are laid end to end for one search:
words are numbered anew in each text, so nothing matches across them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

LEAST = 12             # words of a run
WORDS = 1 << 19        # words searched at a time, unless one text has more
CELLS = 1 << 18        # numbers of one batch of transforms, unless one block needs more

# A prime of the form 15 * 2 ** 27 + 1 and a generator of its units.
PRIME, GENERATOR = 2013265921, 31
_P = np.uint64(PRIME)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * b
    out -= out // _P * _P
    return out


def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a + b
    return np.minimum(out, out - _P)  # below zero wraps to a large number


def _roots(n: int, root: int) -> np.ndarray:
    """The first n powers, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, _times(out, np.uint64(pow(root, len(out), PRIME)))])
    return out[:n]


def transform(a: np.ndarray) -> np.ndarray:
    """Number theoretic transform of the columns of `a`; its rows come out in bit-reversed order."""
    n, columns = a.shape
    half = n // 2
    while half:
        turn = _roots(half, pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME))[None, :, None]
        pairs = a.reshape(-1, 2, half, columns)
        low, high = pairs[:, 0], pairs[:, 1]
        a = np.stack([_plus(low, high), _times(low + _P - high, turn)], 1).reshape(n, columns)
        half //= 2
    return a


def inverse(a: np.ndarray) -> np.ndarray:
    """The columns whose transform is `a`, its rows in bit-reversed order."""
    n, columns = a.shape
    half = 1
    while half < n:
        back = pow(pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME), PRIME - 2, PRIME)
        pairs = a.reshape(-1, 2, half, columns)
        low, high = pairs[:, 0], _times(pairs[:, 1], _roots(half, back)[None, :, None])
        a = np.stack([_plus(low, high), _plus(low, _P - high)], 1).reshape(n, columns)
        half *= 2
    return _times(a, np.uint64(pow(n, PRIME - 2, PRIME)))


def occurrences(words: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (start, distance) where blocks of `size` words at `starts` stand again 2 * size - 1 to 4 * size - 2 words later.

    `words` is padded behind the last block. A place may be wrong by the modulus, none is left out.
    """
    width = 4 * size  # holds the linear convolution of a block and its window of 3 * size - 1 words
    step = max(1, CELLS // width)
    at, distance = [], []
    for k in range(0, len(starts), step):
        part = starts[k:k + step]
        block = words[part[None, :] + np.arange(size)[::-1, None]]
        window = words[part[None, :] + (2 * size - 1) + np.arange(3 * size - 1)[:, None]]
        a, b = np.zeros((2, width, len(part)), np.uint64)
        a[:size], b[:3 * size - 1] = block, window
        both = inverse(_times(transform(a), transform(b)))[size - 1:3 * size - 1]
        squares = np.cumsum(np.vstack([np.zeros((1, len(part)), np.uint64), _times(b[:3 * size - 1], b[:3 * size - 1])]), axis=0)
        own = (squares[size:] - squares[:-size]) % _P
        sums = _plus(own, _times(a[:size], a[:size]).sum(0)[None, :] % _P)
        d, i = np.nonzero(sums == _plus(both, both))
        at.append(part[i])
        distance.append(d + (2 * size - 1))
    return np.concatenate(at), np.concatenate(distance)


def _reach(words: np.ndarray, base: int, place: np.ndarray, distance: np.ndarray, sign: int) -> np.ndarray:
    """Number of words from each place on (sign 1) or before it (-1) that equal the word a distance later."""
    total = np.zeros(len(place), np.int64)
    live, chunk = np.arange(len(place)), 8
    while len(live):
        nxt = []
        for k in range(0, len(live), max(1, CELLS // chunk)):
            some = live[k:k + max(1, CELLS // chunk)]
            first = place[some] + (total[some] if sign > 0 else -1 - total[some])
            i = np.clip(first[:, None] + sign * np.arange(chunk), 0, base)  # words[base:] are unlike any other
            j = np.minimum(i + distance[some][:, None], len(words) - 1)
            inside = (first[:, None] + sign * np.arange(chunk)) >= 0
            same = inside & (words[i] == words[j]) & (j < base)
            run = np.where(same.all(1), chunk, np.argmin(same, axis=1))
            total[some] += run
            nxt.append(some[run == chunk])
        live = np.concatenate(nxt)
        chunk = min(2 * chunk, 1 << 14)
    return total


def find_runs(words: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period) of all runs by start, then period; no run is longer than `longest` words."""
    n, found = len(words), {}
    gap = np.full(n, np.iinfo(np.int64).max)
    order = np.argsort(words, kind="stable")
    again = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    size, worst, known = 1, gap, np.empty((0, 3), np.int64)
    while 2 * size - 1 <= longest // 2 and len(worst):
        far = 4 * size - 2
        fits = worst <= far
        inner = known[known[:, 2] <= size]  # runs in which blocks of this size stand at multiples of the period only
        of_run = _run_of_blocks(inner, size, len(worst))
        ends = np.r_[inner[:, 1], 0][of_run]
        fits &= ~(np.arange(len(worst)) * size + far + size <= ends)
        starts = np.flatnonzero(fits) * size
        if len(starts):
            padded = np.concatenate([words + 1, np.zeros(5 * size, words.dtype)]).astype(np.uint64)
            at, distance = occurrences(padded, starts, size)
            run = of_run[at // size]
            q = np.r_[inner[:, 2], 1][run]
            new = ~((at + distance + size <= np.r_[inner[:, 1], 0][run]) & (distance % q == 0))
            for row in _extended(words, at[new], distance[new], size, least):
                stretch = tuple(row[:2])
                found[stretch] = min(found.get(stretch, row[2]), row[2])
            known = np.array([(s, e, d) for (s, e), d in found.items()], np.int64).reshape(-1, 3)
        if len(worst) % 2:
            worst = np.r_[worst, np.iinfo(np.int64).max]
        worst = worst.reshape(-1, 2).max(1)
        size *= 2
    return known[np.lexsort((known[:, 2], known[:, 0]))]


def _run_of_blocks(runs: np.ndarray, size: int, blocks: int) -> np.ndarray:
    """For each block the place of a run that holds it, -1 if none does."""
    out = np.full(blocks, -1)
    for k in np.argsort(runs[:, 1] - runs[:, 0], kind="stable"):
        out[-(-runs[k, 0] // size):max(0, runs[k, 1] // size)] = k
    return out


def _extended(words: np.ndarray, at: np.ndarray, distance: np.ndarray, size: int, least: int) -> list[list[int]]:
    """Rows (start, end, distance) of the stretches around seeds that are two distances long."""
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    padded, out = np.r_[words, -1], []
    while len(at):
        # Of blocks in a row with one distance, the first speaks for those that its stretch covers.
        head = np.r_[True, (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + size)]
        place, apart = at[head], distance[head]
        after = place + _reach(padded, len(words), place, apart, 1)
        start, end = place - _reach(padded, len(words), place, apart, -1), after + apart
        whole = (after - place >= size) & (end - start >= np.maximum(least, 2 * apart))
        out.append(np.stack([start, end, apart], 1)[whole])
        rest = ~head & (at + size > after[np.cumsum(head) - 1])
        at, distance = at[rest], distance[rest]
    return np.unique(np.concatenate(out), axis=0).tolist() if out else []


def _searched(texts: list[list[bytes]], least: int) -> Iterator[tuple[list[dict], bytes]]:
    """Runs and collapsed text of each text."""
    fresh = count()
    numbers = []
    for own in texts:
        known = defaultdict(fresh.__next__)
        numbers.append(np.fromiter(map(known.__getitem__, own), np.int64, len(own)))
    ends = np.cumsum([len(own) for own in texts])
    words = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
    runs = find_runs(words, max((len(own) for own in texts), default=0), least)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    dropped = np.cumsum(change)[:-1] > 0
    cuts = np.searchsorted(runs[:, 0], ends)
    for k, own in enumerate(texts):
        first, base = cuts[k - 1] if k else 0, ends[k] - len(own)
        some = [{"start": s - base, "length": e - s, "period": q} for s, e, q in runs[first:cuts[k]].tolist()]
        kept = own if not some else [w for w, gone in zip(own, dropped[base:ends[k]].tolist(), strict=True) if not gone]
        yield some, b" ".join(kept)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per row of `docs`: key, n_words, runs (array of start, length, period by start, then period), collapsed.

    A run is a stretch of words of smallest period q, `least` words and two periods long, that no word beside it extends. The
    collapsed text holds the words that no run repeats after its first period, joined by a blank. Null and empty texts have no word.
    Rows are judged by themselves, so repeated rows have equal results and null keys do no harm. Other columns are not read.
    """
    source = docs.select(F.col(key).alias("key"), text_of(text).cast("binary").alias("bytes"))
    kind = source.schema["key"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def groups(part: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
        held, size, at = [], 0, 0
        for value in part.column(1):
            own = value.as_py().split()  # on bytes, at the six ASCII blanks alone
            if held and size + len(own) > WORDS:
                yield at, held
                at, held, size = at + len(held), [], 0
            held.append(own)
            size += len(own)
        if held:
            yield at, held

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at, texts in groups(part):
                runs, kept = zip(*_searched(texts, least), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(at, len(texts)), pa.array([len(own) for own in texts], pa.int64()),
                     pa.array(runs, pa.list_(run)), pa.array(kept, pa.binary())], names=["key", "n_words", "runs", "collapsed"])

    found = source.mapInArrow(batches, f"key {kind}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary")
    return found.select(F.col("key").alias(key), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
