import hashlib
import random
import re
import zlib

import numpy as np

from sensorloom.llm import queries
from sensorloom.llm.runs import PRIME, find_runs, inverse, occurrences, periodic_runs, transform


def plain_runs(words, least=12):
    """{(start, end): period} by comparing the words with themselves at every distance."""
    found, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        start = None
        for i in range(n - p + 1):
            same = i < n - p and words[i] == words[i + p]
            if same and start is None:
                start = i
            elif not same and start is not None:
                if i + p - start >= max(least, 2 * p):
                    found.setdefault((start, i + p), p)
                start = None
    return found


def plain_row(words):
    runs = sorted((s, e - s, q) for (s, e), q in plain_runs(words).items())
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def strange(rng, n):
    """Words with repeats inside repeats, of few and of many different words."""
    words = []
    while len(words) < n:
        piece = [str(rng.randrange(rng.choice([2, 3, 1000]))) for _ in range(rng.randrange(1, 30))]
        for _ in range(rng.randrange(3)):
            piece = piece * rng.randrange(1, 4) + piece[:rng.randrange(4)] + [str(rng.randrange(3))] * rng.randrange(2)
        words += piece[:n]
    return words[:n]


def test_transform():
    rng = np.random.default_rng(1)
    for n in (4, 8, 64):
        a, b = rng.integers(0, PRIME, (2, n, 3)).astype(np.uint64)
        assert (inverse(transform(a)) == a).all()
        product = inverse(transform(a) * transform(b) % np.uint64(PRIME))
        for c in range(3):
            want = [sum(int(a[i, c]) * int(b[(k - i) % n, c]) for i in range(n)) % PRIME for k in range(n)]
            assert product[:, c].tolist() == want


def test_occurrences():
    rng = np.random.default_rng(2)
    for size in (1, 2, 4, 8):
        words = rng.integers(1, 3, 300)
        padded = np.r_[words, np.zeros(5 * size, int)].astype(np.uint64)
        starts = np.arange(0, 300 - size, size)
        got = set(zip(*(x.tolist() for x in occurrences(padded, starts, size)), strict=True))
        want = {(s, d) for s in starts.tolist() for d in range(2 * size - 1, 4 * size - 1) if (padded[s:s + size] == padded[s + d:s + d + size]).all()}
        assert got == want


def test_find_runs():
    rng = random.Random(3)
    cases = [["a"] * 300, ["a", "b"] * 150, (["a", "b"] * 4 + ["c"]) * 20, [], ["a"], ["a"] * 11, ["a"] * 12, list("abcabcabcabd") * 2]
    cases += [strange(rng, rng.randrange(10, 400)) for _ in range(150)]
    for words in cases:
        names = {}
        numbers = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
        got = find_runs(numbers, len(words)).tolist()
        assert got == sorted([s, e, q] for (s, e), q in plain_runs(words).items())


def test_texts(spark):
    rng = random.Random(4)
    words = ["a", "B", "b", "é", "\x1cx", "w1", "w2", "a b"]
    texts = [None, "", " \n", "a " * 40, "x y " * 9 + "z"]
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 20))]
        texts.append(rng.choice([" ", "\t", "\x0b\n"]).join([rng.choice(words) for _ in range(9)] + base * rng.randrange(1, 6) + base[:3]))
    texts.append(" ".join(f"v{i % 4001}" for i in range(40_000)) + " end")
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(4, texts[4], "y", 2), (None, "q " * 30, "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int")
    got = sorted((r.doc_id is None, r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed, r.n_words) for r in periodic_runs(docs).collect())
    want = []
    for i, t, *_ in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        if len(own) > 10_000:
            runs, kept = [(0, 40_000, 4001)], " ".join(own[:4001] + own[-1:])
        else:
            runs, kept = plain_row(own)
        want.append((i is None, i or 0, runs, kept, len(own)))
    assert got == sorted(want)
    assert periodic_runs(docs.limit(0)).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 120)))) for i in range(300)] + [(300, None), (301, "one")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, t in rows:
        words = (t or "").split()
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j if j < a else a + (j - a) % p] for j in range(n)]
        runs, kept = plain_row(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        text = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(text.encode()).hexdigest(),
                hashlib.sha256(kept.encode()).hexdigest())
        assert tuple(got[i])[1:] == want
    assert planted > 10 and any(r.n_runs for r in got.values())
