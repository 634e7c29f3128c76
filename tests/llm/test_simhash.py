import random

import numpy as np
import xxhash

from sensorloom.llm.simhash import BITS, buckets, keep_first, links_between, near_duplicates, near_links, parts_for, planes, within


def plain_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, radius=4):
    up = {i: i for i in fps}
    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    keys = sorted(fps)
    for n, a in enumerate(keys):
        for b in keys[n + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def close(rng, base, flips):
    for b in rng.sample(range(64), flips):
        base ^= 1 << b
    return base


def test_counters_equal_popcount():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(rng.integers(1, 3))
    for radius in (0, 1, 3, 4, 7, 12):
        b = a ^ np.array([sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 16), replace=False)) for _ in a], np.uint64)
        p = planes(a ^ b)
        got = within((row[None, :] for row in p), radius, p.shape[1])[0, :300]
        assert (got == (np.bitwise_count(a ^ b) <= radius)).all()
    assert BITS == 64


def test_blocks(spark):
    rng = random.Random(2)
    fps = {}
    for g in range(30):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 40, 150])):
            base = close(rng, base, rng.randrange(0, 6))
            fps.setdefault(base, len(fps))
    nodes = {i: f for f, i in fps.items()}
    want = plain_components(nodes)
    signed = [(f - (1 << 64) if f >> 63 else f, i) for f, i in fps.items()]
    for block in (8, 64, 4096):
        links = near_links(spark.createDataFrame(signed, "fp long, id long"), block=block).collect()
        got = plain_components({i: 0 for i in nodes}, -1)
        for r in links:
            assert (nodes[r.a] ^ nodes[r.b]).bit_count() <= 4
            x, y = r.a, r.b
            while got[x] != x:
                x = got[x]
            while got[y] != y:
                y = got[y]
            got[max(x, y)] = min(x, y)
        def root(i):
            while got[i] != i:
                i = got[i]
            return i
        assert {i: root(i) for i in nodes} == want, block
    values = np.array(list(nodes.values()), np.uint64)
    assert links_between(values[:0], values, 4, False) == []


def test_texts(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)] + ["ÀB", "Ab", "c\x0bd", "e\x1cf"]
    texts = [None, "", "  ", "one two", "One TWO", "a b c d"]
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 30, 200]))]
        for _ in range(rng.randrange(1, 5)):
            texts.append(" ".join(base))
            base = base[:]
            base[rng.randrange(len(base))] = "zz"
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(5, texts[5], "x"), (None, "a b c d", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = near_duplicates(docs).collect()
    fps = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    want = plain_components(fps)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (int(r.fingerprint, 16), r.component_id) == (fps[r.doc_id], want[r.doc_id])
        else:
            assert r.component_id is None
    kept = [r.doc_id for r in keep_first(docs).collect()]
    assert len(kept) == len(set(kept)) and set(kept) == {i for i in want if want[i] == i} | {None}
    assert near_duplicates(docs.limit(0)).count() == 0


def test_text_keys_and_columns_of_any_name(spark):
    texts = {"b": "one two three four five", "a": "one two three four five", "c": "six seven eight nine ten", "d": None}
    rows = [(i, t, 1, 2, 3) for i, t in texts.items()] + [("c", "another text of the same key", 4, 5, 6), (None, "x", 7, 8, 9)] * 2
    docs = spark.createDataFrame(rows, "doc_id string, text string, _place int, place int, fp int")
    got = {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == {("a", "a"), ("b", "a"), ("c", "c"), ("d", "d"), (None, None)}
    kept = sorted((tuple(r) for r in keep_first(docs).collect()), key=repr)
    assert kept == sorted([rows[1], rows[2], rows[3], rows[4], rows[5], rows[5]], key=repr)
    assert keep_first(docs).columns == docs.columns and keep_first(docs.limit(0)).count() == 0


def test_long_text(spark):
    long = " ".join(f"w{i % 997}" for i in range(200_000))
    rows = [(1, long), (2, long + " end"), (3, "short")]
    got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.component_id for i, r in got.items()} == {1: 1, 2: 1, 3: 3}
    assert got[1].fingerprint == f"{plain_fingerprint(long):016x}"


def test_any_number_of_parts_finds_all(spark):
    assert [parts_for(n, 4) for n in (10, 10**8, 10**9, 10**11, 10**14)] == [6, 6, 7, 8, 12]
    rng = random.Random(9)
    bases = [rng.getrandbits(64) for _ in range(20)]
    fps = {close(rng, b, rng.randrange(0, 5)) for b in bases for _ in range(6)}
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(sorted(fps))], "fp long, id long")
    want = None
    for parts in (6, 7, 9):
        links = {(r.a, r.b) for r in near_links(frame, parts=parts).collect()}
        groups = plain_components({i: 0 for i in range(len(fps))}, -1)
        for a, b in sorted(links):
            low, high = sorted((groups[a], groups[b]))
            groups = {k: low if v == high else v for k, v in groups.items()}
        want = want or plain_components(dict(enumerate(sorted(fps))))
        assert groups == want
    assert len(frame.select(buckets(frame.fp, 4, 8).alias("b")).first().b) == 70
