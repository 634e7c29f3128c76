import random

from sensorloom.llm.suffix import repeated_spans


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(data):
        for p in range(len(b) - length + 1):
            seen.setdefault(b[p:p + length], []).append((d, p))
    covered = [bytearray(len(b)) for b in data]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                covered[d][p:p + length] = b"\1" * length
    return [(len(b), sum(c), sum(1 for i, x in enumerate(c) if x and not (i and c[i - 1])),
             bytes(x for x, y in zip(b, c) if not y)) for b, c in zip(data, covered)]


def check(spark, texts, **options):
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    got = repeated_spans(spark.createDataFrame(rows, "doc_id long, text string, kept int"), **options).collect()
    want = brute(texts, options.get("length", 400))
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want[r.doc_id], r.doc_id
    return got


def test_equals_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["ab", "cd", "the", "ü", "xyz", "q", "ion"]) + str(rng.randrange(1000))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (60, 70, 90, 150, 400)]
    hot = prose(75)
    texts = [None, "", "a" * 399, "b" * 400, "b" * 399 + "c", "a" * 3000, "ab" * 900, prose(5) * 200]
    for i in range(60):
        t = prose(rng.randrange(0, 200))
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            cut = rng.randrange(0, 60)
            t = t + s[cut:] + prose(rng.randrange(0, 60))
        texts.append(t + hot + prose(3) if i % 2 else t)
    base = prose(700)
    for _ in range(6):  # near copies
        w = base.split(" ")
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [base, base, base[:900], base[200:1400], base + base]
    check(spark, texts)


def test_long_text_and_odd_rows(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(600_000))
    docs = spark.createDataFrame([(1, long), (None, long[262_000:263_000]), (None, "short"), (4, "x" * 500), (4, "x" * 500)],
                                 "doc_id long, text string")
    got = repeated_spans(docs).collect()
    assert len(got) == 5
    assert [(s.start, s.end) for r in got if r.doc_id == 1 for s in r.spans] == [(262_000, 263_000)]
    assert sorted(r.n_removed for r in got) == [0, 500, 500, 1000, 1000]
    assert repeated_spans(docs.limit(0)).count() == 0
