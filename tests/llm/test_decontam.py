import random
import re
import time
from collections import Counter
from math import log

from sensorloom.llm.decontam import decontaminate, drop_leaks


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def brute(docs, items):
    """All item-sized windows of all texts, by exact similarity alone."""
    df = Counter(h for _, t in items for h in set(shingles(t)))
    weight = {h: 1 + log(len(items) / n) for h, n in df.items()}
    out = {}
    for d, text in docs:
        every = shingles(text)
        for i, t in items:
            own = Counter(shingles(t))
            n, total, best = sum(own.values()), sum(weight[h] * c for h, c in own.items()), 0
            for s in range(max(1, len(every) - n + 1)):
                got = Counter(every[s:s + n])
                best = max(best, sum(weight[h] * min(c, got[h]) for h, c in own.items()) / total)
            if best >= 0.8 - 1e-9:
                out.setdefault(d, {})[i] = best
    return out


def test_equals_brute_force(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)] + ["The", "of"] * 40
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(text(rng.choice([3, 5, 9, 25, 25, 40])))) for i in range(25)]
    docs = []
    for d in range(120):
        body = text(rng.randrange(0, 150))
        if d % 2:
            leak = items[rng.randrange(25)][1].split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                leak[rng.randrange(len(leak))] = rng.choice(words)
            leak = leak[rng.choice([0, 0, 0, 2, 4]):]
            at = rng.randrange(len(body) + 1)
            body = body[:at] + leak + body[at:]
        docs.append((d, " ".join(body).upper() if d % 5 == 0 else "\n".join(body)))
    docs += [(500, None), (501, ""), (502, items[3][1]), (503, (items[4][1] + " ") * 50)]
    frame = spark.createDataFrame([(d, t, 0) for d, t in docs] + [(None, items[5][1], 1), (502, items[3][1], 0), (502, "clean", 0)],
                                  "doc_id long, text string, items int")
    bench = spark.createDataFrame([(i, t) for i, t in items] + [(None, "a b c d e f"), (99, None), (98, ""), (97, items[0][1])],
                                  "item_id long, text string")
    got = decontaminate(frame, bench).collect()
    assert len(got) == len(docs) + 3
    want = brute(docs, items)
    assert sum(map(len, want.values())) > 20
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for d, _ in docs:
        if d == 502:
            assert sorted(len(r["items"]) for r in by[d])[0] == 0 and len(by[d]) == 3
            continue
        assert by[d][0]["items"] == sorted(want.get(d, {})), d
        assert by[d][0].leaked == (d in want)
        if d in want:
            assert abs(by[d][0].similarity - max(want[d].values())) < 1e-9
    kept = drop_leaks(frame, bench).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted([d for d, _ in docs if d not in want] + [502])
    assert decontaminate(frame.limit(0), bench).count() == 0
    assert not any(r.leaked for r in decontaminate(frame, bench.limit(0)).collect())


def test_items_that_share_most_of_their_shingles(spark):
    rng = random.Random(3)
    word = lambda: f"q{rng.randrange(10**6)}"
    preamble = [word() for _ in range(24)]
    items = [(i, " ".join(preamble + [word() for _ in range(13)])) for i in range(200)]
    docs = []
    for i, t in items[:60]:  # the question alone, behind other words: similarity 0.8 by weight, 13 of 33 shingles
        docs.append((i, " ".join([word() for _ in range(30)] + t.split()[20:] + [word() for _ in range(i % 3)])))
    for i, t in items[60:80]:  # words put into the item
        w = t.split()
        at = rng.randrange(5, 33)
        docs.append((i, " ".join([word() for _ in range(9)] + w[:at] + [word() for _ in range(rng.randrange(1, 9))] + w[at:])))
    docs.append((900, " ".join(preamble + [word() for _ in range(13)])))
    want = brute(docs, items)
    assert len(want) > 60 and 900 not in want
    got = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    for r in got:
        assert r["items"] == sorted(want.get(r.doc_id, {})), r.doc_id
        assert r.doc_id not in want or abs(r.similarity - max(want[r.doc_id].values())) < 1e-9


def test_long_item_in_a_long_text(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    item = [rng.choice(words) for _ in range(3000)]
    changed = [rng.choice(words) if rng.random() < 0.02 else w for w in item]
    docs = [(1, " ".join(rng.choices(words, k=3000) + changed + rng.choices(words, k=3000))), (2, " ".join(rng.choices(words, k=9000)))]
    began = time.time()
    got = {r.doc_id: r for r in decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                              spark.createDataFrame([("long one", " ".join(item))], "item_id string, text string")).collect()}
    assert time.time() - began < 60
    assert got[1]["items"] == ["long one"] and not got[2].leaked
    own, held = Counter(shingles(docs[0][1])[3000:3000 + 2996]), Counter(shingles(" ".join(item)))
    assert abs(got[1].similarity - sum(min(c, own[h]) for h, c in held.items()) / 2996) < 1e-9


def test_columns_of_any_name_and_text_ids(spark):
    item = "one two three four five six seven eight"
    names = ["_k", "_r", "_own", "_key", "_row", "_text", "item", "h"]
    rows = [("a", "say " + item, *names), ("b", "clean words only", *names), (None, item, *names), (None, None, *names)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, " + ", ".join(f"`{n}` string" for n in names))
    bench = spark.createDataFrame([("x", item), ("w", item)], "item_id string, text string")
    assert {r.doc_id: list(r["items"]) for r in decontaminate(docs.where("doc_id IS NOT NULL"), bench).collect()} == {"a": ["w"], "b": []}
    kept = drop_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([rows[1], rows[3]], key=repr)
