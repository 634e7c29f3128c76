import random
import re
import zlib
from collections import Counter

import numpy as np

from sensorloom.llm import variants
from sensorloom.llm.variants import Tree, as_codes, spelling_variants, variant_groups


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def plain_groups(words, times=2):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def strange_words(rng, n, letters="abcdé", longest=9):
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(1, longest)))
        for _ in range(rng.randrange(1, 5)):
            words[w] = rng.choice([3, 3, 4, 7, 9, 30, 200, 5000])
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:], (w[:i] + w[i + 1:]) or w])
    return words


def test_tree():
    rng = random.Random(1)
    for letters in ("ab", "abcdefghij", "aàbÿß÷×"):
        for length in (1, 2, 5, 8):
            own = sorted({"".join(rng.choice(letters) for _ in range(length)) for _ in range(300)})
            for size in {max(1, length - 1), length}:
                asked = sorted({"".join(rng.choice(letters + "q") for _ in range(size)) for _ in range(200)})
                tree = Tree(as_codes(own), leaf=4)
                got = sorted((int(i), int(j)) for a, b in tree.near(as_codes(asked)) for i, j in zip(a, b, strict=True))
                assert got == [(i, j) for i, a in enumerate(asked) for j, b in enumerate(own) if one_edit(a, b)]


def test_groups(spark, monkeypatch):
    rng = random.Random(2)
    words = strange_words(rng, 1500) | {"x": 3, "xxxxxxxxxxxxxxxxxxxxx": 4, "a" * 3000: 3, "a" * 3001: 6, "b" + "a" * 2999: 9}
    # All of the same letters, so that only a hash can halve their node.
    words |= {"".join(rng.sample("aabbccdd", 8)): rng.choice([3, 6]) for _ in range(300)}
    frame = spark.createDataFrame([*words.items(), (None, 5)], "word string, n long")
    want = plain_groups(words)
    for node, searches in ((300, 50), (1 << 18, 1 << 16)):
        got = [tuple(r) for r in variant_groups(frame, node=node, searches=searches).collect()]
        assert len(got) == len(want) and set(got) == want
    assert variant_groups(frame.limit(0)).count() == 0


def test_texts(spark, monkeypatch):
    rng = random.Random(3)
    names = ["Haus", "Häuser", "HÄUSER", "letter", "Letters", "lettre", "niño", "naïve", "a" * 40, "x×y÷z", "don't"]
    rows = [(i, rng.choice([" ", "\n", "0", "-"]).join(rng.choices(names, k=rng.randrange(60))), "w", 1) for i in range(200)]
    rows += [(200, None, "w", 1), (201, "", "w", 1), rows[3], rows[3], (None, "letters niños", "w", 1), (203, "word " * 5000, "w", 1)]
    every, counts = 7, Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 5
    want = plain_groups({w: n for w, n in counts.items() if n >= 3})
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    assert {tuple(r) for r in spelling_variants(docs, every=every).collect()} == want
    monkeypatch.setattr(variants, "FLUSH", 3)
    assert {tuple(r) for r in spelling_variants(docs, every=every).collect()} == want
    assert spelling_variants(docs.limit(0)).count() == 0


def test_bits_never_exceed_the_distance():
    rng = random.Random(4)
    words = ["".join(rng.choice("aabcdeèéêz") for _ in range(7)) for _ in range(200)]
    bits = variants.thermometer(as_codes(words))
    for a in range(0, 200, 7):
        for b in range(200):
            x, y = Counter(words[a]), Counter(words[b])
            assert np.bitwise_count(bits[a] ^ bits[b]).sum() <= sum(((x - y) + (y - x)).values())
