import random
import re

from sensorloom.llm.licenses import BASE, license_scan, license_spans


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    starts, labels = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += at
        if at:
            labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_equals_brute_force(spark):
    rng = random.Random(3)
    some = ["GNU", "general", "Public", "license,", "apache", "License", "CC-BY", "cc", "by", "mit", "ünïcode", "x1", "by-NC", "\n", "the"]
    texts = [None, "", "...", "MIT License", "cc by cc by", "CC BY-NC 4.0", "GNU General\nPublic  License", "mit  license " * 3000]
    texts += [" ".join(rng.choice(some) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(None, "MIT license", "z"), (3, "MIT License", "z"), (3, "other", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = license_scan(docs).collect()
    assert len(got) == len(rows)
    want = {(i, *brute(t)) for i, t, _ in rows}
    assert {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == want
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert license_scan(docs.limit(0)).count() == 0


def test_neighbouring_diagonals(spark):
    text = "before this: Redistribution and use in source and binary forms, with or WITHOUT any modification are permitted. After"
    docs = spark.createDataFrame([(1, text), (2, "source and binary of the use in source")], "doc_id long, text string")
    found = license_spans(docs, ["doc_id"]).collect()
    assert [(r.doc_id, r.label, r.start, r.end) for r in found] == [(1, "bsd", 2, 17)]
    assert 0.8 < found[0].score < 1
