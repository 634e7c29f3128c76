import random

import numpy as np

from sensorloom.llm.lines import NAME, Bloom, drop_repeated_lines

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows, least, copies):
    held = {}
    for k, t in rows:
        if k is not None:
            for line in (t or "").split("\n"):
                if len(key_of(line)) >= least:
                    held.setdefault(key_of(line), set()).add(k)
    lost = {key: max(ids) for key, ids in held.items() if len(ids) >= copies}
    out = []
    for k, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if k is None or key_of(x) not in lost or lost[key_of(x)] == k]
        out.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def result(spark, rows, kind="long", **options):
    docs = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in rows], f"doc_id {kind}, text string, n_lines string, names int, kept string")
    got = [tuple(r) for r in drop_repeated_lines(docs.repartition(5), **options).collect()]
    return sorted(got, key=repr)


def test_equals_plain(spark):
    rng = random.Random(3)
    pool = [f"line {i} " + rng.choice(["", "a", "é" * 9, "ÀB" * 5]) for i in range(40)] + ["", " ", "\t"]
    rows = []
    for i in range(400):
        lines = [rng.choice(pool) for _ in range(rng.randrange(0, 9))]
        rows.append((i, "\n".join(rng.choice(["", " ", "\x0b"]) + rng.choice([x, x.upper(), x.title()]) + rng.choice(["", "\r"]) for x in lines)))
    rows += [(1000, None), (1001, ""), (None, "\n".join(pool)), (None, None), rows[5], rows[5], (7, "line 3\nline 3"), (7, None)]
    for least, copies in ((8, 5), (1, 2), (14, 60), (100, 1), (5, 1)):
        assert result(spark, rows, least=least, copies=copies) == sorted(plain(rows, least, copies), key=repr), (least, copies)


def test_defaults_hot_line_and_long_text(spark):
    hot, rare = "Subscribe to our newsletter for more of this kind", "x" * 39 + "É"
    rows = [(i, f"own line of {i}\n {hot}\n{rare if i < 5 else rare[1:] + 'a'}") for i in range(500)]
    rows.append((900, "\n".join([hot] * 3 + [f"a line of the long text, number {i % 50000:07}, that nobody else has" for i in range(100_000)])))
    assert result(spark, rows) == sorted(plain(rows, 40, 5), key=repr)


def test_text_keys_and_empty_table(spark):
    line = "the very same line of at least forty code points"
    rows = [(f"d{i}", f"{line}\n{i}") for i in range(12)] + [(None, line)]
    assert result(spark, rows, kind="string") == sorted(plain(rows, 40, 5), key=repr)
    assert drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_filter_has_what_was_added():
    names = np.zeros(5000, NAME)
    names["low"], names["high"] = np.random.default_rng(1).integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    bloom = Bloom(2500)
    bloom.add(names[:2500])
    assert bloom.has(names[:2500]).all() and bloom.has(names[2500:]).mean() < 0.01
