import random

import numpy as np
from pyspark.sql import functions as F

from sensorloom.llm.toxicity import Chain, Linear, features, fit_chain, label_categories, score, toxicity, train

BAD = ["blorp", "zonk", "vexling", "vexado", "vexuna"]


def corpus(n=1200):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("ta", "mi", "so", "ke", "lu") for b in ("ren", "dol", "vas", "pim", "gor", "tis")]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        toxic, low = rng.random() < 0.2, rng.random() < 0.2
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(BAD)
        if low:
            text += ["spamword"] * 2
        rows.append((i, " ".join(text), int(not low), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _, _ in rows] + [(None, "a", 1.0), (5000, None, 1.0), (5001, "", 1.0),
                                 (5002, "tadol " * 50000, 1.0), (3, rows[3][1], 1.0)], "doc_id long, text string, p_toxic double")
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows[:800]] + [(None, 1, 1), (7, None, None), (9999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows) + 5
    found = {r.doc_id: r.rejected for r in got}
    held = rows[800:]
    assert np.mean([found[i] == bool(t) for i, _, _, t in held]) > 0.99
    assert not any(found[i] for i in (None, 5000, 5001, 5002))


def test_chain_uses_earlier_categories():
    rng = random.Random(1)
    rows = [[0] if rng.random() < 0.5 else [1] for _ in range(400)]
    first = np.array([int(0 in r) for r in rows])
    chain = fit_chain(rows, ["x", "y"], np.column_stack([first, first]), np.ones(400), ("a", "b"))
    assert chain.models[1].chain[0] > 0.5
    p = Chain(("a", "b"), (Linear({"x": 2.0}, (), 0.0), Linear({}, (4.0,), -2.0)))
    assert p.predict("x")[1] > 0.5 > p.predict("nothing")[1] - 0.01
    assert features("Vexling at") == {"vexling", "vexl-", "at"}


def test_no_labels_or_one_class(spark):
    docs = spark.createDataFrame([(1, "blorp")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not toxicity(docs, none).first().rejected
    clean = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert not toxicity(docs, clean).first().rejected
    assert toxicity(docs.limit(0), clean).count() == 0
    again = train(docs, clean.union(clean), label_categories())
    assert score(docs.withColumn("x", F.lit(1)), again).columns == ["doc_id", "text", "x", "p_low_quality", "p_toxic"]
