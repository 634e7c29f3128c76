import random

import corpus_pipeline
import pytest

from sensorloom.llm.common import tokenizer_path
from tests_llm_tools import near_groups, write_tables


@pytest.fixture
def corpus(spark, tmp_path):
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("ta", "mi", "so", "ke", "lu", "ro") for b in ("ren", "dol", "vas", "pim", "gor", "tis", "qua")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, labels = [], []
    for i in range(400):
        text, toxic = prose(rng.randrange(30, 80)), i % 5 == 0
        if toxic:
            text = text.replace(" ", " zonk ", 2)
        docs.append([i, text])
        if i < 300:
            labels.append((i, 1, int(toxic)))
    items = [(k, prose(25)) for k in range(8)]
    docs += [[1000 + k, prose(20) + " " + t + " " + prose(9)] for k, t in items]
    docs += [[1100 + k, docs[k * 5 + 1][1]] for k in range(20)]                    # exact copies
    for k in range(25):                                                            # near copies, some of them within the radius
        long = prose(400).split()
        docs.append([1130 + 3 * k, " ".join(long)])
        for n in (1, 2):
            long[rng.randrange(400)] = "changed"
            docs.append([1130 + 3 * k + n, " ".join(long)])
    docs += [[1300 - 5, "word " * 60_000], [1300 - 4, None]]
    docs += [[1200 + 90, "write to me at some.one@mail.example or 10.1.2.3 " + prose(30)], [1300, None], [1301, ""], [1302, " \n"]]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    return write_tables(spark, str(tmp_path), rows, items, labels), rows, items


def test_stages(spark, corpus):
    sf_dir, rows, items = corpus
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    text = {i: t or "" for i, t, *_ in rows}
    kept = {i for i in text if " zonk " not in text[i]}
    groups = near_groups({k: text[k] for k in kept})
    assert sum(groups[i] != i for i in kept if 1130 <= i < 1205) > 10
    kept = {i for i in kept if groups[i] == i}
    kept = {i for i in kept if not any(" ".join(t.split()) in " ".join(text[i].split()) for _, t in items)}
    assert set(got) == kept
    assert all(r.round_trip for r in got.values()) and got[1296].n_tokens == 0
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path(corpus_pipeline.VOCABULARY))
    for i in kept:
        want = text[i].replace("some.one@mail.example", "<EMAIL>").replace("10.1.2.3", "<IP>")
        assert list(got[i].token_ids) == library.encode(want, add_special_tokens=False).ids


def test_columns_and_empty_input(spark, corpus):
    sf_dir, _, _ = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == corpus_pipeline.COLUMNS
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == 0
