import random
import re
from collections import Counter

from sensorloom.llm.quality import RULES, Rule, quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b c d e", "x " * 4000, "🙂 a 🙂 b\n🙂 a 🙂 b\n\n\nq",
             " ".join(str(i) for i in range(30)) + "\n" + " ".join(str(i) for i in range(30))]
    texts += ["".join(rng.choice(["a ", "b ", "c\n", "# ", "dd\t", "é "]) for _ in range(rng.randrange(200))) for _ in range(60)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "x y", None), (3, "a", 1), (3, "a", 1)]
    got = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.text


def test_rules(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat and the dog lay down by the fire"), (2, "A|B|C"), (3, None)],
                                 "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality_rules(docs, RULES).collect()} == {1: True, 2: False, 3: False}
    assert all(r.kept for r in quality_rules(docs, ()).collect())
    assert {r.doc_id: r.kept for r in quality_rules(docs, (Rule("n_words", high=1),)).collect()} == {1: False, 2: True, 3: True}
    assert quality_rules(docs.limit(0)).count() == 0


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "some words here\nsome words here", "a", "b", "c")], "doc_id long, text string, _text string, _words string, _lines string")
    got = quality_rules(docs).first()
    assert (got._text, got._words, got._lines, got.n_words, got.n_dup_lines) == ("a", "b", "c", 6, 1)
