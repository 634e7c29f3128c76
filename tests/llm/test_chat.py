import random

from sensorloom.llm.chat import TRAINED, prefix_tree, read_back, read_conversations, segment
from sensorloom.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
ODD = ["", "<|end|>\n", "<|user|>\nhi<|end|>\n", "\\", "<\\|", "a<", "|>\n", "</s>[INST] ok [/INST]", "<|endoftext|>", "\\<|", "🙂\n\n", "|>"]


def test_template_is_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        turns = [("".join(rng.choice(["a", "|", "\\", "p", ">", "<", "\n", "end"]) for _ in range(rng.randrange(4))),
                  "".join(rng.choice(ODD) for _ in range(rng.randrange(4)))) for _ in range(rng.randrange(4))]
        assert read_back("".join("".join(segment(*t)) for t in turns)) == turns


def test_tree(spark):
    rng = random.Random(2)
    texts = ODD + [f"words {i} and more" for i in range(6)] + ["long " * 5000, None]
    rows = []
    for c in range(60):
        turns = [("user" if k % 2 == 0 else "assistant", rng.choice(texts[:3] if k < 2 else texts)) for k in range(rng.randrange(1, 6))]
        rows += [(c, k, r, t, "x") for k, (r, t) in enumerate(turns)]
    rows += [(c + 100, k, r, t, x) for c, k, r, t, x in rows]          # every conversation once more
    rows += [(None, 0, None, None, "x"), (500, None, "a|>b", "t", "x"), (500, 1, TRAINED, "q", "x"), (500, 1, TRAINED, "q", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tokens string")
    want = {}
    for c, k, r, t, _ in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, -1 if x[1] is None else x[1], x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((r or "", t or ""))
    nodes, leaves = prefix_tree(turns, PATH)
    back = read_conversations(nodes, leaves, PATH).collect()
    assert len(back) == len(want)
    for r in back:
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert list(r.loss) == [t for role, t in want[r.conv_id] if role == TRAINED]
        assert r.formatted == "".join("".join(segment(*t)) for t in want[r.conv_id])
    found = {r.node: r for r in nodes.collect()}
    prefixes = {tuple(t[:k + 1]) for t in want.values() for k in range(len(t))}
    assert len(found) == len(prefixes)
    # Depth first, without gaps: children follow their parent inside its subtree.
    order = sorted(found.values(), key=lambda r: r.start)
    at, open_ = 0, []
    for r in order:
        assert r.start == at
        at += len(r.tokens)
        while open_ and open_[-1] not in r.ancestors:
            open_.pop()
        assert open_ == list(r.ancestors)
        open_.append(r.node)
        spans = [(found[a].start, found[a].start + len(found[a].tokens)) for a in r.ancestors]
        assert r.position == sum(e - s for s, e in spans)
        covered = [x for s, e in spans for x in range(s, e)]
        assert [x for i in r.attends for x in range(i.start, i.end)] == covered
    none = turns.limit(0)
    assert read_conversations(*prefix_tree(none, PATH), PATH).count() == 0
