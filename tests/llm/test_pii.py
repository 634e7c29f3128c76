import random
import re

from pyspark.sql import functions as F

from sensorloom.llm.pii import KINDS, mask_personal_data, personal_spans

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        twice = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(d))]
        return 12 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    out = [(m.start(), i, m.end(), k) for i, k in enumerate(KINDS) for m in re.finditer(PLAIN[k], text or "") if ok(k, m[0])]
    return sorted(out)


def test_base_equals_plain_formats(spark):
    rng = random.Random(8)
    some = ["a", "b@", "@", ".", "c.d", "1", "22", "255", "256", " ", "-", "+", "(", ")", "é", "🙂", "4111 1111 1111 1111", "4111-1111-1111-1111",
            "4041894974608795", "+1 (312) 555-0100", "1.2.3.4", "x@y.zz", "_", "\n", "0004", "10.0.0.255"]
    texts = [None, "", "a@b.c@d.e", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "9" * 5000, "a" * 20000, "1.1." * 3000, "+1+1+1 2 3 4 5 6 7 8 9",
             "x@y.zz " * 1500, "0000001.2.3.255 1.2.3.256"]
    texts += ["".join(rng.choice(some) for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "q@w.ee"), (2, "a@b.c@d.e"), (2, "other 1.2.3.4")]
    got = personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = {(i, tuple(brute(t))) for i, t in rows}
    for r in got:
        assert (r.doc_id, tuple(tuple(s) for s in r.base)) in want, [brute(t) for i, t in rows if i == r.doc_id] + [t for i, t in rows if i == r.doc_id]


def test_context_finds_unseen_identifiers(spark):
    rows = [(i, f"words here my address is user{i}@mail.com and more") for i in range(8)]
    rows += [(100 + i, f"so login code 12345{i}7 ok") for i in range(8)]
    rows += [(200, "well my address is jane77(at)mail-com and more"), (201, None), (202, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(1)).withColumn("key", F.lit(2))
    got = {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in personal_spans(docs).collect()}
    assert got[200] == [(19, 37, "email_context")]
    assert got[0] == [(25, 39, "email")]
    assert all(got[100 + i] == [] for i in range(8)) and got[201] == got[202] == []
    masked = {r.doc_id: r.text for r in mask_personal_data(docs).collect()}
    assert masked[0] == "words here my address is <EMAIL> and more"
    assert masked[200] == "well my address is <EMAIL_CONTEXT> and more"
    assert masked[201] is None and masked[202] == ""
    assert mask_personal_data(docs.limit(0)).columns == docs.columns
    assert personal_spans(docs.limit(0)).count() == 0


def test_seeds_with_blanks_and_identifiers_without_digits(spark):
    rows = [(i, f"so please (call me) at +1 (01{i}) 555-77{10 + i}. thanks") for i in range(8)]
    rows += [(20 + i, f"well mail goes to {a}@post.example today") for i, a in enumerate(["ann", "bob", "cy", "dee", "eve", "fay", "gus", "hal"])]
    rows += [(50, "so +1 (312) 555-0100 please call me) at nightline, thanks"), (51, "well mail goes to zed today")]
    # A pattern that stands before many other words is not trusted.
    rows += [(60 + i, f"it was seen on 10.0.0.{i} again") for i in range(5)] + [(70 + i, f"it was seen on {w} again") for i, w in enumerate("monday tuesday friday sunday".split())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.kind, dict(rows)[r.doc_id][s.start:s.end]) for s in r.spans] for r in personal_spans(docs).collect()}
    assert got[50] == [("phone", "+1 (312) 555-0100"), ("phone_context", "nightline")]
    assert got[51] == [("email_context", "zed")]
    assert all(got[70 + i] == [] for i in range(4)) and got[60] == [("ip", "10.0.0.0")]


def plain_bootstrap(texts, trust=0.75, support=3):
    """Seeds, patterns and instances as a graph in memory, for texts whose words are parted by single blanks and hold no base span."""
    words = {i: t.split(" ") for i, t in texts.items()}

    def value(w):
        return re.sub(r"""(?:["'][^\w]*|[.,;:!?"')\]>]+)$""", "", re.sub(r"""^["'(\[<]*""", "", w))

    def secret(v):
        return (re.fullmatch("[A-Za-z0-9_+/-]{20,}=*", v) and len(set(v)) >= 10 and sum(c.isdigit() for c in v) >= 4
                and sum(c.isalpha() for c in v) >= 4)

    spots = [(i, k, tuple(re.sub("[1-9]", "0", x).lower() for x in ws[max(0, k - 2):k]), value(ws[k]))
             for i, ws in words.items() for k in range(1, len(ws)) if value(ws[k])]
    graph = {}
    for *_, p, v in spots:
        graph.setdefault(p, set()).add(v)
    scores = {p: sum(bool(secret(v)) for v in vs) / (len(vs) + 1) for p, vs in graph.items() if sum(bool(secret(v)) for v in vs) >= support}
    return {(i, v) for i, _, p, v in spots if scores.get(p, 0) >= trust}


def test_secrets_after_a_trusted_pattern(spark):
    rng = random.Random(5)
    common = ["the", "of", "code", "is", "token", "=", "key", "and", "2021"]
    # Eight digits in a row at most, so that no secret holds a card number.
    fresh = lambda: "".join(rng.choice("abcdef" if k % 9 == 8 else "0123456789abcdef") for k in range(40))
    texts = {i: " ".join(rng.choice(common) for _ in range(rng.randrange(5, 30))) for i in range(150)}
    for i in range(60):
        # Before a secret stand `token =`, or any two words.
        lead = "token =" if i % 3 else " ".join(rng.choices(common, k=2))
        texts[200 + i] = f"{texts[i]} {lead} \"{fresh()}\"{rng.choice(['', ',', '###'])} {texts[i + 1]}"
    want = plain_bootstrap(texts)
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {(r.doc_id, texts[r.doc_id][s.start:s.end]) for r in personal_spans(docs).collect() for s in r.spans}
    assert got == want


def test_trusted_pattern_finds_short_tokens(spark):
    rng = random.Random(6)
    fresh = lambda: "".join(rng.choice("abcdef" if k % 9 == 8 else "0123456789abcdef") for k in range(40))
    texts = {i: f"some words w{i} api_token = '{fresh()}' end" for i in range(12)} | {20: "here api_token = 'hunter2' end", 21: "the hash abc4567890def123ab456 end"}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {r.doc_id: [(s.kind, texts[r.doc_id][s.start:s.end]) for s in r.spans] for r in personal_spans(docs).collect()}
    assert got[20] == [("secret_context", "hunter2")] and got[21] == [] and all(len(got[i]) == 1 for i in range(12))


def test_columns_of_any_name_and_long_texts(spark):
    names = ["_k", "_r", "_own", "_spans", "key", "row", "base", "_ROW"]
    long = "plain words " * 50_000 + "mail a.b@c.example now"
    rows = [(1, long, *names), (2, "x 10.0.0.1 y", *names), (2, "x 10.0.0.1 y", *names), (None, "z 10.0.0.2", *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    got = mask_personal_data(docs)
    assert got.columns == docs.columns
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert [r[1][-12:] for r in rows] == [" <EMAIL> now"[-12:], "x <IP> y", "x <IP> y", "z <IP>"] and all(r[2:] == tuple(names) for r in rows)
