import hashlib
import random

import pytest

from sensorloom.llm.bpe import Codec, decode, digest_tokens, encode, encode_and_decode
from sensorloom.llm.common import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path("byte_bpe_50k.json")
ODD = [None, "", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>", " ", "  a", "\n\n a \n", "a b \x1c c \x85 d",
       "a" * 500, " " * 50, "it's we'll I'D 12345 ½ Ⅷ ²", "🙂🙂 👩‍👩‍👧", "x y", "\x01 \x7f", "ab " * 20000]


def texts():
    rng = random.Random(5)
    some = ["a", "b", "e", "th", "he", "in", " ", "  ", "\n", "é", "1", "!", "'s", "\t", "<|", "|>", "\x1c", "n", "ing", "er"]
    yield from ODD
    for _ in range(1500):
        yield "".join(rng.choice(some) for _ in range(rng.randrange(60)))
    for _ in range(500):
        yield "".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x2000, 0x3100)])) for _ in range(rng.randrange(30)))


def test_equals_the_library():
    library, own = tokenizers.Tokenizer.from_file(PATH), Codec(PATH)
    for text in texts():
        ids, written = own.encode(text or "")
        assert list(ids) == library.encode(text or "", add_special_tokens=False).ids, text
        assert written == ",".join(map(str, ids))
        assert own.decode(ids) == (text or "")
    broken = [x for x in range(200, 256)]
    import numpy as np
    assert own.decode(np.array(broken, np.int32)) == library.decode(broken, skip_special_tokens=False)


def test_frames(spark):
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(None, "x", 1), (1, "again", 2), (1, "again", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids int")
    both = decode(encode(docs, PATH), PATH).collect()
    assert sorted(map(repr, both)) == sorted(map(repr, encode_and_decode(docs, PATH).collect()))
    assert len(both) == len(rows) and all(r.decoded == (r.text or "") for r in both)
    for r in digest_tokens(docs, PATH).collect():
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert encode(docs.limit(0), PATH).count() == 0


def test_latin_split_equals_the_published_one():
    """The quicker split of plain text gives the same pieces, whatever the order of its characters."""
    import random

    import regex

    from sensorloom.llm import bpe
    rng, whole = random.Random(4), regex.compile(bpe.PIECES)
    alphabet = [c for c in map(chr, range(0x250)) if bpe.LATIN.fullmatch(c)]
    assert all(whole.findall(c) == bpe.LATIN_PIECES.findall(c) for c in alphabet) and "\x1c" not in alphabet and "\xa0" not in alphabet
    for _ in range(20_000):
        text = "".join(rng.choice([rng.choice(alphabet), *" \n\t'stredmvlaé7²."]) for _ in range(rng.randrange(1, 14)))
        assert bpe.LATIN_PIECES.findall(text) == whole.findall(text), text
        assert (bpe.LATIN_WORD.fullmatch(text) is None) or whole.findall(text) == [text]


def test_tables_of_a_codec_are_small_and_exact():
    """Ids alone are kept for a chunk, pairs take a fixed room, and tokens of any length are found by their starts."""
    library, own = tokenizers.Tokenizer.from_file(PATH), Codec(PATH)
    tokens = sorted(own.vocabulary.token_of, key=len)[-300:]
    for text in [*("".join(own.vocabulary.bytes_of[own.vocabulary.token_of[t]].decode("utf-8", "ignore") for t in tokens[i:i + 3])
                   for i in range(0, 300, 3)), *("=" * n + " " * n + "ab" * n for n in range(1, 200, 7))]:
        assert own.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert all(type(kept) is bytes for kept in own.chunks.values())
    assert own.vocabulary.pairs.itemsize * len(own.vocabulary.pairs) < 10_000_000
