"""Byte-level BPE in linear time, and decoding by offsets.

Encoder. The longest token that starts at a place of a piece of text is found by its first four bytes, and, where longer
tokens start like that, by the next ones. The encoder takes that token if it may stand
next to the token before it, and otherwise the next shorter one; where none fits it steps back by
one token and never visits a dead place twice. Two tokens may stand side by side if merging by
rank would leave them apart; that is worked out from the merges and kept in a table of pairs.
The first sequence that reaches the end is the one that merging by rank gives.

Decoder. The bytes of all tokens lie in one array; a token is a range of it.

The corpus is a narrow Arrow pass: no shuffle, and a task holds a batch of texts, the vocabulary
and a table of frequent pieces of bounded size.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the published split of byte-level BPE into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The same split for text of these characters alone, of which it is known which are letters, numbers and blanks; the standard
#: library's matcher is several times faster.
LATIN = re.compile(r"[\t\n\r -~¡-ɏ]*")
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r"\t\n\r "
LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
LATIN_WORD = re.compile(rf" ?[{_L}]+")

#: A piece always ends before a blank that one of these characters follows.
CHUNKS = re.compile(r"(?= [!-~¡-ᙿ])")

CACHE = 150_000  # chunks whose tokens a worker keeps, twice at most; workers live on beside later stages
SHORT = 4  # bytes by which the longest token at a place is looked up first
NEW = -2  # no token of this place was tried
PAIRS = 1_000_003  # places for pairs of tokens known to fit or not: a prime, eight bytes each


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves,
    the others moved up to 256 and above, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Vocabulary:
    """Tokens, merges and special strings of a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        tokens = {i: as_bytes(t) for t, i in model["vocab"].items() if t not in self.special}
        size = 1 + max([*tokens, *self.special.values()])
        # Ids that the file leaves out decode to nothing.
        self.bytes_of = [tokens.get(i, b"") for i in range(size)]
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank: dict[int, int] = {}   # pair, as left * size + right -> rank of its merge
        # The pair that a token is made of, and the rank; -1 for none.
        self.left, self.right, self.made = [-1] * size, [-1] * size, [-1] * size
        for r, (a, b) in enumerate(merges):
            left, right, whole = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.rank[left * size + right] = r
            if self.made[whole] < 0:
                self.left[whole], self.right[whole], self.made[whole] = left, right, r
        self.prefix = [-1] * size  # the next shorter token that a token starts with
        self.length = [len(t) for t in self.bytes_of]
        id_of = {t: i for i, t in tokens.items()}
        for i, t in tokens.items():
            shorter = next((id_of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in id_of), -1)
            self.prefix[i] = shorter
        # Tokens as texts of a character a byte, and starts of 4, 8, 16, ... bytes that longer tokens have.
        self.token_of = {t.decode("latin-1"): i for i, t in tokens.items()}
        self.longer = {t[:n] for t in self.token_of for n in (SHORT << k for k in range(len(t).bit_length())) if n < len(t)}
        self.short: dict[str, int] = {}  # start -> twice its longest token, plus 1 if a longer one may start there
        self.written = [str(i) for i in range(size)]
        ends = np.cumsum([0, *map(len, self.bytes_of)])
        self.blob, self.start = np.frombuffer(b"".join(self.bytes_of), np.uint8), ends[:-1]
        self.size = np.diff(ends)
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # Twice the number of a pair, plus 1 if it fits, at a place that the number gives; a later pair takes the place.
        self.pairs = array("q", [-1]) * PAIRS

    def fits(self, left: int, right: int) -> bool:
        """May these tokens stand side by side, or would a merge across their border come first?"""
        pair = left * len(self.prefix) + right
        known = self.pairs[pair % PAIRS]
        if known >> 1 != pair:
            known = self.pairs[pair % PAIRS] = 2 * pair + self._apart(left, right)
        return known & 1 == 1

    def _apart(self, left: int, right: int) -> bool:
        """Undo the latest merge on either side of the border, again and again.

        At each state the tokens at the border are those of the moment before that merge; a merge
        across the border that ranks before it would have happened. On equal rank the left goes first.
        """
        rank, made, size = self.rank, self.made, len(self.prefix)
        until = len(rank)
        after_left = False  # does a border merge of the same rank as `until` come too late?
        while True:
            r = rank.get(left * size + right)
            if r is not None and (r < until or r == until and not after_left):
                return False
            a, b = made[left], made[right]
            if a > b:
                # Merges of one rank run from left to right: the one inside `left` came before the border's.
                left, until, after_left = self.right[left], a, True
            elif b >= 0:
                right, until, after_left = self.left[right], b, False
            else:
                return True

    def _start(self, start: str) -> int:
        """The entry of `short` for up to four bytes."""
        if len(self.short) >= CACHE:
            self.short.clear()
        token = next((self.token_of[start[:n]] for n in range(len(start), 0, -1) if start[:n] in self.token_of), -1)
        found = self.short[start] = 2 * token + (start in self.longer)
        return found

    def _long(self, piece: str, at: int, token: int) -> int:
        """The longest token at a place where four bytes are the start of longer ones; `token` if there is none."""
        size = 2 * SHORT
        start = piece[at:at + size]
        while len(start) == size and start in self.longer:
            size *= 2
            start = piece[at:at + size]
        for n in range(len(start), SHORT, -1):
            found = self.token_of.get(start[:n])
            if found is not None:
                return found
        return token

    def encode_piece(self, piece: bytes) -> list[int]:
        n, letters = len(piece), piece.decode("latin-1")
        short = self.short
        dead = bytearray(n + 1)
        out: list[int] = []
        length, prefix, pairs, size = self.length, self.prefix, self.pairs, len(self.prefix)
        at, token, before = 0, NEW, -1
        while at < n:
            if token == NEW:
                start = letters[at:at + SHORT]
                found = short.get(start)
                if found is None:
                    found = self._start(start)
                token = self._long(letters, at, found >> 1) if found & 1 else found >> 1
            while token >= 0:
                end = at + length[token]
                if not dead[end]:
                    if before < 0:
                        break
                    pair = before * size + token
                    known = pairs[pair % PAIRS]
                    if known & 1 if known >> 1 == pair else self.fits(before, token):
                        break
                token = prefix[token]
            if token >= 0:
                out.append(token)
                at, before, token = end, token, NEW
            elif out:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
                token, before = prefix[token], out[-1] if out else -1
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.blob[np.arange(total) + np.repeat(self.start[ids] - (ends - sizes), sizes)].tobytes()


class Recent(dict):
    """What was looked up lately: when `size` entries have come in, those not used since the last time go."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def keep(self, key, value):
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def __missing__(self, key):
        value = self.old.get(key)
        return value if value is None else self.keep(key, value)


class Codec:
    """Encoder and decoder with tables of recent chunks and pieces."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.piece = regex.compile(PIECES)
        self.chunks, self.known = Recent(CACHE), Recent(CACHE // 4)

    def _chunk(self, chunk: str) -> bytes:
        v = self.vocabulary
        if chunk.isascii() and chunk[chunk[0] == " ":].isalpha() or LATIN_WORD.fullmatch(chunk):
            pieces = [chunk]
        else:
            pieces = (LATIN_PIECES if LATIN.fullmatch(chunk) else self.piece).findall(chunk)
        if len(pieces) == 1:
            ids = v.encode_piece(chunk.encode())
        else:
            ids = []
            for piece in pieces:
                tokens = self.known[piece]
                if tokens is None:
                    tokens = v.encode_piece(piece.encode())
                    if len(piece) < 64:
                        self.known.keep(piece, tokens)
                ids += tokens
        found = array("i", ids).tobytes()
        return self.chunks.keep(chunk, found) if len(chunk) < 64 else found

    def _plain(self, text: str) -> list[bytes]:
        known = self.chunks
        return [known[c] or self._chunk(c) for c in CHUNKS.split(text) if c]

    def ids(self, text: str) -> np.ndarray:
        """Token ids."""
        found: list[bytes] = []
        if self.vocabulary.split_special and any(s in text for s in self.vocabulary.special):
            for k, part in enumerate(self.vocabulary.split_special.split(text)):
                if k % 2:
                    found.append(np.int32(self.vocabulary.special[part]).tobytes())
                elif part:
                    found += self._plain(part)
        else:
            found = self._plain(text)
        return np.frombuffer(b"".join(found), np.int32)

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Token ids, and their decimal form joined by commas."""
        ids = self.ids(text)
        return ids, ",".join(map(self.vocabulary.written.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.vocabulary.decode(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per worker process."""
    return Codec(path)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All of `docs` plus `token_ids` (array of int); a null or empty text has no tokens.

    Special strings of the vocabulary in a text become their ids, as the tokenizers library has it.
    Rows are taken one by one, so repeated rows and ties need no rule. A column of the result's
    name is replaced.
    """
    return _mapped(docs.drop("token_ids"), path, text, "token_ids array<int>", lambda c, t: (c.ids(t),),
                   [pa.list_(pa.int32())])


def decode(tokens: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """All of `tokens` plus `decoded`; null ids decode to the empty text, broken UTF-8 to U+FFFD."""
    return _mapped(tokens.drop("decoded"), path, ids, "decoded string",
                   lambda c, x: (c.decode(np.array(x or [], np.int32)),), [pa.string()])


def encode_and_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All of `docs` plus `token_ids` and `decoded`, as `decode` after `encode`, but in one pass and so with one codec a task."""
    def both(c: Codec, value: str) -> tuple:
        ids = c.ids(value)
        return ids, c.decode(ids)

    return _mapped(docs.drop("token_ids", "decoded"), path, text, "token_ids array<int>, decoded string", both, [pa.list_(pa.int32()), pa.string()])


def digest_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All of `docs` plus counts and digests of its tokens and of what they decode to."""
    def digests(c: Codec, value: str) -> tuple:
        ids, written = c.encode(value)
        return (len(ids), hashlib.sha256(written.encode()).hexdigest(),
                hashlib.sha256(c.decode(ids).encode()).hexdigest())

    return _mapped(docs.drop("n_tokens", "ids_sha256", "decoded_sha256"), path, text,
                   "n_tokens long, ids_sha256 string, decoded_sha256 string", digests,
                   [pa.int64(), pa.string(), pa.string()])


def _mapped(df: DataFrame, path: str, name: str, added: str, use, types: list[pa.DataType]) -> DataFrame:
    """`df` with columns that `use(codec, value)` gives for column `name`, in batches."""
    names = [x.split(" ")[0] for x in added.split(", ")]
    schema = df.schema
    out = df.select("*", *[F.lit(None).cast(x.split(" ")[1]).alias(x.split(" ")[0]) for x in added.split(", ")]).schema

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in source:
            values = batch.column(schema.names.index(name))
            # Slices keep what is built beside a batch of long texts small.
            for at in range(0, max(1, batch.num_rows), 256):
                part = batch.slice(at, 256)
                found = [use(c, v if v is not None else "") for v in values.slice(at, 256).to_pylist()]
                more = [pa.array([f[k] for f in found], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*schema.names, *names])

    return df.mapInArrow(batches, out)
