"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The vocabulary is a file in the format of the tokenizers library (byte-level BPE); its path is
a parameter. Texts are cut at special tokens and by the pattern of byte-level BPE. Within a
piece, every prefix has exactly one last token: the token that ends there, follows the last
token of the prefix before it, and is compatible with it. Candidates come from an automaton
over all tokens, whose suffix links give every token that ends at a position; two neighbours
are compatible if no merge across their border would have come before the merges that built
them. Back-pointers from the last prefix give the ids.

Defined results: null and empty texts have no ids and decode to the empty text; texts and
pieces of any length are encoded whole, in time linear in their length times the longest
token; repeated rows are encoded alike; an empty table gives an empty result; only the named
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchlake.llm.common import query, table

# Fixed value: the pattern of byte-level BPE.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
          r"|\s+(?!\S)|\s+")
# Chunks, pieces and pairs of one generation that a worker remembers, and their longest length;
# results do not depend on it.
REMEMBERED = 200_000
REMEMBERED_LENGTH = 64
# White space of any kind; a space beside it cannot be told from it without a closer look.
BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace()]
ASCII_BLANKS = [c for c in BLANKS if c.isascii()]
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in vocabulary files: printable Latin-1 for itself, the
    others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """Bytes of every token, merges in their order as pairs of ids, special tokens."""
    tokens: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters = byte_letters()
    ids = content["model"]["vocab"]
    tokens = {i: bytes(letters[c] for c in t) for t, i in ids.items()}
    merges = []
    for pair in content["model"]["merges"]:
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges.append((ids[a], ids[b], ids[a + b]))
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    tokens |= {i: t.encode() for t, i in special.items()}
    return Vocabulary(tokens, merges, special)


class Remembered(dict):
    """Results of a function, in two generations: what a full generation asked for stays
    until the next one is full."""

    def __init__(self, of):
        super().__init__()
        self.of, self.older = of, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.of(key)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        if self.fits(key):
            self[key] = value
        return value

    def fits(self, key) -> bool:
        return len(key) <= REMEMBERED_LENGTH

    def forget(self) -> None:
        self.older = {}
        self.clear()


class RememberedPairs(Remembered):
    """Results for pairs of tokens, each known by one number."""

    def fits(self, key) -> bool:
        return True


@dataclass
class Encoder:
    vocabulary: Vocabulary

    def __post_init__(self):
        self.pieces = Remembered(self._piece)
        self.chunks = Remembered(self._chunk)
        v = self.vocabulary
        self.width = width = max(v.tokens, default=0) + 1
        self.breaks = RememberedPairs(lambda pair: self._crossed(*divmod(pair, width), NEVER))
        self.rank = {(a, b): r for r, (a, b, _) in reversed(list(enumerate(v.merges)))}
        self.parts = {}
        for r, (a, b, c) in enumerate(v.merges):
            self.parts.setdefault(c, (a, b, r))
        self.right = {t: self._spine(t, 1) for t in v.tokens}
        self.left = {t: self._spine(t, 0) for t in v.tokens}
        special = set(v.special.values())
        self.automaton = ahocorasick.Automaton()
        self.bytes = {raw[0]: t for t, raw in v.tokens.items()
                      if len(raw) == 1 and t not in special}
        for t, raw in v.tokens.items():
            if t not in special and len(raw) > 1 and self._stands(t):
                self.automaton.add_word(raw.decode("latin-1"), (t, len(raw)))
        self.automaton.make_automaton()
        self.pattern = regex.compile(PIECES)
        self.cut = regex.compile("|".join(
            regex.escape(s) for s in sorted(v.special, key=len, reverse=True)) or r"(?!)")

    def forget(self) -> None:
        """Give back what was remembered of texts."""
        self.pieces.forget()
        self.chunks.forget()

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The token, its outer part, the outer part of that, and so on, each with the rank of
        the merge that takes it in."""
        spine, taken = [(token, NEVER)], self.parts.get(token)
        while taken:
            spine.append((taken[side], taken[2]))
            taken = self.parts.get(taken[side])
        return spine

    def _crossed(self, a: int, b: int, until: int) -> bool:
        """Whether a merge across the border of two neighbours comes before ``until`` and
        before both of the parts that it joins are taken in on their own side.

        The left one of two equal merges that overlap comes first.
        """
        right, left = self.right[a], self.left[b]
        i, j = len(right) - 1, len(left) - 1
        while True:
            (x, x_taken), (y, y_taken) = right[i], left[j]
            rank = self.rank.get((x, y))
            if rank is not None and rank < min(x_taken, until) and rank <= y_taken:
                return True
            if i == 0 and j == 0:
                return False
            if x_taken <= y_taken:
                i -= 1
            else:
                j -= 1

    def _stands(self, token: int) -> bool:
        """Whether the bytes of a token encode to the token itself."""
        parts = self.parts.get(token)
        if parts is None:
            return len(self.vocabulary.tokens[token]) == 1
        a, b, rank = parts
        return self._stands(a) and self._stands(b) and not self._crossed(a, b, rank)

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one piece.

        The token of a single byte is the last one where no longer token is.
        """
        breaks, width = self.breaks, self.width
        last = [0, *map(self.bytes.__getitem__, raw)]
        size = [1] * len(last)
        for end, (token, length) in self.automaton.iter(raw.decode("latin-1")):
            if size[end + 1] == 1:
                before = end + 1 - length
                if not before or not breaks[last[before] * width + token]:
                    last[end + 1], size[end + 1] = token, length
        ids, at = [], len(raw)
        while at:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def _piece(self, text: str) -> bytes:
        ids = self.piece(text.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def packed(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        out, start = [], 0
        if text:
            for hit in self.cut.finditer(text):
                out.append(self._plain(text[start:hit.start()]))
                out.append(self.vocabulary.special[hit.group()].to_bytes(4, "little"))
                start = hit.end()
            out.append(self._plain(text[start:] if start else text))
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        A space between two other characters that are not white space always starts a piece,
        so a text whose spaces are all of this kind is a sequence of independent chunks.
        """
        for blank in ASCII_BLANKS if text.isascii() else BLANKS:
            # Most blanks are in no text at all, which is told faster than a pair is found.
            if blank in text and (blank + " " in text or " " + blank in text):
                return self._cut(text)
        first, *chunks = text.split(" ")
        return self._cut(first) + b"".join(map(self.chunks.__getitem__, chunks))

    def _chunk(self, text: str) -> bytes:
        """Ids of a space and the chunk behind it; letters alone are one piece with it."""
        if text.isascii() and text.isalpha():
            return self._piece(" " + text)
        return self._cut(" " + text)

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def text(self, ids) -> str:
        return text_of_ids(self.vocabulary, ids)


def text_of_ids(vocabulary: Vocabulary, ids) -> str:
    """Text of ids; bytes that are not UTF-8 become replacement characters."""
    tokens = vocabulary.tokens
    return b"".join([tokens[i] for i in ids]).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def _encoder(shared, name: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    if name not in _encoders:
        _encoders[name] = Encoder(shared.value)
    return _encoders[name]


def _share(spark: SparkSession, path: str):
    """The vocabulary for the workers, with a name that follows its content."""
    vocabulary = read_vocabulary(path)
    name = hashlib.sha256(repr((sorted(vocabulary.tokens.items()), vocabulary.merges,
                                vocabulary.special)).encode()).hexdigest()
    return spark.sparkContext.broadcast(vocabulary), name


def _by_text(docs: DataFrame, path: str, id_col: str, text_col: str, results,
             kinds: str) -> DataFrame:
    """One row per input row: id, and what ``results`` makes of an encoder and a text."""
    shared, name = _share(docs.sparkSession, path)
    columns = [kind.split()[0] for kind in kinds.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shared, name)
        try:
            for frame in frames:
                made = zip(*[results(encoder, t) for t in frame["text"]])
                yield pd.DataFrame({"id": frame["id"]} | {
                    c: pd.Series(list(v), index=frame.index) for c, v in zip(columns, made)},
                    columns=["id", *columns])
        finally:
            # A worker that waits for its next task holds no texts; that task may be another step's.
            encoder.forget()

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    return named.mapInPandas(run, f"id {kind}, {kinds}").withColumnRenamed("id", id_col)


def _ids(encoder: Encoder, text: str | None) -> tuple:
    return (np.frombuffer(encoder.packed(text), "<i4"),)


def _digests(encoder: Encoder, text: str | None) -> tuple:
    """Number and digest of the ids, and digest of the text that they are decoded to."""
    packed = encoder.packed(text)
    decoded = encoder.text(np.frombuffer(packed, "<u4").tolist())
    return (len(packed) // 4, hashlib.sha256(packed).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per input row: id and ids, an array of int."""
    return _by_text(docs, path, id_col, text_col, _ids, "ids array<int>")


def decoder(spark: SparkSession, path: str):
    """Column function from ids to text."""
    shared, _ = _share(spark, path)

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        vocabulary = shared.value
        return pd.Series([text_of_ids(vocabulary, i.tolist()) for i in ids], dtype=object)
    return decode


def digests(docs: DataFrame, path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Number and digest of the ids of every document, and digest of the text they give.

    Encoding and decoding share a pass, so that ids need not leave the worker in between.
    """
    return _by_text(docs, path, id_col, text_col, _digests,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string")


def byte_bpe() -> str:
    """Path of the public vocabulary that the queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_bpe")
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"), byte_bpe())
