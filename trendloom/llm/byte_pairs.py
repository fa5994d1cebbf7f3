"""Byte-level BPE by a sentencepiece model that is written from a rank file.

Each byte of the vocabulary stands as one character, so that a piece of bytes is a string of
ordinary characters; a piece's score is its negative rank, and the normaliser changes nothing.
Sentencepiece then merges the pair of lowest rank first and the leftmost of equals, as the
rank file asks for. Texts are cut into pre-tokens by a pattern, and each is encoded on its own;
ids are decoded by the inverse of the byte mapping.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.storage import bounded_batches

FIRST_CHAR = 0x100  # the character of byte 0
CACHED = 1 << 18  # distinct pre-tokens whose ids a task remembers
GROUP_CHARS = 1 << 20  # of texts that are looked up at once
CACHED_CHARS = 48  # of the longest remembered

# Fields and enumerators of the model format that are used here.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE = 3, 4
BPE = 2
NAME, DUMMY_PREFIX, EXTRA_WHITESPACES, ESCAPE_WHITESPACES = 1, 3, 4, 5

CHARS = [chr(FIRST_CHAR + byte) for byte in range(256)]
TO_CHARS = {byte: char for byte, char in enumerate(CHARS)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token -> rank of a file with lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def as_chars(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_CHARS)


def serialized(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a vocabulary, which holds every single byte. Piece i + 1 is
    the token of the i-th smallest rank; piece 0 is the unknown one and never comes up."""
    if missing := [byte for byte in range(256) if bytes([byte]) not in ranks]:
        raise ValueError(f"the vocabulary lacks the bytes {missing}")
    tokens = sorted(ranks, key=ranks.get)
    pieces = [_bytes(PIECES, _bytes(PIECE, b"<unk>") + _number(TYPE, UNKNOWN))]
    for token in tokens:
        piece = _bytes(PIECE, as_chars(token).encode())
        pieces.append(_bytes(PIECES, piece + _float(SCORE, -ranks[token]) + _number(TYPE, NORMAL)))
    trainer = _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, len(tokens) + 1)
    normalizer = _bytes(NAME, b"identity") + _number(DUMMY_PREFIX, 0) + _number(
        EXTRA_WHITESPACES, 0) + _number(ESCAPE_WHITESPACES, 0)
    return b"".join(pieces) + _bytes(TRAINER, trainer) + _bytes(NORMALIZER, normalizer)


@cache
def _processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def _pieces(model: bytes, tokens: list[bytes]) -> list[list[int]]:
    """Piece numbers, from 0, of each pre-token's bytes."""
    found = _processor(model).encode([as_chars(t) for t in tokens], num_threads=1)
    return [[piece - 1 for piece in pieces] for pieces in found]


class Vocabulary:
    """A rank file as a sentencepiece model. Its size is that of the vocabulary, whatever the
    corpus: this is what travels to the executors."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.tokens = sorted(ranks, key=ranks.get)
        self.ids = [ranks[token] for token in self.tokens]
        self.model = serialized(ranks)
        # Tokens that merging does not arrive at; as whole pre-tokens they are one id still.
        self.whole = {token.decode(): _packed([self.ids[i]]) for i, (token, pieces) in enumerate(zip(
            self.tokens, _pieces(self.model, self.tokens))) if pieces != [i] and _is_text(token)}


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(read_ranks(path), pattern)


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    """Consecutive texts of about GROUP_CHARS together: the model takes many new pre-tokens at
    once for less than each alone."""
    group, chars = [], 0
    for value in texts:
        group.append(value.as_py() or "")
        chars += len(group[-1])
        if chars > GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(doc_id, ids) per row of ``docs``: the token ids of the whole text, without special
    tokens; a NULL or empty text has none. Keys may be NULL or repeated, one row comes out for
    each row that goes in; an empty table gives no rows. Other columns are not read."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        pre_tokens = regex.compile(own.pattern).findall
        known: dict[str, bytes] = {}

        def looked_up(tokens: set[str]) -> dict[str, bytes]:
            """The packed ids of at least these pre-tokens. Long ones are not remembered."""
            nonlocal known
            if len(known) > CACHED:
                known = {}
            new = [t for t in tokens if t not in known]
            if not new:
                return known
            pieces = _pieces(own.model, [t.encode() for t in new])
            found = {t: own.whole.get(t) or _packed([own.ids[p] for p in ps])
                     for t, ps in zip(new, pieces)}
            short = {t: ids for t, ids in found.items() if len(t) <= CACHED_CHARS}
            known.update(short)
            return known if len(short) == len(found) else known | found

        for batch in batches:
            packed = []
            for texts in _groups(batch.column(1)):
                tokens = [pre_tokens(text) for text in texts]
                ids = looked_up(set().union(*tokens))
                packed += [b"".join(map(ids.__getitem__, own_tokens)) for own_tokens in tokens]
            lists = [np.frombuffer(ids, np.int32) for ids in packed]
            offsets = np.concatenate(([0], np.cumsum([len(ids) for ids in lists])))
            values = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))],
                names=["doc_id", "ids"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, decoded) per row of (doc_id, ids): the bytes of the ids, by the model's
    pieces and the inverse of the byte mapping. NULL ids give NULL, no ids give no bytes; an
    id that the vocabulary does not hold is an error."""
    bounded_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        processor = _processor(own.model)
        table = {i: bytes(ord(char) - FIRST_CHAR for char in processor.id_to_piece(piece + 1))
                 for piece, i in enumerate(own.ids)}
        for batch in batches:
            texts = [None if ids.values is None else b"".join(map(
                table.__getitem__, ids.values.to_pylist())) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.binary())],
                names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(
        decoded, "doc_id long, ids array<int>, decoded binary")
