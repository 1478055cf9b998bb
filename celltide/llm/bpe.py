"""Byte-level BPE encoding and decoding through a sentencepiece model written from a rank file.

The model is the vocabulary itself, serialised: each token is a piece of
characters that stand for bytes one by one, scored by its negative rank, so
the highest-scored merge is the lowest rank; normalisation is the identity.
Each pre-token is encoded on its own; decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from celltide.llm.common import table, without

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes stand as the characters from here on: letters that no text rule of sentencepiece treats specially.
_FIRST = 0x100
_AS_CHARS = {b: chr(_FIRST + b) for b in range(256)}
_CACHED = 200_000
_CACHED_CHARS = 48
_PIECES_AT_ONCE = 100_000
_CHARS_AT_ONCE = 1_000_000


def read_ranks(path: str = RANKS) -> list[bytes]:
    """Tokens by rank, from lines of base64 and rank; ranks must run from 0 without gaps."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranked[i] for i in range(len(ranked))]


def _mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_AS_CHARS)


def _varint(n: int) -> bytes:
    out, n = bytearray(), n & ((1 << 64) - 1)
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes((*out, n))


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model: piece i is token i, and the unknown piece comes last.

    Field numbers are those of sentencepiece's public model format.
    """
    missing = set(range(256)) - {t[0] for t in tokens if len(t) == 1}
    if missing or len(set(tokens)) < len(tokens):
        raise ValueError("the vocabulary must hold every single byte, and no token twice")
    out = bytearray()
    for rank, token in enumerate(tokens):
        score = _varint(2 << 3 | 5) + struct.pack("<f", -rank)
        out += _block(1, _block(1, _mapped(token).encode()) + score + _number(3, 1))  # a normal piece
    out += _block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0) + _number(3, 2))
    trainer = _number(3, 2) + _number(4, len(tokens) + 1)  # BPE
    trainer += _number(40, len(tokens)) + b"".join(_number(f, -1) for f in (41, 42, 43))  # no other special pieces
    normalizer = _block(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5))  # white space as it is
    return bytes(out + _block(2, trainer) + _block(3, normalizer))


class _Merges(dict):
    """Ids of pre-tokens; the short ones met so far are kept, up to a bound."""

    def __init__(self, codec: Codec) -> None:
        self.ranks = {t: i for i, t in enumerate(codec.tokens)}
        self.encode = sentencepiece.SentencePieceProcessor(model_proto=codec.model).encode

    def __missing__(self, piece: str) -> list[int]:
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else self.encode(_mapped(data))
        if len(piece) <= _CACHED_CHARS:
            if len(self) >= _CACHED:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes by a vocabulary; made once, then shipped to the tasks (about 2 MB)."""

    def __init__(self, tokens: list[bytes], pattern: str = public_tokenizers.PATTERN) -> None:
        self.tokens, self.pattern, self.model = tokens, pattern, model_bytes(tokens)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _ready(self) -> None:
        if not hasattr(self, "_merges"):
            self._merges, self._regex = _Merges(self), regex.compile(self.pattern)

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens; those of a very long text come in parts, so that memory stays bounded."""
        if len(text) <= _CHARS_AT_ONCE:
            yield self._regex.findall(text)
            return
        found = (m.group() for m in self._regex.finditer(text))
        while part := list(islice(found, _PIECES_AT_ONCE)):
            yield part

    def pre_tokens(self, text: str) -> Iterator[str]:
        """Pre-tokens one after the other, found as they are asked for."""
        self._ready()
        return (m.group() for m in self._regex.finditer(text))

    def count(self, pre_token: str) -> int:
        """The number of tokens of one pre-token."""
        self._ready()
        return len(self._merges[pre_token])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; none for a null or empty one."""
        self._ready()
        ids_of = self._merges.__getitem__
        parts = [
            np.fromiter(chain.from_iterable(map(ids_of, part)), np.int32) for part in self._pieces(text or "")
        ]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[str | None]:
    """Texts one by one: a batch is not turned into Python strings as a whole."""
    values = batch.column(batch.schema.get_field_index(column))
    return (value.as_py() for value in values)


def _added(names: list[str], batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(names, batch.columns, strict=True)) | added)


def encode(docs: DataFrame, codec: Codec, text: str = "text") -> DataFrame:
    """Every row with ``ids`` (array of int) and ``n_tokens``; null and empty texts get no ids.

    Input columns of these names are replaced. One pass without shuffle; equal
    rows get equal ids.
    """
    kept = without(docs, ["ids", "n_tokens"])
    names = kept.columns

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                found = [codec.encode(t) for t in _texts(rows, text)]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(ends, np.concatenate(found))
                yield _added(names, rows, {"ids": ids, "n_tokens": pa.array(np.diff(ends).astype(np.int64))})

    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    schema = T.StructType([*kept.schema.fields, *added])
    return kept.mapInArrow(encoded, schema)


def decode(encoded: DataFrame, codec: Codec, ids: str = "ids") -> DataFrame:
    """Every row with ``decoded``, the bytes of its ids; null ids give null, no ids give no bytes."""
    kept = without(encoded, ["decoded"])
    names = kept.columns

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                lists = rows.column(rows.schema.get_field_index(ids))
                found = [codec.decode(v.values.to_numpy()) if v.is_valid else None for v in lists]
                yield _added(names, rows, {"decoded": pa.array(found, pa.binary())})

    added = T.StructField("decoded", T.BinaryType())
    return kept.mapInArrow(decoded, T.StructType([*kept.schema.fields, added]))


def digests(docs: DataFrame, codec: Codec, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` and sha256 of the decimal ids and of the bytes they decode to.

    Encodes and decodes one text after the other within one pass, so that ids
    are not carried through Spark rows for the sake of a checksum. Null and
    empty texts have 0 tokens and the digests of nothing; very long texts are
    split in parts; a null key is kept, rows that repeat are told each time,
    and other columns, whatever their names, are not looked at. An empty table
    gives no rows.
    """
    decimal = [str(i) for i in range(len(codec.tokens))]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for value in _texts(batch, text):
                ids = codec.encode(value)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    key: batch.column(batch.schema.get_field_index(key)),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array(of_ids, pa.string()),
                    "decoded_sha256": pa.array(of_bytes, pa.string()),
                }
            )

    schema = T.StructType([docs.schema[key]]).add("n_tokens", T.LongType())
    return docs.select(key, text).mapInArrow(digest, schema.add("ids_sha256", "string").add("decoded_sha256", "string"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of the ids of all documents, and of the texts decoded from them."""
    return digests(table(spark, sf_dir, "documents"), Codec(read_ranks()))
