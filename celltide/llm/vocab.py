"""Byte-level vocabularies given as ranks, for operators that need ids of whole texts and the bytes of each id."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

#: The vocabulary of ``byte_bpe_50k.json`` as ranks: the same ids, found several times as fast.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Fixed value: the special token of that vocabulary.
SPECIAL = {"<|endoftext|>": 50256}


class ByteVocabulary:
    """Encodes texts; read on the driver, shipped to the tasks, built once in each."""

    def __init__(self, path: str = RANKS, special: dict[str, int] | None = None) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.special, self.pattern = special or {}, public_tokenizers.PATTERN

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _ready(self) -> tiktoken.Encoding:
        if not hasattr(self, "_encoding"):
            self._encoding = tiktoken.Encoding(
                "ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens=self.special
            )
        return self._encoding

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit numbers; special tokens where the vocabulary was given some."""
        return self._ready().encode_to_numpy(text, allowed_special="all", disallowed_special=())

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids, joined."""
        return self._ready().decode_bytes(ids.tolist())

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id."""
        return [token for token, _ in sorted(self.ranks.items(), key=lambda pair: pair[1])]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, so that long texts are not all in memory at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
