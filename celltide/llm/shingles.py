"""Word shingles of texts as sets of 64-bit hashes, and min-hash signatures, for whole batches at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
_SEGMENT = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(20240501)
_SEED = _random.integers(1, 1 << 63, dtype=np.uint64)
_OF_PLACE = _random.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes words lane by lane: eight bytes and their place are mixed, and the sum is mixed with the length.

    A polynomial modulo a power of two would give some different words of
    regular build the same hash, whatever its base.
    """

    def _words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first bytes of the words of ``data``, lower-cased."""
        gaps = np.flatnonzero(np.diff(_IS_SPACE[data], prepend=True, append=True))
        starts, ends = gaps[::2], gaps[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64), starts
        length = ends - starts
        lanes = (length + 7) // 8
        first = np.cumsum(lanes) - lanes
        lane = np.arange(lanes.sum()) - np.repeat(first, lanes)
        padded = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
        eights = np.ndarray(len(data) + 1, np.dtype("<u8"), padded, strides=(1,))
        behind = np.maximum(8 - (np.repeat(length, lanes) - 8 * lane), 0).astype(np.uint64)  # bytes after the word
        value = eights[np.repeat(starts, lanes) + 8 * lane] << (behind * np.uint64(8))
        hashes = mixed(mixed(value + _SEED) + lane.astype(np.uint64) * _STEP)
        return mixed(np.add.reduceat(hashes, first) + length.astype(np.uint64) * _STEP), starts

    def _long(self, data: np.ndarray) -> np.ndarray:
        """Word hashes of a long text, in segments that end at white space."""
        spaces, parts, start = np.flatnonzero(_IS_SPACE[data]), [], 0
        while start < len(data):
            at = np.searchsorted(spaces, start + _SEGMENT)
            end = int(spaces[at]) + 1 if at < len(spaces) else len(data)
            parts.append(self._words(data[start:end])[0])
            start = end
        return np.concatenate(parts)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each text.

        A text of fewer than five words has one shingle, all its words; one
        without words has none.
        """
        found: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
        for first, last in _runs(texts):
            if last - first == 1 and len(texts[first]) > _SEGMENT:
                found[first] = _shingles(self._long(np.frombuffer(texts[first], np.uint8)))
                continue
            words, starts = self._words(np.frombuffer(b" ".join(texts[first:last]), np.uint8))
            ends = np.cumsum([len(t) + 1 for t in texts[first:last]])
            cuts = np.searchsorted(starts, ends[:-1])
            for i, own in enumerate(np.split(words, cuts)):
                found[first + i] = _shingles(own)
        return found


def _runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts that together stay below a segment; longer ones alone."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > _SEGMENT:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if len(texts) > first:
        yield first, len(texts)


def _shingles(words: np.ndarray) -> np.ndarray:
    n = len(words)
    if n == 0:
        return words
    if n < WORDS:
        return mixed(np.array([(words * _OF_PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)]))
    count = n - WORDS + 1
    total = words[:count] * _OF_PLACE[0]
    for k in range(1, WORDS):
        total += words[k : k + count] * _OF_PLACE[k]
    return np.unique(mixed(total))


class MinHasher:
    """Signatures of ``size`` 32-bit minima under random odd multipliers."""

    def __init__(self, size: int) -> None:
        random = np.random.default_rng(7)
        self._times = (random.integers(0, 1 << 31, size, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self._plus = random.integers(0, 1 << 32, size, dtype=np.uint32)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        best = np.full(len(self._times), 0xFFFFFFFF, np.uint32)
        for part in range(0, len(short), 256):  # the block of products stays in cache
            products = np.multiply.outer(short[part : part + 256], self._times)
            products += self._plus
            np.minimum(best, products.min(axis=0), out=best)
        return best
