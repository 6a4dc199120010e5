"""Word and n-gram hashes of many texts at once, for Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    for factor in _MIX:
        x = (x ^ (x >> np.uint64(33))) * factor
    return x ^ (x >> np.uint64(33))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash for ordered pairs of hashes."""
    return scramble(left * _ODD + right)


def chained(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for every window of ``length`` consecutive values."""
    ends = len(hashes) - length + 1
    total = scramble(hashes[:ends] + np.uint64(length))
    for k in range(1, length):
        total = joined(total, hashes[k : ends + k])
    return total


# Every kind of ASCII white space as a space, A-Z in lower case.
_PLAIN = bytes(
    32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
# A value for every byte and an odd base, any spread over 64 bits.
_BYTE = scramble(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BASE = 0x2545F4914F6CDD1D
_SEGMENT = 1 << 18


class WordHashes:
    """Hashes of the words of texts, with the powers that takes.

    A word's hash is a polynomial of its bytes, which differences of running sums give for
    all words of a stretch of text at once.
    """

    def __init__(self) -> None:
        self._room(2 * _SEGMENT)

    def _room(self, n: int) -> None:
        self._up = np.cumprod(np.full(n, _BASE, np.uint64))
        self._down = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))

    def _of_stretch(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of a stretch start, and their hashes."""
        if len(data) > len(self._up):
            self._room(len(data))
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = data != 32
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self._up[: len(data)], out=sums[1:])
        values = (sums[ends] - sums[starts]) * self._down[starts]
        return starts, scramble(values + (ends - starts).astype(np.uint64))

    def of_texts(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[int]]:
        """Hashes of the words of all texts, A-Z in lower case, and the words of each."""
        text = b" ".join(raw or b"" for raw in texts).translate(_PLAIN)
        data = np.frombuffer(text, np.uint8)
        starts, values = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        at = 0
        while at < len(text):
            cut = text.find(b" ", at + _SEGMENT)
            cut = len(text) if cut < 0 else cut
            own, hashed = self._of_stretch(data[at:cut])
            starts.append(own + at)
            values.append(hashed)
            at = cut
        ends = np.cumsum([len(raw or b"") + 1 for raw in texts])
        before = np.searchsorted(np.concatenate(starts), ends)
        return np.concatenate(values), np.diff(before, prepend=0).tolist()


def chunks(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, list[bytes | None]]]:
    """Texts in runs of about ``most`` bytes, one at least, each with its first position.

    Words take many times the memory of their text, so a batch is not split at once.
    """
    start = size = 0
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for k, length in enumerate(lengths):
        if size and size + length > most:
            yield start, texts.slice(start, k - start).to_pylist()
            start, size = k, 0
        size += length
    if start < len(lengths):
        yield start, texts.slice(start).to_pylist()
