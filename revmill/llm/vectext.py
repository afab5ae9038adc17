"""Whole batches of texts as arrays: characters, words and their hashes without a loop over words.

A batch is a list of texts. `Chars` lays their code points end to end; words, sentences and
tokenizer pieces are then pairs of positions, and a hash of any stretch is a difference of two
running sums. Nothing is kept between batches, so memory follows the batch alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U64 = np.uint64
# An odd factor has an inverse modulo 2**64, which moves a stretch's sum to position 0.
_FACTOR = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A reversible scrambling of 64-bit values (shift, multiply, shift)."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(31)
    x *= _U64(0xD6E8FEB86659FD93)
    x ^= x >> _U64(32)
    x *= _U64(0xD6E8FEB86659FD93)
    x ^= x >> _U64(32)
    return x


def combine(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit hash of several columns of 64-bit hashes; their order counts."""
    out = np.zeros(len(parts[0]), _U64)
    for p in parts:
        out = mix64(out * _U64(0x2545F4914F6CDD1D) + p + _U64(0x632BE59BD9B4E019))
    return out


class _Powers:
    """Powers of the factor and of its inverse, grown as batches need them."""

    def __init__(self) -> None:
        self.up = np.ones(1, _U64)
        self.down = np.ones(1, _U64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            inverse = pow(_FACTOR, -1, 1 << 64)
            for name, base in (("up", _FACTOR), ("down", inverse)):
                a = np.full(size, base, _U64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=_U64))


_POWERS = _Powers()


def stretches(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches values[begin:end] of 64-bit hashes."""
    n = len(values)
    _POWERS.need(n + 1)
    sums = np.zeros(n + 1, _U64)
    np.cumsum(mix64(values) * _POWERS.up[:n], out=sums[1:])
    return mix64((sums[end] - sums[begin]) * _POWERS.down[begin] + (end - begin).astype(_U64) * _U64(0xA0761D6478BD642F))


class Chars:
    """Code points of a batch. Text i is codes[starts[i]:starts[i + 1]]."""

    def __init__(self, texts: list[str], separator: int | None = None):
        """separator: a code point put after each text, so that words never cross texts."""
        joined = ("" if separator is None else chr(separator)).join(texts)
        if separator is not None:
            joined += chr(separator)
        self.text = joined
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        lengths += separator is not None
        self.starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths, out=self.starts[1:])
        self._sums: np.ndarray | None = None

    def lower_ascii(self) -> None:
        upper = (self.codes >= 65) & (self.codes <= 90)
        self.codes = self.codes + (upper.astype(np.uint32) << np.uint32(5))

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the stretches codes[begin:end]."""
        n = len(self.codes)
        _POWERS.need(n + 1)
        if self._sums is None:
            self._sums = np.zeros(n + 1, _U64)
            np.cumsum(mix64(self.codes.astype(_U64) + _U64(1)) * _POWERS.up[:n], out=self._sums[1:])
        stretch = (self._sums[end] - self._sums[begin]) * _POWERS.down[begin]
        return mix64(stretch + (end - begin).astype(_U64) * _U64(0xA0761D6478BD642F))

    def owners(self, begin: np.ndarray) -> np.ndarray:
        """The text each position belongs to."""
        return np.searchsorted(self.starts, begin, side="right") - 1


def ascii_space(codes: np.ndarray) -> np.ndarray:
    """True at the six ASCII white-space characters 0x09 to 0x0D and 0x20."""
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def small_batches(texts: list[str], chars: int = _BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about so many characters; one text at least."""
    first, total = 0, 0
    for i, t in enumerate(texts):
        if i > first and total + len(t) > chars:
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)
