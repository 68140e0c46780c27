"""Words, word hashes and rolling hashes shared by the operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from xxhash import xxh3_64_intdigest, xxh3_128_digest

#: Mixed odd multipliers of the rolling hashes.
_RADIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_SALT = (0, 0xA0761D6478BD642F)
_U64 = np.uint64


def fresh_name(docs: DataFrame, base: str) -> str:
    """``base``, or a longer name that no column of ``docs`` has in any case."""
    taken = {c.lower() for c in docs.columns}
    while base in taken:
        base += "_"
    return base


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs outside space and the characters 9 to 13, as UTF-8; null has none."""
    return text.encode().split() if text else []


def word_digests(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Both 64-bit halves of the XXH3-128 of each word of a text, in order: two independent lanes."""
    both = np.frombuffer(b"".join(map(xxh3_128_digest, words_of(text))), dtype=_U64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def word_hashes(text: str | None) -> np.ndarray:
    """XXH3-64 hashes of the words of a text, in order."""
    words = words_of(text)
    return np.fromiter(map(xxh3_64_intdigest, words), dtype=_U64, count=len(words))


class _Powers:
    """Powers of an odd radix and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, radix: int):
        self.radix, self.inverse = radix, pow(radix, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=_U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.radix), ("down", self.inverse)):
                powers = np.full(size, base, dtype=_U64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(r) for r in _RADIX]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (finaliser of a multiply-xorshift hash)."""
    h = (h ^ (h >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    return h ^ (h >> _U64(32))


class Rolling:
    """Hashes of any run of consecutive items, in constant time per run."""

    def __init__(self, h: np.ndarray, lane: int = 0):
        self.up, self.down = _POWERS[lane].get(len(h) + 1)
        items = mixed(h ^ _U64(_SALT[lane])) if lane else h
        self.sums = np.zeros(len(h) + 1, dtype=_U64)
        np.cumsum(items * self.up[: len(h)], out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of items [start, end) for each pair."""
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` items; their high bits are the even ones."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, dtype=_U64)
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every window of ``size`` values, by doubling."""
    done, out = 1, values
    while done < size:
        step = min(done, size - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out
