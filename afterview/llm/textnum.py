"""Vectorised text primitives shared by the operators of this subpackage.

Everything works on one flat byte buffer that holds many documents, with the
documents' boundaries beside it, so the cost of a Python call is paid per
batch and not per document or per word.

Hashes are polynomial: any span's hash is a difference of two prefix sums times
the inverse power of its start, so the hashes of all windows of one length take
a few array operations. Each has two halves, mixed into one 64-bit word: one
over 64-bit words with an odd base, and one modulo the prime 2^31 - 1, because
powers of two alone let regular texts (Thue-Morse words of 1024 letters) meet.
"""

from __future__ import annotations

import functools

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

#: The bytes between words of `[^\x20\x09-\x0D]+`.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


PRIME = np.uint64((1 << 31) - 1)
PRIME_BASE = 1_220_703_125
SECOND = np.uint64(0xA0761D6478BD642F)


class Sums:
    """Prefix sums of codes times powers, one element more than codes: `wide` modulo
    2^64, and `prime` of residues modulo PRIME, made when first asked for and not
    reduced, for fewer than 2^32 terms fit."""

    def __init__(self, source: np.ndarray, table: np.ndarray | None = None):
        """Of codes, or of what a table makes codes."""
        self.source, self.table, self.wide = source, table, np.zeros(len(source) + 1, np.uint64)
        np.cumsum(self._codes() * powers(len(source)), out=self.wide[1:])

    def _codes(self) -> np.ndarray:
        return self.source if self.table is None else self.table[self.source]

    @functools.cached_property
    def prime(self) -> np.ndarray:
        out = np.zeros(len(self), np.uint64)
        second = (self._codes() >> np.uint64(33)) * powers(len(self.source), "prime up")
        np.cumsum((second & PRIME) + (second >> np.uint64(31)), out=out[1:])
        return out

    def __len__(self) -> int:
        return len(self.wide)


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x below 2^62: bits above the 31st are worth one each."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return np.where(x >= PRIME, x - PRIME, x)


def powers(n: int, which: str = "up") -> np.ndarray:
    """BASE**0 .. BASE**(n-1) (or of its inverse), kept between calls; with
    `prime` before `which` the same of PRIME_BASE."""
    if len(_powers.setdefault(which, np.ones(1, np.uint64))) < n:
        size = max(n, 1 << 16)
        if which.startswith("prime"):
            base = PRIME_BASE if which == "prime up" else pow(PRIME_BASE, -1, int(PRIME))
            made = np.ones(1, np.uint64)
            while len(made) < size:
                made = np.concatenate([made, reduced(made * np.uint64(pow(base, len(made), int(PRIME))))])
            _powers[which] = made[:size].astype(np.uint32)
        else:
            grown = np.full(size, BASE if which == "up" else INVERSE, np.uint64)
            grown[0] = 1
            _powers[which] = np.multiply.accumulate(grown)
    return _powers[which][:n]


def prefix_sums(codes: np.ndarray) -> Sums:
    """Feeds span_hashes, rolling_hashes and rolling_marks."""
    return Sums(codes)


def byte_sums(raw: np.ndarray) -> Sums:
    """The same of bytes."""
    return Sums(raw, BYTE_CODE)


def _hashes(wide: np.ndarray, prime: np.ndarray, down: np.ndarray, prime_down: np.ndarray) -> np.ndarray:
    prime = (prime & PRIME) + (prime >> np.uint64(31))
    prime = reduced(((prime & PRIME) + (prime >> np.uint64(31))) * prime_down)
    return mix(wide * down + prime * SECOND)


def span_hashes(sums: Sums, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of codes[start:end] for each pair."""
    n = len(sums)
    return _hashes(sums.wide[ends] - sums.wide[starts], sums.prime[ends] - sums.prime[starts], powers(n, "down")[starts], powers(n, "prime down")[starts])


def rolling_hashes(sums: Sums, width: int) -> np.ndarray:
    """Hash of every window of `width` codes, by its start."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    return _hashes(sums.wide[width:] - sums.wide[:n], sums.prime[width:] - sums.prime[:n], powers(n, "down"), powers(n, "prime down"))


def rolling_marks(sums: Sums, width: int) -> np.ndarray:
    """A cheaper hash of every window, of the first half alone, for where it does no harm
    if two different windows share one."""
    n = len(sums) - width
    return mix((sums.wide[width:] - sums.wide[:n]) * powers(n, "down")) if n > 0 else np.zeros(0, np.uint64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i:i+width] for each i, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def word_spans(buf: np.ndarray, separator: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in buf (runs of bytes for which separator
    is false, never across a document's bound) and the number of the first
    word of each document, with the total behind."""
    n = len(buf)
    inside = np.zeros(n + 2, bool)
    np.logical_not(separator[buf], out=inside[1 : n + 1])
    edge = inside[1:] != inside[:-1]
    begins = edge[: n + 1] & inside[1:]
    stops = edge & inside[:-1]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    both = cut[inside[cut] & inside[cut + 1]]
    begins[both] = True
    stops[both] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return starts, ends, np.searchsorted(starts, bounds)
