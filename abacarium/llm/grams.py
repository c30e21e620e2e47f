"""Word and n-gram hashes of one text as numpy arrays.

Texts are taken as UTF-8 bytes. Both word rules used here only name ASCII
characters, so that a table of 256 bytes decides what belongs to a word.
"""

from __future__ import annotations

import numpy as np

from abacarium.llm.common import by_value

BLOCK = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the SplitMix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE, _STEP = 0x5851F42D4C957F2D, 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(14, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _POWERS[size]


def byte_table(outside: bytes) -> np.ndarray:
    """True for every byte that is not in ``outside``."""
    table = np.ones(256, bool)
    table[list(outside)] = False
    return table


#: Words separated by white space.
SPACED = byte_table(b" \t\n\x0b\x0c\r")
#: Words of letters, digits and everything beyond ASCII (of lower-cased text).
ALNUM = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def words(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of ``text`` with A-Z lower-cased, and where its words start and end."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = table[data]
    edge = np.diff(inside)
    return data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, block by block, so that memory stays small for long texts."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(starts):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK, "right")))
            base = starts[lo]
            part = data[base:ends[hi - 1]]
            power, inverse = _power_tables(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
            a, b = starts[lo:hi] - base, ends[lo:hi] - base
            out[lo:hi] = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)
            lo = hi
        return mix(out)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` successive values; empty if there are fewer."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(count, n, np.uint64)
        for i in range(n):
            out = out * _U(_STEP) + hashes[i : i + count]
        return mix(out)


def shingle_set(text: str, n: int) -> np.ndarray:
    """The sorted distinct hashes of ``n``-word shingles; fewer words make one shingle, no words none."""
    hashes = word_hashes(*words(text, SPACED))
    return np.unique(ngrams(hashes, min(n, len(hashes)))) if len(hashes) else np.empty(0, np.uint64)


by_value(__name__)
