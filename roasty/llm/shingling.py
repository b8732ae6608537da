"""Word shingles of texts as sorted sets of 64-bit hashes, and compact columns
of such hashes for shuffles."""

from __future__ import annotations

import re
import struct

import numpy as np
import xxhash

#: Bytes of a text that are hashed together, up to the next white space.
BLOCK = 1 << 20

_M = np.uint64
#: Odd multipliers: one for each place of a run, and two that mix.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                    0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_FIRST = np.ones(1, bool)
_MIX = (_M(0xBF58476D1CE4E5B9), _M(0x94D049BB133111EB))


#: A-Z as a-z; and where white space is, the six characters of ASCII.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64) + _M(1)
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The base of the word hashes, and its inverse, to the powers 0 .. n - 1."""
    if len(_POWERS[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for k, x in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(size, x, np.uint64)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS


def _word_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    space = np.empty(len(raw) + 2, bool)
    space[0] = space[-1] = True
    np.take(_IS_SPACE, raw, out=space[1:-1])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LOWER[raw] * up[: len(raw)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts])


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word, in order: a polynomial in its bytes, taken from
    the sums over the whole text. A-Z count as a-z."""
    if len(text) <= BLOCK:
        return _word_hashes(text)
    parts, at = [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + BLOCK)
        stop = cut.start() if cut else len(text)
        parts.append(_word_hashes(text[at:stop]))
        at = stop
    return np.concatenate(parts)


def mixed(h: np.ndarray) -> np.ndarray:
    """The hashes spread over all 64 bits."""
    h = (h ^ (h >> _M(30))) * _MIX[0]
    h = (h ^ (h >> _M(27))) * _MIX[1]
    return h ^ (h >> _M(31))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The distinct hashes of the runs of ``size`` words, ascending; a shorter
    text that has words is one run. A-Z count as a-z; words stand between the
    six white-space characters of ASCII."""
    w = word_hashes(text)
    if not len(w):
        return w
    if len(w) < size:
        run = w * _PLACES[np.arange(len(w)) % len(_PLACES)]
        return mixed(np.array([np.bitwise_xor.reduce(mixed(run)) + _M(len(w))]))
    n = len(w) - size + 1
    total = w[:n] * _PLACES[0]
    for i in range(1, size):
        total += w[i : n + i] * _PLACES[i]
    out = mixed(total)
    out.sort()
    return out[np.concatenate([_FIRST, out[1:] != out[:-1]])]


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes()))


def pack(values: np.ndarray, width: int) -> bytes:
    """Unsigned integers below ``256 ** width``, byte plane by byte plane, so
    that the planes of high bytes, mostly zeros, compress away."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray, width: int) -> bytes:
    """Ascending integers, by their gaps."""
    return pack(np.diff(values, prepend=_M(0)), width)


def unpack_sorted(data: bytes, width: int) -> np.ndarray:
    return np.cumsum(unpack(data, width), dtype=np.uint64)
