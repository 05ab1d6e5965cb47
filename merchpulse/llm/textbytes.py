"""Words of many texts at once, found and hashed with NumPy over UTF-8 bytes."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

U = np.uint64
#: Bytes from which a word is hashed by itself.
LONG_WORD = 256
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, U), np.ones(1, U)]

#: Bytes of a word: digits, a-z and everything above ASCII (after lower-casing).
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: Bytes of a word: everything but space, tab, line feed, VT, FF and CR.
NONSPACE = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and shift)."""
    h = (h ^ (h >> U(31))) * U(0x7FB5D329728EA185)
    h = (h ^ (h >> U(27))) * U(0x81DADEF4BC2DD44D)
    return h ^ (h >> U(33))


def _series(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U)
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled : filled + step] = out[:step] * U(pow(base, filled, 2**64))
        filled += step
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        _powers[:] = _series(_BASE, size), _series(_INVERSE, size)
    return _powers[0], _powers[1]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span."""
    out = np.zeros(len(buf) + 1, U)
    np.cumsum(_BYTE[buf] * powers(len(buf) + 1)[0][: len(buf)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``buf[start:end]``, equal for equal bytes anywhere."""
    inverse = powers(len(sums))[1]
    length = (ends - starts).astype(U)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + length * U(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of some texts: byte spans in ``buf`` and, by text, the range of
    its words (``first[i]`` to ``first[i + 1]``)."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words: eight bytes at a time through ``mix``,
        which is not linear, so that no structure of a text (as of a polynomial
        modulo a power of two) makes two words' hashes equal."""
        size = self.ends - self.starts
        out = mix(size.astype(U) * U(0xD6E8FEB86659FD93) + U(1))
        long = np.flatnonzero(size > LONG_WORD)
        left = np.flatnonzero((size > 0) & (size <= LONG_WORD))
        wide = np.append(self.buf, np.zeros(8, np.uint8))
        eight = np.lib.stride_tricks.sliding_window_view(wide, 8)
        at = 0
        while len(left):
            some = eight[self.starts[left] + at].view("<u8").ravel()
            rest = np.minimum(size[left] - at, 8).astype(U)
            some = some & (U(0xFFFFFFFFFFFFFFFF) >> (U(64) - U(8) * rest))
            out[left] = mix((out[left] ^ mix(some + U(0x9E3779B97F4A7C15))) * U(0x9FB21C651E98DF25) + rest)
            at += 8
            left = left[size[left] > at]
        for i in long.tolist():
            word = self.buf[self.starts[i] : self.ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


def split_words(texts: list[bytes], is_word: np.ndarray, lower: bool = True) -> Words:
    joined = b"\n".join(texts)
    buf = np.frombuffer(joined.lower() if lower else joined, np.uint8)
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = is_word[buf]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(buf, starts, ends, np.searchsorted(starts, bounds))
