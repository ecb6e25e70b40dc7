"""Words of many texts at once as NumPy arrays: bounds, document, 64-bit hash."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: White space between words: space and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = _rng.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    starts: np.ndarray  #: first byte of each word in the joined buffer
    ends: np.ndarray
    hash: np.ndarray  #: uint64 of the word with A-Z lower-cased
    first: np.ndarray  #: per text, index of its first word; one more entry at the end
    base: np.ndarray  #: per text, its first byte in the joined buffer


def hash_spans(buf: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; ``inside`` marks exactly the bytes of all spans, in order."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = (ends - starts).astype(np.int32)
    at = np.flatnonzero(inside).astype(np.int32)
    off = at - np.repeat(starts.astype(np.int32), lens)
    powers = np.full(int(lens.max()), _STEP)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    value = _BYTE[buf[at]]
    value *= powers[off]
    return mixed(np.add.reduceat(value, np.cumsum(lens) - lens) + lens.astype(np.uint64))


def split_words(texts: list[bytes]) -> Words:
    joined = b"\n".join(texts) + b"\n"
    buf = LOWER[np.frombuffer(joined, np.uint8)]
    inside = ~SPACE[buf]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edge[0::2], edge[1::2]
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    base = np.concatenate([[0], np.cumsum(sizes)])
    return Words(starts, ends, hash_spans(buf, inside, starts, ends), np.searchsorted(starts, base), base[:-1])


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (over text bounds too: mask those by position)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n] * _ODD[0]
    for i in range(1, k):
        out += h[i : i + n] * _ODD[i % len(_ODD)] + np.uint64(i)
    return mixed(out)
