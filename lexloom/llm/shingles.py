"""Word shingles of whole texts as sorted 64-bit ids."""

from __future__ import annotations

import numpy as np

#: Space and \x09-\x0D part words; A-Z are lower-cased, nothing else.
_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_P = 0x9E3779B97F4A7C15
_PI = pow(_P, -1, 1 << 64)
#: Bytes or code points hashed at once (more only within one word).
SEGMENT = 1 << 20
_powers = {"n": 0}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > _powers["n"]:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        for name, base in (("up", _P), ("down", _PI)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            _powers[name] = np.multiply.accumulate(t)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_spans(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span x[start:end] of whole numbers below 2**32; spans ascend and don't overlap. Spans are hashed in
    segments of about SEGMENT values and never cut, so results don't depend on it."""
    out, i = [np.zeros(0, np.uint64)], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        base, last = int(starts[i]), int(ends[j - 1])
        up, down = _tables(last - base + 1)
        sums = np.zeros(last - base + 1, np.uint64)
        np.cumsum((x[base:last].astype(np.uint64) + np.uint64(1)) * up[: last - base], out=sums[1:])
        a = starts[i:j] - base
        out.append(mix((sums[ends[i:j] - base] - sums[a]) * down[a]))
        i = j
    return out[1] if len(out) == 2 else np.concatenate(out)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values."""
    gap = np.ones(len(inside) + 2, bool)
    np.logical_not(inside, out=gap[1:-1])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[0::2], edge[1::2]


def word_hashes(text: str) -> np.ndarray:
    b = np.frombuffer(text.encode().lower(), np.uint8)  # of bytes: A-Z only
    return hash_spans(b, *runs(~_space[b]))


def shingle_ids(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct ids of the k-word shingles; of fewer words the whole sequence is the only one; without words none."""
    w = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(w):
        return w
    m = min(k, len(w))
    h = np.zeros(len(w) - m + 1, np.uint64)
    for j in range(m):
        h += w[j : len(w) - m + 1 + j] * np.uint64(pow(_PI, 3 * j + 2, 1 << 64))
    return np.unique(mix(h + np.uint64(m)))
