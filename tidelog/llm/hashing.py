"""Hashes of words, shingles and windows over byte buffers, computed in numpy.

The hashes order, route and pre-select. Where equality decides a result, callers compare
the bytes or carry 64 bits of a value whose inputs are mixed word by word.
"""

from __future__ import annotations

import numpy as np

_BLOCK = 1 << 20
_MULT = 0x9E3779B97F4A7C1B  # odd, and 3 modulo 8: swapped bytes never cancel
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: Odd factors of the places in a shingle or window.
PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_POW = _powers(_MULT, _BLOCK + 1)
_INV = _powers(pow(_MULT, -1, 1 << 64), _BLOCK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def span_hashes(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every span ``buffer[start:end]``; spans are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    data = np.frombuffer(buffer, np.uint8)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = int(np.searchsorted(ends, base + _BLOCK, "right"))
        if last <= first:  # one span longer than a block: fold it piece by piece
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for a in range(base, int(ends[first]), _BLOCK):
                    part = _BYTE[data[a:min(a + _BLOCK, int(ends[first]))]]
                    h = mix(np.array([h + (part * _POW[:len(part)]).sum(dtype=np.uint64)]))[0]
            out[first] = h
            first += 1
            continue
        lo, hi = starts[first:last] - base, ends[first:last] - base
        size = int(hi[-1])
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[data[base:base + size]] * _POW[:size], out=sums[1:])
        out[first:last] = (sums[hi] - sums[lo]) * _INV[lo] + (hi - lo).astype(np.uint64)
        first = last
    return mix(out)


def word_spans(buffer: bytes, single: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer whose words are parted by one space."""
    if not buffer:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1)).astype(np.int64)
    ends = np.concatenate((gaps, [len(buffer)])).astype(np.int64)
    return starts, ends


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring word hashes (shorter input: none)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n] * PLACE[0]
    for k in range(1, size):
        out += words[k:k + n] * PLACE[k]
    return mix(out)
