"""Hashes of all character windows of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), 0x5851F42D4C957F2D


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the joined texts, and the offset of each text (and the end)."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate(([0], np.cumsum(lengths)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def window_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every window of ``size`` code points, by doubling."""
    if len(points) < size:
        return np.empty(0, np.uint64)
    h = points.astype(np.uint64)
    h += np.uint64(1)
    h *= _MIX
    h ^= h >> np.uint64(29)
    one, done, covered = h, None, 0
    power, length = _BASE, 1
    bits = size
    while True:  # binary expansion of size: ``done`` covers the low bits so far
        if bits & 1:
            if done is None:
                done, covered = one, length
            else:
                n = len(points) - covered - length + 1
                done = one[:n] * np.uint64(pow(_BASE, covered, 1 << 64)) + done[length : length + n]
                covered += length
        bits >>= 1
        if not bits:
            break
        one = one[:-length] * np.uint64(power) + one[length:]
        power = power * power % (1 << 64)
        length *= 2
    return _mixed(done.copy() if done is one else done)


def sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over every ``width`` neighbours."""
    n, done = len(x), 1
    while done * 2 <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return best(x[: n - width + 1], x[rest : rest + n - width + 1]) if rest else x


def winnowed(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash of some ``width`` neighbouring windows; every such neighbourhood has one."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    least = sliding(hashes, width, np.minimum)
    around = np.zeros(len(hashes) + width - 1, np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    return np.nonzero(sliding(around, width, np.maximum) == hashes)[0]
