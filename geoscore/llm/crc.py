"""CRC-32 of many byte spans at once, computed with numpy inside tasks.

Short spans advance byte by byte together; the checksum of a concatenation
comes from the parts' checksums by shift tables, which are built from the
polynomial. Longer spans use ``zlib`` one by one.
"""

from __future__ import annotations

import zlib

import numpy as np

POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected
SHORT = 64

_U = np.uint32
_STEP = np.arange(256, dtype=_U)
for _ in range(8):
    _STEP = np.where(_STEP & _U(1), (_STEP >> _U(1)) ^ _U(POLYNOMIAL), _STEP >> _U(1)).astype(_U)
_SHIFTS: list[np.ndarray] = []


def _zero_byte(x: np.ndarray) -> np.ndarray:
    return _STEP[x & _U(255)] ^ (x >> _U(8))


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = table[0][x & _U(255)]
    for k in (1, 2, 3):
        out ^= table[k][(x >> _U(8 * k)) & _U(255)]
    return out


def _shifts() -> list[np.ndarray]:
    """Tables of the shift by 0 to SHORT zero bytes, then by 2 ** 0 to 2 ** 40."""
    if not _SHIFTS:
        one = np.stack([np.arange(256, dtype=_U) << _U(8 * k) for k in range(4)])
        near = [one]
        for _ in range(SHORT):
            near.append(_zero_byte(near[-1]))
        far = [near[1]]
        for _ in range(40):
            far.append(_apply(far[-1], far[-1]))
        _SHIFTS.extend([np.stack(near), np.stack(far)])
    return _SHIFTS


def span_crc(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span ``data[starts:ends]``."""
    length = ends - starts
    out = np.zeros(len(starts), _U)
    order = np.argsort(-np.minimum(length, SHORT + 1), kind="stable")
    sizes = length[order]
    long = int(np.searchsorted(-sizes, -SHORT, "left"))
    for i in order[:long]:
        out[i] = zlib.crc32(data[starts[i]: ends[i]])
    order, sizes = order[long:], sizes[long:]
    state, at = np.full(len(order), 0xFFFFFFFF, _U), starts[order]
    for j in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -j, "left"))
        s = state[:n]
        state[:n] = _STEP[(s ^ data[at[:n] + j]) & _U(255)] ^ (s >> _U(8))
    out[order] = ~state
    return out


def joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of each concatenation, from the parts' checksums and the second
    part's length."""
    near, far = _shifts()
    first = np.asarray(first, _U)
    length = np.asarray(length)
    short = np.minimum(length, SHORT)
    moved = near[short, 0, first & _U(255)]
    for k in (1, 2, 3):
        moved ^= near[short, k, (first >> _U(8 * k)) & _U(255)]
    for i in np.flatnonzero(length > SHORT):
        x, n, k = first[i: i + 1], int(length[i]), 0
        while n:
            if n & 1:
                x = _apply(far[k], x)
            n, k = n >> 1, k + 1
        moved[i] = x[0]
    return moved ^ second
