"""Distinct pieces of a slice of text, found by hash, and a bounded memory of their values."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

_BYTE = np.random.Generator(np.random.PCG64(20_240_611)).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
#: Longer pieces are told apart by their bytes.
LONGEST = 64
_TOP = np.uint64(2**63)


class _Powers:
    """Powers of the step and of its inverse, as many as the longest slice so far needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = -(-n // 2**18) * 2**18
            for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 2**64))):
                factors = np.full(n, np.uint64(base))
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))


_powers = _Powers()


def piece_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range: a polynomial in a fixed step over random byte values."""
    _powers.grow(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * _powers.up[:len(data)], out=total[1:])
    found = (total[end] - total[first]) * _powers.down[first]
    found = (found ^ (end - first).astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return found ^ (found >> np.uint64(29))


class PieceValues:
    """Integer value of each piece, computed once per distinct piece and kept while there is room."""

    def __init__(self, compute: Callable[[list[bytes]], list[int]], most: int = 250_000,
                 on_clear: Callable[[], None] | None = None):
        self._compute, self._most, self._known = compute, most, {}
        self._on_clear = on_clear or (lambda: None)

    def of(self, data: np.ndarray, first: np.ndarray, end: np.ndarray,
           ) -> tuple[np.ndarray, np.ndarray]:
        """Values of the distinct pieces, and for each piece the index of its value."""
        hashes = piece_hashes(data, first, end) & (_TOP - np.uint64(1))
        seen: dict[bytes, int] = {}
        for i in np.flatnonzero(end - first > LONGEST):
            piece = data[first[i]:end[i]].tobytes()
            hashes[i] = _TOP | np.uint64(seen.setdefault(piece, len(seen)))
        which, unique = pd.factorize(hashes)
        at = np.empty(len(unique), np.int64)
        at[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        if len(self._known) + len(unique) > self._most:
            self._known.clear()
            self._on_clear()
        keys, known = unique.tolist(), self._known
        values = [known.get(k, -1) for k in keys]
        missing = [i for i, v in enumerate(values) if v < 0]
        if missing:
            bounds = zip(first[at[missing]].tolist(), end[at[missing]].tolist())
            whole = data.tobytes()
            for i, value in zip(missing, self._compute([whole[a:b] for a, b in bounds])):
                values[i] = value
                if keys[i] < 2**63:
                    known[keys[i]] = value
        return np.array(values, np.int64), which
