"""64-bit hashes of the words of a text, computed on its bytes with numpy."""

from __future__ import annotations

import numpy as np

#: Bytes looked at together; longer texts are cut at white space.
SEGMENT = 1 << 20

_rng = np.random.default_rng(7)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """Hashes of lower-cased words (A-Z only); powers of the base are kept between calls."""

    def __init__(self):
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.full(n, _BASE, np.uint64))
            self.inverse = np.cumprod(np.full(n, _INVERSE, np.uint64))

    def __call__(self, data: bytes | None) -> np.ndarray:
        if not data:
            return np.empty(0, np.uint64)
        codes = np.frombuffer(data, np.uint8)
        if len(codes) <= SEGMENT:
            return self._segment(codes)
        parts, at = [], 0
        while at < len(codes):
            end = at + SEGMENT
            while end < len(codes):
                gaps = np.flatnonzero(_SPACE[codes[end : end + SEGMENT]])
                if len(gaps):
                    end += int(gaps[0])
                    break
                end += SEGMENT
            parts.append(self._segment(codes[at:end]))
            at = end
        return np.concatenate(parts)

    def _segment(self, codes: np.ndarray) -> np.ndarray:
        if len(codes) > len(self.power):
            self._grow(2 * len(codes))
        space = np.ones(len(codes) + 2, np.int8)
        space[1:-1] = _SPACE[codes]
        edges = np.flatnonzero(np.diff(space))
        starts, ends = edges[::2], edges[1::2]
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_BYTE[codes] * self.power[: len(codes)], out=total[1:])
        h = (total[ends] - total[starts]) * self.inverse[starts]
        return mixed(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
