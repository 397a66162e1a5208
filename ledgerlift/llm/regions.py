"""Regions of text in which equal windows meet: winnowing by the least gram of each window.

Every window of ``length`` bytes has a least ``gram``-byte string by a hash, its anchor.
Equal windows have equal anchors at equal places, so windows with different anchors need
not be compared. Neighbouring windows mostly share an anchor; the stretch of text that a
run of them covers is a region.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_CHUNK = 1 << 18  # windows at a time, about 80 bytes of memory each; places are kept in 24 bits


class Winnower:
    def __init__(self, length: int, gram: int = 32):
        if not 0 < gram <= length:
            raise ValueError("a gram must fit into the window")
        self.length, self.gram = length, gram
        size = _CHUNK + length + 1
        base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        one = np.ones(1, np.uint64)
        self.powers = np.cumprod(np.concatenate([one, np.full(size, base, np.uint64)]), dtype=np.uint64)
        self.inverses = np.cumprod(np.concatenate([one, np.full(size, inverse, np.uint64)]), dtype=np.uint64)

    def _grams(self, data: np.ndarray) -> np.ndarray:
        """A mixed 64-bit hash of every gram."""
        n = len(data)
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], dtype=np.uint64)])
            h = (sums[self.gram:] - sums[:-self.gram]) * self.inverses[:n - self.gram + 1]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        return h

    def regions(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first window, windows, anchor hash) arrays over texts laid end to end; ``ends`` are the texts' ends.

        Windows that would cross a text's end are left out.
        """
        last = len(data) - self.length
        for at in range(0, last + 1, _CHUNK):
            stop = min(last + 1, at + _CHUNK)
            part = data[at:stop - 1 + self.length]
            grams = self._grams(part)
            places = np.arange(len(grams), dtype=np.uint64)
            low = (grams >> np.uint64(24) << np.uint64(24)) | places  # ties go to the left
            span = self.length - self.gram + 1
            step = 1
            while 2 * step <= span:
                low = np.minimum(low[:-step], low[step:])
                step *= 2
            if span > step:
                low = np.minimum(low[:-(span - step)], low[span - step:])
            anchor = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
            starts = np.arange(at, stop)
            text = np.searchsorted(ends, starts, side="right")
            inside = starts + self.length <= ends[text]
            new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
            new[1:] |= inside[1:] != inside[:-1]
            first = np.flatnonzero(new)
            count = np.diff(np.concatenate([first, [len(starts)]]))
            real = inside[first]
            first, count = first[real], count[real]
            yield first + at, count, grams[anchor[first]]
