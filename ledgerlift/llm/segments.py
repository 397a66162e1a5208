"""Token ids of texts through the distinct segments of a task's rows.

A segment is a stretch of text whose ids do not depend on what stands around it. A task
encodes each distinct segment once and gathers the ids of whole texts with numpy. The
store starts afresh beyond ``MOST_SEGMENTS``, so its memory does not follow the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

MOST_SEGMENTS = 400_000


class SegmentStore:
    def __init__(self, encode: Callable[[list], Iterable[list[int]] | tuple[np.ndarray, np.ndarray]], most: int = MOST_SEGMENTS):
        """``encode`` gives the ids of each new segment, or a pair: all their ids end to end, and how many each has."""
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.index: dict = {}
        self.flat, self.first, self.size = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64))

    def _learn(self, new: list) -> None:
        told = self.encode(new)
        if isinstance(told, tuple):
            flat, size = told
        else:
            ids = list(told)
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for part in ids for i in part), np.int32, int(size.sum()))
        first = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, flat])
        self.first = np.concatenate([self.first, first])
        self.size = np.concatenate([self.size, size])

    def ids_of(self, texts: Iterable[list]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, given as lists of segments, and the offset of each text in them (one more at the end).

        Texts may come from a generator: of each only the numbers of its segments are kept.
        """
        if len(self.index) > self.most:
            self._clear()
        index, new, parts, counts = self.index, [], [], [0]
        for segments in texts:
            at = list(map(index.get, segments))
            if None in at:
                for n, known in enumerate(at):
                    if known is None:
                        s = segments[n]
                        at[n] = found = index.setdefault(s, len(index))
                        if found == len(self.size) + len(new):
                            new.append(s)
            parts.append(np.array(at, np.int32))
            counts.append(len(at))
        if new:
            self._learn(new)
        at = np.concatenate(parts) if parts else np.empty(0, np.int32)
        return self._gathered(at, np.array(counts))

    def ids_of_numbered(self, distinct: list, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts given as numbers into a list of distinct segments and how many each text has."""
        if len(self.index) > self.most:
            self._clear()
        index = self.index
        new = [s for s in distinct if s not in index]
        index.update(zip(new, range(len(index), len(index) + len(new)), strict=True))
        if new:
            self._learn(new)
        number = np.fromiter(map(index.__getitem__, distinct), np.int32, len(distinct))
        return self._gathered(number[at], np.concatenate([[0], counts]))

    def _gathered(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[at]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.first[at] - (ends - size), size) + np.arange(ends[-1] if len(at) else 0)]
        return ids, np.concatenate([[0], ends])[np.cumsum(counts)]
