"""Repeated windows of a collection of strings by merging Burrows-Wheeler transforms.

The strings are split into shards. A shard's transform lists its suffixes in order, each
with the bytes before it. The merge does not sort suffixes of different shards: it starts
from any interleaving of the shards and refines it. If the interleaving is right for the
first k bytes, putting its rows in the order of the bytes before them, without changing
the order of equal ones, makes it right for k bytes more. Several words of eight bytes
are taken at a time, numbered by doubling. Where neighbours differ, in the bytes just added
or before, a block of equal prefixes ends; blocks of one row can hold no repetition and
leave the refinement.
"""

from __future__ import annotations

import numpy as np

_WORD = 8


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(_WORD, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for n in range(_WORD):
        out <<= np.uint64(8)
        out |= padded[n:n + len(data)]
    return out


def _kind(n: int) -> type:
    """The type of places among ``n``: most of the memory here is places, and few need 64 bits."""
    return np.int32 if n < 1 << 31 else np.int64


def _order(values: np.ndarray) -> np.ndarray:
    """The stable order of numbers; with their places in the low bits, where both fit into 63 bits, a plain sort gives it."""
    bits = len(values).bit_length()
    if not len(values) or int(values.max()).bit_length() + bits > 63:
        return np.argsort(values, kind="stable").astype(_kind(len(values)))
    packed = values.astype(np.int64)
    packed <<= bits
    packed |= np.arange(len(values), dtype=_kind(len(values)))
    packed.sort()
    packed &= (1 << bits) - 1
    return packed.astype(_kind(len(values)))


def _dense(values: np.ndarray) -> np.ndarray:
    """The number of each value among the different ones, ascending."""
    order = _order(values)
    ordered = values[order]
    out = np.empty(len(values), _kind(len(values)))
    out[order] = np.cumsum(np.concatenate([np.zeros(min(1, len(values)), bool), ordered[1:] != ordered[:-1]]), dtype=out.dtype)
    return out


def stride_of(length: int) -> int:
    """Bytes of a refinement step: whole words that divide the window into four steps or more, if any do."""
    return _WORD * max(n for n in range(1, max(1, length // _WORD // 4) + 1) if length // _WORD % n == 0)


def numbered_before(words: np.ndarray, before: np.ndarray, stride: int) -> np.ndarray:
    """For places with ``stride`` bytes before them in their string, those bytes' number in their order; else 0."""
    have, out = _WORD, np.zeros(len(words), _kind(len(words)))
    full = np.flatnonzero(before >= have)
    out[full] = _dense(words[full - have])
    last = out
    while have < stride:
        step = min(have, stride - have)
        full = np.flatnonzero(before >= have + step)
        # the bytes before are those further away, then the nearer ones
        far, near = (out, last if step == have else numbered_before(words, before, step))
        grown = np.zeros(len(words), out.dtype)
        grown[full] = _dense(far[full - step].astype(np.int64) * (len(words) + 1) + near[full])
        out = last = grown
        have += step
    return out


def suffix_order(words: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """A shard's places in the order of their suffixes' first ``depth`` bytes, by doubling.

    ``left`` is the number of bytes up to the end of the place's string; beyond it a
    suffix counts as smaller than any other. Equal suffixes follow in order of place.
    """
    short = np.clip(_WORD - left, 0, _WORD - 1).astype(np.uint64) * np.uint64(8)
    rank = _dense(np.where(left > 0, words >> short << short, 0))
    have = _WORD
    while have < depth:
        step = min(have, depth - have)
        both = rank.astype(np.int64) * (len(words) + 2)
        both[:-step] += np.where(left[:-step] > step, rank[step:] + 1, 0)
        rank = _dense(both)
        have += step
    return _order(rank)


def repeated_windows(strings: list[bytes], weights: np.ndarray, length: int, shards: int = 4) -> list[np.ndarray]:
    """For each string, whether the window of ``length`` bytes at each place occurs twice or more.

    ``weights`` is how often each string stands in the corpus.
    """
    if length % _WORD:
        raise ValueError(f"the window must be a multiple of {_WORD} bytes")
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1  # the empty suffix has a row too
    shards = max(1, min(shards, len(strings), 1 << 15))
    members = [np.arange(s, len(strings), shards) for s in range(shards)]  # dealt in turn, so a bucket meets in the merge
    order = np.concatenate(members)
    data = np.frombuffer(b"".join(strings[i] + b"\0" for i in order), np.uint8)
    ends = np.cumsum(sizes[order])
    kind = _kind(len(data))
    owner = np.repeat(order.astype(kind), sizes[order])
    left = np.repeat((ends - 1).astype(kind), sizes[order]) - np.arange(len(data), dtype=kind)
    before = sizes.astype(kind)[owner] - 1 - left  # bytes of the string before the place
    words = _words(data)
    # transform of each shard: its places in suffix order
    places, shard_of, first = [], [], 0
    for number, own in enumerate(members):
        size = int(sizes[own].sum())
        places.append((first + suffix_order(words[first:first + size], left[first:first + size], length)).astype(kind))
        shard_of.append(np.full(size, number, np.uint16))
        first += size
    places, shard_of = np.concatenate(places), np.concatenate(shard_of)
    row_of = np.empty(len(data), kind)
    row_of[places] = np.arange(len(data), dtype=kind)
    stride = stride_of(length)
    full = before >= stride
    symbol = numbered_before(words, before, stride)
    del words, before, left
    alive = np.arange(len(data), dtype=kind)  # rows of the transforms, shard by shard
    interleaving = shard_of.copy()
    block = np.zeros(len(data), kind)
    for depth in range(0, length, stride):
        merged = np.empty(len(alive), kind)
        merged[np.argsort(interleaving, kind="stable")] = alive
        place = places[merged]
        ready = full[place]
        place, block = place[ready], block[ready]
        if not len(place):
            alive = alive[:0]
            break
        turn = _order(symbol[place])
        place, block, added = place[turn], block[turn], symbol[place[turn]]
        new = np.concatenate([[True], (block[1:] != block[:-1]) | (added[1:] != added[:-1])])
        start = np.flatnonzero(new)
        count = np.diff(np.concatenate([start, [len(place)]]))
        block = np.repeat(np.arange(len(start), dtype=kind), count)
        stays = np.repeat(count > 1, count) if depth + stride < length else np.ones(len(place), bool)
        rows = row_of[place - stride]
        rows, block = rows[stays], block[stays]
        interleaving = shard_of[rows]
        flags = np.zeros(len(data), bool)
        flags[rows] = True
        alive = np.flatnonzero(flags).astype(kind)
    found = np.zeros(len(data), bool)
    if len(alive):  # rows whose whole window was compared
        merged = np.empty(len(alive), kind)
        merged[np.argsort(interleaving, kind="stable")] = alive
        place = places[merged]
        total = np.bincount(block, weights[owner[place]])
        found[place] = total[block] >= 2
    out: list = [None] * len(strings)
    for at, i in zip((ends - sizes[order]).tolist(), order.tolist(), strict=True):
        windows = max(0, len(strings[i]) - length + 1)
        out[i] = np.ones(windows, bool) if weights[i] >= 2 else found[at:at + windows]
    return out
