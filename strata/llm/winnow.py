"""Where texts can repeat: the anchors of all long windows.

For every window of ``length`` bytes, its anchor is the k-gram of smallest
hash inside it (the leftmost of equals). That depends on the window's bytes
only, so equal windows have equal anchors at the same offset. Consecutive
windows with the same anchor form one piece: about one piece for every
``(length - gram) / 2`` bytes of text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

from .text import mix64

_BASES = (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15)
#: Bytes worked on at once: small enough for the processor's caches.
CHUNK = 1 << 16
#: Bytes of one segment of a longer text; places in it fit in ``PLACE`` bits.
SEGMENT = 1 << 22
PLACE = 24


@functools.cache
def _powers(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


@functools.cache
def _values(which: int) -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) + np.uint64(1000 * which))


class RangeHashes:
    """Hashes of any ranges of a byte array, in constant time each."""

    def __init__(self, data: np.ndarray, which: int):
        room = 1 << max(12, int(len(data)).bit_length())
        up = _powers(room, _BASES[which])
        self.down = _powers(room, pow(_BASES[which], -1, 1 << 64))
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        value = _values(which)[data]
        value *= up[:len(data)]
        np.cumsum(value, out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.total[end] - self.total[start]) * self.down[start])

    def order(self, k: int) -> np.ndarray:
        """For each k-gram a value to compare by (its high bits are a hash)."""
        value = self.total[k:] - self.total[:-k]
        value *= self.down[:len(value)]
        return value


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of ``w`` values."""
    n = len(x) - w + 1
    blocks = -(-len(x) // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(x)] = x
    rows = padded.reshape(blocks, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def batches(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text, offset in it, bytes) whose windows are, together, all
    windows of the texts, each once."""
    held: list[tuple[int, int, bytes]] = []
    room = CHUNK
    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        for at in range(0, len(t) - length + 1, SEGMENT):
            part = t if len(t) <= SEGMENT else t[at:at + SEGMENT + length - 1]
            if held and len(part) > room:
                yield held
                held, room = [], CHUNK
            held.append((i, at, part))
            room -= len(part)
    if held:
        yield held


class Pieces:
    """The pieces of one batch: part, first window, windows, anchor's place."""

    def __init__(self, parts: list[tuple[int, int, bytes]], length: int, gram: int):
        self.length, self.gram = length, gram
        self.data = np.frombuffer(b"".join(p[2] for p in parts), dtype=np.uint8)
        sizes = np.array([len(p[2]) for p in parts], dtype=np.int64)
        ends = np.cumsum(sizes)
        self.hashes = RangeHashes(self.data, 0)
        value = self.hashes.order(gram)
        value &= np.uint64((1 << 64) - (1 << PLACE))
        value |= np.arange(len(value), dtype=np.uint64)
        at = (_window_min(value, length - gram + 1) & np.uint64((1 << PLACE) - 1)).astype(np.int32)
        new = np.concatenate([[True], at[1:] != at[:-1]])
        begins = (ends - sizes)
        new[begins] = True
        start = np.flatnonzero(new)
        part = np.searchsorted(ends, start, side="right")
        limit = ends[part] - length + 1  # one past the last window inside the part
        stop = np.minimum(np.concatenate([start[1:], [len(at)]]), limit)
        inside = stop > start
        self.first, self.windows = start[inside], (stop - start)[inside]
        self.part = part[inside]
        self.place = at[self.first].astype(np.int64)
        self.text = np.array([p[0] for p in parts])[self.part]
        self.offset = self.first - begins[self.part] + np.array([p[1] for p in parts], dtype=np.int64)[self.part]

    def anchors(self) -> np.ndarray:
        return self.hashes.of(self.place, self.place + self.gram).view(np.int64)

    def contents(self, which: np.ndarray) -> np.ndarray:
        other = RangeHashes(self.data, 1)
        return other.of(self.first[which], (self.first + self.windows)[which] + self.length - 1).view(np.int64)
