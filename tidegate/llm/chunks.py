"""Token ids of white-space-delimited chunks, remembered within a worker process up to a fixed number of chunks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain, repeat

import numpy as np

LIMIT = 150_000
"""Chunks remembered; beyond it the memory starts anew. It saves time only, results do not depend on it."""


class ChunkIds:
    """Maps chunks to ids through ``encode``, which gets distinct unknown chunks and returns their id lists.

    ``encode`` returns None for a chunk that cannot be encoded apart from its neighbours.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[Sequence[int] | None]], limit: int = LIMIT):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int64)
        self.used = 0

    def places(self, chunks: list[bytes]) -> np.ndarray:
        """The place of each chunk's ids; valid until the next call."""
        if len(self.known) > self.limit:
            self._clear()
        out = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            lacking = [chunks[i] for i in missing.tolist()]
            new = list(dict.fromkeys(lacking))
            self._add(new, self.encode(new))
            out[missing] = np.fromiter(map(self.known.__getitem__, lacking), np.int64, len(lacking))
        return out

    def _add(self, chunks: list[bytes], ids: list[Sequence[int] | None]) -> None:
        at = len(self.known)
        sizes = np.array([-1 if x is None else len(x) for x in ids], np.int64)
        flat = np.fromiter(chain.from_iterable(x for x in ids if x is not None), np.uint32)
        self.flat = _room(self.flat, self.used, flat)
        self.starts = _room(self.starts, at, self.used + np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0))
        self.sizes = _room(self.sizes, at, sizes)
        self.used += len(flat)
        self.known.update(zip(chunks, range(at, at + len(chunks)), strict=True))

    def ids(self, places: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.starts[places], self.sizes[places])


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[s : s + n]`` for each start and size."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return flat[:0].copy()
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]


def _room(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    if used + len(more) > len(array):
        array = np.concatenate([array[:used], np.zeros(max(len(array), 2 * len(more)), array.dtype)])
    array[used : used + len(more)] = more
    return array
