"""Words and their ids in flat arrays, without a Python object for each."""

from __future__ import annotations

import numpy as np

from .bytesops import _POWERS, mix


#: Bytes of words that are hashed together; they take some thirty times as much for that while.
_HASHED_BYTES = 256 << 10


def flat_hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``data[bounds[i]:bounds[i + 1]]``."""
    result = np.zeros(len(bounds) - 1, np.uint64)
    row = 0
    while row < len(result):
        end = int(np.searchsorted(bounds, bounds[row] + _HASHED_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(result))
        result[row:end] = _hashes_of(data, bounds[row : end + 1])
        row = end
    return result


def _hashes_of(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    lengths = np.diff(bounds).astype(np.int64)
    result = np.zeros(len(lengths), np.uint64)
    some = np.flatnonzero(lengths)
    if len(some):
        data = data[bounds[0] : bounds[-1]]
        at = np.arange(len(data)) - np.repeat(bounds[:-1].astype(np.int64) - int(bounds[0]), lengths)
        values = (data.astype(np.uint64) + np.uint64(1)) * _POWERS[at & 4095]
        begin = bounds[:-1][some].astype(np.int64) - int(bounds[0])
        result[some] = mix(np.add.reduceat(values, begin) + lengths[some].astype(np.uint64))
    return result


def ranges(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each range, one range after another."""
    total = np.cumsum(lengths, dtype=np.int64)
    n = int(total[-1]) if len(total) else 0
    places = np.repeat((begin - (total - lengths)).astype(np.int32), lengths)
    places += np.arange(n, dtype=np.int32)
    return places


class WordStore:
    """Finds a word's number by its hash, and then by its bytes, so no two words are taken for one."""

    def __init__(self, id_type: type):
        self._hashes, self._order = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self._data, self._bounds = np.zeros(0, np.uint8), np.zeros(1, np.int32)
        self.ids, self.begin = np.zeros(0, id_type), np.zeros(1, np.int32)

    def __len__(self) -> int:
        return len(self.begin) - 1

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in vars(self).values())

    def find(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Number of each of the words that lie one after another in ``data``; -1 for those not here."""
        hashes = flat_hashes(data, bounds)
        result = np.full(len(hashes), -1, np.int64)
        if not len(self) or not len(hashes):
            return result
        place = np.minimum(np.searchsorted(self._hashes, hashes), len(self) - 1)
        lengths = np.diff(bounds)
        number = self._order[place]
        same = (self._hashes[place] == hashes) & (np.diff(self._bounds)[number] == lengths)
        at = np.flatnonzero(same)
        number, sizes = number[at], lengths[at].astype(np.int64)
        differ = data[ranges(bounds[:-1][at], sizes)] != self._data[ranges(self._bounds[:-1][number], sizes)]
        wrong = np.repeat(np.arange(len(at)), sizes)[differ]
        result[at] = number
        result[at[wrong]] = -1
        return result

    def add(self, data: np.ndarray, bounds: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Words one after another in ``data``, and the ids of each."""
        hashes = flat_hashes(data, bounds)
        order = np.argsort(hashes)
        at = np.searchsorted(self._hashes, hashes[order])
        self._order = np.insert(self._order, at, (len(self) + order).astype(np.int32))
        self._hashes = np.insert(self._hashes, at, hashes[order])
        self._data = np.concatenate([self._data, data[bounds[0] : bounds[-1]]])
        self._bounds = np.concatenate([self._bounds, (self._bounds[-1] + (bounds[1:] - bounds[0])).astype(np.int32)])
        self.begin = np.concatenate([self.begin, (self.begin[-1] + np.cumsum(lengths)).astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])
