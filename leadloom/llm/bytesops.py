"""Word positions and hashes of many texts at once, on their UTF-8 bytes.

Used inside Arrow tasks. A batch of texts is one byte buffer with offsets, so no text is
decoded and no word becomes a Python object.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WHITE = [0x20, *range(0x09, 0x0E)]
_SLICE_BYTES = 2_000_000


def _lower_table(is_word: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    table[~is_word[table]] = 0
    return table


def _alnum() -> np.ndarray:
    keep = np.zeros(256, bool)
    keep[0x30:0x3A] = keep[0x61:0x7B] = keep[0x80:] = True
    return keep


#: Byte -> byte of a word in lower case, 0 for a separator. Words are runs of a-z, 0-9 and
#: all characters beyond ASCII, after A-Z have become a-z.
ALNUM_LOWER = _lower_table(_alnum())


def give_back() -> None:
    """Return freed memory to the machine, which else stays with this worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, 0x9E3779B97F4A7C15, np.uint64))


_POWERS = _powers(4096)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all input bits over 64 bits (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_slices(texts: pa.Array, limit: int = _SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Whole texts in slices of about ``limit`` bytes: (first row, bytes, offsets). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, b"") if texts.null_count else texts
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    width = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(offsets, width, n + 1, texts.offset * np.dtype(width).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(mapped: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-zero bytes, and the index of each text's first word (with the total last)."""
    word = mapped != 0
    before = np.zeros(len(word), bool)
    before[1:] = word[:-1]
    before[offsets[:-1][offsets[:-1] < len(word)]] = False
    after = np.zeros(len(word), bool)
    after[:-1] = word[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(mapped: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word. Equal words have equal hashes; different ones nearly always differ."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = (mapped[mapped != 0].astype(np.uint64) + np.uint64(1)) * _POWERS[at & 4095]
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mix(sums + lengths.astype(np.uint64))


def shingle_hashes(
    words: np.ndarray, first: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words: (hash, index of first word, index of the text).

    A text with fewer words has one shingle of all its words; one without words has none.
    """
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    total = np.zeros(len(words), np.uint64)
    for k in range(size):
        # Past its end a text reads as zeros, so a short text hashes all the words it has.
        part = np.zeros(len(words), np.uint64)
        if len(words) > k:
            same = text[k:] == text[: len(text) - k]
            part[: len(words) - k] = np.where(same, words[k:], np.uint64(0))
        total = total * np.uint64(0xD6E8FEB86659FD93) + part
    place = np.arange(len(words)) - first[text]
    is_start = place <= np.maximum(counts[text] - size, 0)
    at = np.flatnonzero(is_start)
    return mix(total[at].copy()), at, text[at]
